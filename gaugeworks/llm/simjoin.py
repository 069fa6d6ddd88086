"""Segment join over canonical token sequences: all pairs of sets with Jaccard of at least ``t``.

A text's set of tokens is written as a sequence in one fixed order, rarest token
first. With inserts and deletes as its edits, the edit distance of two such
sequences is the size of their symmetric difference, so Jaccard >= t is a bounded
edit distance: at most (1 - t) / (1 + t) of the two lengths together.

At most k = n - ceil(t * n) tokens of a sequence of length n may be missing in any
partner, and fewer in one that isn't smaller. So the j-th token that two similar
sequences share stands among the first k + j of either (pigeonhole), and each sequence
stores as segments what may be the first tokens it shares with a partner: a token of
the first k + 1 alone if it's rare; behind a frequent one the second token (of the first
k + 2), and behind a frequent pair the third. Frequent means more than HOT rows
expected. That keeps hot tokens from forming hot buckets and loses no pair.

A segment is stored with the length of its sequence and its position there. What
follows the first shared token bounds the overlap, so only segments at allowed positions of
sequences of allowed lengths meet. They are filtered by a 64-bit parity sketch (each
differing token flips one bit, so more flipped bits than the bound prove a larger
distance), then verified exactly: over sorted sequences without repeats the banded
dynamic programme has one path, the merge.

The order needs frequencies only to be selective, not to be right, so they are kept in
a table of hashed counters, sized by the number of rows (2**BITS to 2**MOST_BITS), one
byte each: eighths of the logarithm."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.tokens import _MULT, mix, set_hash, token_sets
from gaugeworks.session import materialize

BITS = 17
MOST_BITS = 24
HOT = 3000
DEPTH = 3
BLOCK = 1 << 16
FILTER_BITS = 28
SEEN = 1 << 20
EPS = 1e-9
SEGMENTS = "key long, id long, sketch long, form long"


@dataclass(frozen=True)
class Order:
    """How frequent the tokens of each hashed bucket are, in eighths of log2(1 + rows), and the number of rows counted."""

    codes: np.ndarray
    rows: int

    def of(self, h: np.ndarray) -> np.ndarray:
        bits = int(len(self.codes)).bit_length() - 1
        return self.codes[(h >> np.uint64(64 - bits)).astype(np.int64)]


def tokens_of(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens and their rows, ordered by row and hash: of texts, or of binaries that hold them already (:func:`packed`)."""
    if not pa.types.is_binary(column.type):
        return token_sets(column, shingle)
    column = column.fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    h = np.frombuffer(held, np.uint8)[ends[0] : ends[-1]] if held is not None and len(column) else np.empty(0, np.uint8)
    return np.ascontiguousarray(h).view(np.uint64), np.repeat(np.arange(len(column)), np.diff(ends) // 8)


def packed(h: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The tokens of each row, 8 bytes each, as one binary."""
    ends = np.r_[0, np.cumsum(8 * sizes)]
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(h))]).cast(pa.binary())


def frequencies(df: DataFrame, text: str, shingle: int) -> Order:
    """The order of the tokens of a column of texts or packed tokens, from counts over all its rows.

    Each task counts into dense blocks, which are summed block by block: what is
    shuffled is the counters of each task, whatever the rows hold."""
    source = df.select(text)
    n = source.count()
    bits = min(MOST_BITS, max(BITS, math.ceil(math.log2(max(n, 1) * 256 / 3000))))

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(1 << bits, np.uint32)
        for b in batches:
            h, _ = tokens_of(b.column(0), shingle)
            np.add.at(total, (h >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
        return total

    return Order(_summed(source, count, lambda x: np.minimum(np.round(8 * np.log2(1.0 + x)), 255).astype(np.uint8), np.add), n)


def _summed(df: DataFrame, fill, finish, add: np.ufunc) -> np.ndarray:
    """An array that each task fills from its batches, put together block by block with ``add``; ``finish`` makes bytes of the entries."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = fill(batches)
        parts = x.reshape(-1, min(BLOCK, len(x)))
        at = np.unique(np.r_[0, len(parts) - 1, np.flatnonzero(parts.any(axis=1))])
        for i in at:
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([parts[i].tobytes()], pa.binary()), pa.array([x.dtype.str])], names=["block", "n", "kind"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for at, n, kind in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                x = np.frombuffer(n.as_buffer(), kind)
                sums[at] = add(sums[at], x) if at in sums else x.astype(np.uint64) if add is np.add else x
        done = [finish(x).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(done, pa.binary())], names=["block", "n"])

    rows = df.mapInArrow(blocks, "block int, n binary, kind string").repartition("block").mapInArrow(join, "block int, n binary").collect()
    size = len(rows[0]["n"]) if rows else 1
    out = np.zeros((max((r["block"] for r in rows), default=0) + 1, size), np.uint8)
    for r in rows:
        out[r["block"]] = np.frombuffer(r["n"], np.uint8)
    return out.ravel()


def need(t: float, n: np.ndarray) -> np.ndarray:
    """The least overlap a set of size n has with any partner."""
    return np.ceil(t * n - EPS).astype(np.int64)


def _cut(h: np.ndarray, r: np.ndarray, n_rows: int, order: Order, t: float, limit: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct tokens ordered by row and hash: segment keys, the row of each, whether it's among those needed towards partners of the same size or larger, and its position."""
    limit = HOT if limit is None else limit
    codes = order.of(h)
    if n_rows <= 1 << 14:
        at = np.argsort((r.astype(np.uint64) << np.uint64(50)) | (codes.astype(np.uint64) << np.uint64(42)) | (h >> np.uint64(22)), kind="stable")
    else:
        at = np.lexsort((h, codes, r))
    h, r, log = h[at], r[at], codes[at] / 8.0
    sizes = np.bincount(r, minlength=n_rows)
    start = np.cumsum(sizes) - sizes
    place = np.arange(len(h)) - start[r]
    least = need(t, sizes)
    k1 = sizes - least + 1
    k0 = sizes - need(2 * t / (1 + t), sizes) + 1
    all_rows, most = math.log2(max(order.rows, 1)), math.log2(limit) if limit > 0 else -math.inf
    last = np.flatnonzero((place < k1[r]) & (sizes[r] > 1))
    first, key, expected, lead = last, h[last], log[last], (place < k0[r])[last]
    out: list[tuple[np.ndarray, ...]] = []
    for depth in range(1, DEPTH + 1):
        hot = expected > most
        row = r[last]
        done = ~hot | (depth >= least[row]) | (depth == DEPTH)
        out.append((key[done], row[done], lead[done], place[first[done]]))
        if depth == DEPTH:
            break
        first, last, key, expected, lead, row = (x[hot] for x in (first, last, key, expected, lead, row))
        more = np.maximum(start[row] + np.minimum(k1[row] + depth, sizes[row]) - last - 1, 0)
        of = np.repeat(np.arange(len(last)), more)
        last = np.arange(len(of)) - np.repeat(np.cumsum(more) - more, more) + last[of] + 1
        first, key = first[of], mix(key[of] * _MULT + h[last])
        expected = expected[of] + log[last] - all_rows
        lead = lead[of] & (place[last] < k0[r[last]] + depth)
    return tuple(np.concatenate(x) for x in zip(*out))


def _segments(h: np.ndarray, r: np.ndarray, n_rows: int, order: Order, t: float, limit: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The segments of :func:`_cut` without their positions."""
    return _cut(h, r, n_rows, order, t, limit)[:3]


def segments(df: DataFrame, text: str, shingle: int, t: float, order: Order, limit: int | None = None) -> DataFrame:
    """``key, id, sketch, form``: the stored segments of each distinct set of a column of texts or packed tokens; see :func:`form`.

    Only segments made with the same ``t``, ``order`` and ``limit`` (HOT) meet."""
    limit = HOT if limit is None else limit
    shared = df.sparkSession.sparkContext.broadcast(order)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in batches:
            n = b.num_rows
            h, r = tokens_of(b.column(0), shingle)
            ids, sizes = set_hash(h, r, n)
            of = _fresh(ids, seen)[r]
            h, r = h[of], r[of]
            if not len(h):
                continue
            sketch = np.zeros(n, np.uint64)
            first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
            sketch[r[first]] = np.bitwise_xor.reduceat(np.uint64(1) << (h & np.uint64(63)), first)
            keys, rows, lead, place = _cut(h, r, n, shared.value, t, limit)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(ids[rows].view(np.int64)), pa.array(sketch[rows].view(np.int64)), pa.array((sizes[rows] << 32) | (place << 1) | lead)],
                names=["key", "id", "sketch", "form"],
            )

    return df.select(text).mapInArrow(emit, SEGMENTS)


def _fresh(ids: np.ndarray, seen: set) -> np.ndarray:
    """Which rows hold an id not in ``seen`` yet, the first of each; ``seen`` takes them up. It's emptied at SEEN: copies only cost, they do no harm."""
    names, first = np.unique(ids, return_index=True)
    new = set(names.tolist()) - seen
    seen |= new
    if len(seen) > SEEN:
        seen.clear()
    out = np.zeros(len(ids), bool)
    out[first] = np.fromiter((x in new for x in names.tolist()), bool, len(names))
    return out


def form(packed_form: Column) -> dict[str, Column]:
    """``size, place, lead`` of a segment, which is stored as one number to keep its rows short: length and position of 32 and 31 bits, then the flag."""
    return {"size": F.shiftright(packed_form, 32), "place": F.shiftright(packed_form, 1).bitwiseAND(F.lit((1 << 31) - 1)), "lead": packed_form.bitwiseAND(F.lit(1)) == 1}


def once_a_task(sets: DataFrame) -> DataFrame:
    """``id, tokens`` without the repeats that one task sees; a set may still come from several tasks."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in batches:
            yield b.filter(pa.array(_fresh(np.asarray(b.column(0)), seen)))

    return sets.select("id", "tokens").mapInArrow(emit, "id long, tokens binary")


def met(a: dict[str, Column], b: dict[str, Column], t: float) -> Column:
    """Whether segments (``size, place, sketch``) that share a key stand at allowed lengths and positions with sketches near enough."""
    total = a["size"] + b["size"]
    overlap = overlap_needed(t, a["size"], b["size"])
    fits = F.least(a["size"] - a["place"], b["size"] - b["place"]) >= overlap
    return fits & (F.bit_count(a["sketch"].bitwiseXOR(b["sketch"])) <= total - 2 * overlap)


def verified(pairs: DataFrame, t: float) -> DataFrame:
    """``id_a, id_b, overlap, size_a, size_b`` of the pairs (with ``tokens_a, tokens_b``) that are similar.

    The two sorted sequences of each pair are merged, all pairs of a batch in one sort; equal neighbours are the overlap."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            (h, r), (g, q) = tokens_of(b.column(2), 1), tokens_of(b.column(3), 1)
            every, rows = np.r_[h, g], np.r_[r, q]
            at = np.lexsort((every, rows))
            every, rows = every[at], rows[at]
            overlap = np.bincount(rows[1:][(every[1:] == every[:-1]) & (rows[1:] == rows[:-1])], minlength=n)
            size_a, size_b = np.bincount(r, minlength=n), np.bincount(q, minlength=n)
            keep = pa.array(overlap >= t * (size_a + size_b - overlap) - EPS)
            out = [b.column(0), b.column(1), *(pa.array(x.astype(np.int32)) for x in (overlap, size_a, size_b))]
            yield pa.RecordBatch.from_arrays([x.filter(keep) for x in out], names=["id_a", "id_b", "overlap", "size_a", "size_b"])

    return pairs.select("id_a", "id_b", "tokens_a", "tokens_b").mapInArrow(merge, "id_a long, id_b long, overlap int, size_a int, size_b int")


def overlap_needed(t: float, a: Column, b: Column) -> Column:
    return F.ceil(F.lit(t / (1 + t)) * (a + b) - F.lit(EPS))


def candidates(stored: DataFrame, t: float, other: DataFrame | None = None) -> DataFrame:
    """``id_a, id_b``: sets that share a segment and pass the length and sketch bounds.

    Within ``stored`` each pair once, id_a < id_b; or id_a of ``stored`` and id_b of
    ``other``, a set that stands on both sides not being paired with itself. Of the smaller
    set the leading segments are enough."""

    def once(x: DataFrame, end: str) -> DataFrame:
        return x.repartition("key").groupBy("key", F.col("id").alias("id" + end)).agg(F.first("sketch").alias("sketch" + end), F.max("form").alias("form" + end))

    a, b = once(stored, "_a"), once(stored if other is None else other, "_b")
    x, y = (form(F.col("form" + end)) | {"sketch": F.col("sketch" + end)} for end in ("_a", "_b"))
    smaller = x["lead"] & (x["size"] <= y["size"])
    if other is None:
        a, b = a.where(x["lead"]), b.where("form_b is not null")  # both sides read the same columns, so they share one exchange
    else:
        smaller = smaller | y["lead"] & (y["size"] <= x["size"])
    pairs = a.join(b, "key").where((F.col("id_a") != F.col("id_b")) & smaller & met(x, y, t))
    if other is None:
        pairs = pairs.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    return pairs.select("id_a", "id_b").distinct()


def _in_filter(ids: DataFrame, bits: int) -> np.ndarray:
    """A packed set of 2**bits bits over hashed ids."""

    def place(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros(1 << bits, bool)
        for b in batches:
            out[_slot(b.column(0).to_numpy().view(np.uint64), bits)] = True
        return np.packbits(out)

    return _summed(ids, place, lambda x: x, np.bitwise_or)


def _slot(ids: np.ndarray, bits: int) -> np.ndarray:
    return (mix(ids) >> np.uint64(64 - bits)).astype(np.int64)


def sets_of(df: DataFrame, text: str, shingle: int, ids: DataFrame, n: int) -> DataFrame:
    """``id, tokens``: the sets named in ``ids``, at most ``n`` (and few others: those that a filter of 16 bits an id lets through)."""
    bits = min(FILTER_BITS, max(16, math.ceil(math.log2(16 * max(n, 1)))))
    shared = df.sparkSession.sparkContext.broadcast(_in_filter(ids, bits))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        bitset = shared.value
        for b in batches:
            h, r = token_sets(b.column(0), shingle)
            key, sizes = set_hash(h, r, b.num_rows)
            slot = _slot(key, bits)
            wanted = ((bitset[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1).astype(bool) & (sizes > 0)
            some = np.flatnonzero(wanted)
            wanted[some] = _fresh(key[some], seen)
            of = wanted[r]
            yield pa.RecordBatch.from_arrays([pa.array(key[wanted].view(np.int64)), packed(h[of], sizes[wanted])], names=["id", "tokens"])

    return df.select(text).mapInArrow(emit, "id long, tokens binary").dropDuplicates(["id"])


def similar_sets(df: DataFrame, text: str, t: float, shingle: int = 1, side: str | None = None) -> DataFrame:
    """``id_a, id_b, overlap, size_a, size_b``: all pairs of different sets with Jaccard >= t; with ``side``, id_a from its rows of 0 and id_b of 1.

    ``id`` is the set's hash (:func:`gaugeworks.llm.tokens.set_hash`). Null, blank and
    wordless texts have no set and no pair; repeated texts share one set."""
    if not 0.5 < t <= 1:
        raise ValueError("t must be above 0.5, so that similar sets of two tokens or more share two")
    order = frequencies(df, text, shingle)
    stored = [segments(x, text, shingle, t, order) for x in ([df] if side is None else [df.where(F.col(side) == 0), df.where(F.col(side) == 1)])]
    pairs = materialize(candidates(stored[0], t, *stored[1:]))
    ids = pairs.select(F.explode(F.array("id_a", "id_b")).alias("id"))
    return verified(with_tokens(pairs, materialize(sets_of(df, text, shingle, ids, 2 * pairs.count()))), t)


def with_tokens(pairs: DataFrame, a: DataFrame, b: DataFrame | None = None) -> DataFrame:
    """``pairs`` with ``tokens_a`` of ``a`` and ``tokens_b`` of ``b`` (or ``a`` too), both ``id, tokens``."""
    b = a if b is None else b
    return pairs.join(a.select(F.col("id").alias("id_a"), F.col("tokens").alias("tokens_a")), "id_a").join(b.select(F.col("id").alias("id_b"), F.col("tokens").alias("tokens_b")), "id_b")


def set_ids(df: DataFrame, text: str, shingle: int, keep: list[str], with_tokens: bool = False) -> DataFrame:
    """The columns ``keep`` and ``set_id``: the hash of the row's set, null without any token; and its ``tokens`` if asked for."""
    fields = [df.schema[c] for c in keep]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, r = token_sets(b.column(len(keep)), shingle)
            ids, sizes = set_hash(h, r, b.num_rows)
            out = [*b.columns[: len(keep)], pa.array(ids.view(np.int64), mask=sizes == 0)]
            if with_tokens:
                out.append(packed(h, sizes))
            yield pa.RecordBatch.from_arrays(out, names=[*keep, "set_id", *["tokens"] * with_tokens])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", set_id long" + ", tokens binary" * with_tokens
    return df.select(*keep, text).mapInArrow(emit, schema)
