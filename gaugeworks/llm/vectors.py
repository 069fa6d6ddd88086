"""The most similar source vectors of every target vector, by multi-index hashing.

Learned rotated binary codes: each code is ``sign(R x)`` with R fitted by iterative
quantisation on a bounded sample (SAMPLE vectors); several rotations, each from its
own start, give as many bits as wanted. The code is split into substrings of about
log2(n) bits, each indexed. With L substrings, two codes within a Hamming radius of
L - 1 agree in at least one of them (pigeonhole), so looking up every substring
retrieves every code within that radius. Codes met are filtered by the Hamming
distance of a code of CHECK_BITS bits and reranked by the cosine of the floats.

L follows from the substring length and the recall wanted for a pair just at the
cosine floor; pairs above it are found more surely. Every vector is indexed.

The index is never shuffled or stored: it would have L rows a vector. Vectors lie in flat
files that tasks map into memory; a task sorts the codes of one block of sources under a few
substrings, holds all targets against them, and returns the k best of each target. A block
has at most BLOCK vectors, so a task's memory doesn't follow the table, and more
sources make more tasks.

A vector counts if it has DIM finite numbers and isn't all zero; others give no row.
Vectors of the same direction are one class, indexed once; its k smallest ids stand
for it, which is all a top-k with ties broken by smaller id can use. Candidates of hot
substrings (dense regions) are compared STEP at a time."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm import vectorfiles
from gaugeworks.session import delete, materialize, release, shared_folder

DIM = 64
SAMPLE = 20_000
RECALL_AT_FLOOR = 0.97
CHECK_BITS = 256
#: Vectors of a block of sources; substrings that a task looks up; targets encoded at once; candidates compared at once.
BLOCK, GROUP, CHUNK, STEP = 2_000_000, 12, 1 << 17, 1 << 19


def unit_rows(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (float64) of the rows that count, and which rows those are."""
    lists = column.cast(pa.list_(pa.float64()))
    size = np.asarray(lists.value_lengths().fill_null(-1))
    rows = np.flatnonzero(size == dim)
    flat = lists.take(pa.array(rows)).flatten()
    x = np.asarray(flat.fill_null(math.nan)).reshape(-1, dim) if len(rows) else np.empty((0, dim))
    good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    x, rows = x[good], rows[good]
    scale = np.abs(x).max(axis=1, keepdims=True) if len(x) else np.ones((0, 1))
    x = x / scale  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True), rows


def learn_rotations(x: np.ndarray, n_bits: int, seed: int = 7, rounds: int = 30) -> np.ndarray:
    """A (dim, n_bits) matrix of blocks of iterative quantisation, each from another random start.

    Vectors aren't centred: the plan's recall is that of the angle between the vectors as they are."""
    dim = x.shape[1]
    rng = np.random.default_rng(seed)
    _, axes = np.linalg.eigh(x.T @ x) if len(x) else (None, np.eye(dim))
    v = x @ axes
    blocks = []
    for _ in range(math.ceil(n_bits / dim)):
        r = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        for _ in range(rounds if len(x) > dim else 0):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        blocks.append(axes @ r)
    return np.hstack(blocks)[:, :n_bits]


def plan_substrings(n: int, floor: float) -> tuple[int, int]:
    """Bits of a substring and how many are needed so that a pair at the floor meets with RECALL_AT_FLOOR."""
    bits = min(24, max(8, round(math.log2(max(n, 2)) - 2)))
    same = (1 - math.acos(min(1.0, floor)) / math.pi) ** bits
    return bits, max(4, math.ceil(math.log(1 - RECALL_AT_FLOOR) / math.log(1 - same)) if same < 1 else 4)


def hamming_bound(floor: float, bits: int) -> int:
    """Bits in which a pair at the floor may differ, with four standard deviations of room."""
    p = math.acos(min(1.0, floor)) / math.pi
    return math.ceil(bits * p + 4 * math.sqrt(bits * p * (1 - p)))


def to_units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def sign_words(x: np.ndarray, matrix: np.ndarray, bits: int, width: int) -> np.ndarray:
    """Words of ``width`` bits, each with the next ``bits`` signs of ``x @ matrix``: an array of 32- or 64-bit integers, a row for each vector."""
    n, words = len(x), matrix.shape[1] // bits
    signs = np.zeros((n, words, width), bool)
    np.greater_equal((x @ matrix).reshape(n, words, bits), 0, out=signs[:, :, :bits])
    return np.packbits(signs.reshape(n, -1), axis=1, bitorder="little").view(f"<u{width // 8}")


def candidates(starts: np.ndarray, order: np.ndarray, codes: np.ndarray, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place in ``codes``, source) of the same code, at most ``step`` at a time; ``starts`` says where a code's sources begin in ``order``."""
    begin = starts[codes]
    ends = np.cumsum(starts[codes + 1] - begin)
    lead = begin - np.concatenate([[0], ends[:-1]])  # of a target: from the count of pairs to the place in order
    for lo in range(0, int(ends[-1]) if len(ends) else 0, step):
        hi = min(lo + step, int(ends[-1]))
        first, last = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi - 1, "right") + 1
        bounds = np.clip(np.concatenate([[lo], ends[first:last]]), lo, hi)
        t = np.repeat(np.arange(first, last), np.diff(bounds))
        yield t, order[np.arange(lo, hi) + lead[t]]


def k_best(t: np.ndarray, s: np.ndarray, cosine: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Which pairs are among the first k of their target by cosine, then by the source's id."""
    order = np.lexsort((ids, -np.round(cosine, 9), t))
    first = np.flatnonzero(np.concatenate([[True], t[order][1:] != t[order][:-1]])) if len(t) else np.empty(0, np.int64)
    place = np.arange(len(t)) - np.repeat(first, np.diff(np.append(first, len(t))))
    return order[place < k]


class Block:
    """Positions, ids and check codes of a block's vectors, mapped."""

    def __init__(self, folder: str, name: str):
        self.pos, self.ids, *check = vectorfiles.mapped(folder, name, np.int64).reshape(2 + CHECK_BITS // 64, -1)
        self.check = [c.view(np.uint64) for c in check]  # bits of signed numbers are counted without the sign


def matches(store: vectorfiles.Vectors, block: Block, targets: list[Block], matrix: np.ndarray, bits: int, k: int, floor: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions and cosine of the pairs that meet in a substring of ``matrix``, of each target the k best in this block."""
    n, words = len(block.pos), matrix.shape[1] // bits
    bounds = [hamming_bound(floor, 64 * (i + 1)) for i in range(CHECK_BITS // 64)]
    codes = np.empty((words, n), np.uint32)
    for lo in range(0, n, CHUNK // 8):
        codes[:, lo : lo + CHUNK // 8] = sign_words(store.take(block.pos[lo : lo + CHUNK // 8], np.float32), matrix, bits, 32).T
    index = []
    for c in codes:
        keyed = np.sort((c.astype(np.uint64) << 32) | np.arange(n, dtype=np.uint64))
        c[:] = keyed & 0xFFFFFFFF
        index.append((np.concatenate([[0], np.cumsum(np.bincount((keyed >> 32).astype(np.int64), minlength=1 << bits))]).astype(np.int32), c))
    del keyed

    for side in targets:
        for at in range(0, len(side.pos), CHUNK):
            pos = np.asarray(side.pos[at : at + CHUNK])
            check = [np.asarray(c[at : at + CHUNK]) for c in side.check]
            own = np.concatenate([sign_words(store.take(pos[lo : lo + CHUNK // 8], np.float32), matrix, bits, 32) for lo in range(0, len(pos), CHUNK // 8)])
            best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
            held: list[np.ndarray] = []

            def flush(best=best):
                met = np.unique(np.concatenate(held)) if held else np.empty(0, np.int64)
                held.clear()
                parts = [best]
                for lo in range(0, len(met), CHUNK // 4):
                    t, s = met[lo : lo + CHUNK // 4] >> 32, met[lo : lo + CHUNK // 4] & 0xFFFFFFFF
                    cosine = np.einsum("ij,ij->i", to_units(store.take(pos[t])), to_units(store.take(block.pos[s])))
                    near = cosine >= floor - 1e-9
                    parts.append((t[near], s[near], cosine[near]))
                t, s, cosine = (np.concatenate(x) for x in zip(*parts))
                _, once = np.unique(t << 32 | s, return_index=True)
                t, s, cosine = t[once], s[once], cosine[once]
                keep = k_best(t, s, cosine, block.ids[s], k)
                return t[keep], s[keep], cosine[keep]

            for (starts, order), c in zip(index, own.T):
                by_code = np.argsort(c)  # neighbours in code are neighbours in the index
                for t, s in candidates(starts, order, c[by_code].astype(np.int64), STEP):
                    t, far = by_code[t], np.zeros(len(t), np.int16)
                    for x, y, bound in zip(check, block.check, bounds):  # most fall at the first word
                        far = far + np.bitwise_count(x[t] ^ y[s])
                        close = far <= bound
                        t, s, far = t[close], s[close], far[close]
                    held.append(t << 32 | s.astype(np.int64))
                    if sum(map(len, held)) > 4 * STEP:
                        best = flush(best)
            t, s, cosine = flush(best)
            yield pos[t], np.asarray(block.pos[s]), cosine


def most_similar(df: DataFrame, id_col: str, is_target, vector_col: str, k: int = 5, floor: float = 0.9, dim: int = DIM) -> DataFrame:
    """``target, source, cosine``: the k most similar sources of each target with a cosine of at least ``floor``; ties to the smaller id.

    ``is_target`` is a boolean column; rows where it's null take no part."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), is_target.alias("target"), F.col(vector_col).alias("v")).where("target is not null and id is not null")
    folder = shared_folder(spark)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Store the vectors that count; what goes on is their ids, sides, classes and positions."""
        number, held, n = TaskContext.get().taskAttemptId() << 24, [], 0

        def stored() -> pa.RecordBatch:
            pos = vectorfiles.write_vectors(folder, number, np.concatenate([h[3] for h in held]))
            return pa.RecordBatch.from_arrays([*(pa.concat_arrays([h[i] for h in held]) for i in range(3)), pa.array(pos)], names=["id", "target", "class", "pos"])

        for whole in batches:
            for lo in range(0, whole.num_rows, 1 << 14):
                b = whole.slice(lo, 1 << 14)
                x, at = unit_rows(b.column(2), dim)
                if not len(at):
                    continue
                take = pa.array(at)
                way = np.ascontiguousarray(np.round(x, 9) + 0.0)  # + 0.0: no minus zero
                names = [hashlib.blake2b(r, digest_size=16).digest() for r in way]
                raw = np.asarray(b.column(2).take(take).flatten()).astype(np.float64).reshape(-1, dim)
                raw = np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1, keepdims=True))[1])  # by a power of two: the direction stays exact
                held.append((b.column(0).take(take), b.column(1).take(take), pa.array(names, pa.binary()), raw.astype(kind)))
                n += len(at)
                if n > (1 << vectorfiles.ROW_BITS) - (1 << 14):
                    yield stored()
                    number, held, n = number + 1, [], 0
        if held:
            yield stored()

    kind = np.float32 if df.schema[vector_col].dataType.elementType.typeName() == "float" else np.float64
    unit = materialize(rows.mapInArrow(keep, "id long, target boolean, class binary, pos long"))

    # of each class and side the k smallest ids; the first stands for the class
    order = Window.partitionBy("target", "class").orderBy("id", "pos")
    ranked = materialize(unit.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).where("not target or n = 1"))
    reps = ranked.where("n = 1")
    counts = {r["target"]: r["n"] for r in reps.groupBy("target").agg(F.count("*").alias("n")).collect()}
    if not counts.get(True) or not counts.get(False):
        return spark.createDataFrame([], "target long, source long, cosine double")
    n_blocks = {side: math.ceil(n / BLOCK) for side, n in counts.items()}
    bits, n_sub = plan_substrings(counts[False], floor)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = vectorfiles.Vectors(folder, dim)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in store.take(np.asarray(b.column(0)))], pa.binary())], names=["raw"])

    share = min(1.0, 1.2 * SAMPLE / unit.count())
    sample = [bytes(r[0]) for r in unit.select("pos").sample(share, 11).limit(SAMPLE).mapInArrow(read, "raw binary").collect()]
    x = to_units(np.frombuffer(b"".join(sample), np.float64).reshape(-1, dim)) if sample else np.ones((1, dim)) / math.sqrt(dim)
    matrix = learn_rotations(x, bits * n_sub).astype(np.float32)
    shared = spark.sparkContext.broadcast((matrix, learn_rotations(x, CHECK_BITS, seed=23).astype(np.float32)))

    def lay(side: str):
        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Store a partition as one block."""
            got = [(np.asarray(b.column(0)), np.asarray(b.column(1))) for b in batches if b.num_rows]
            if not got:
                return
            pos, ids = (np.concatenate(x) for x in zip(*got))
            del got
            by_place = np.argsort(pos)
            pos, ids = pos[by_place], ids[by_place]
            store, check_matrix = vectorfiles.Vectors(folder, dim), shared.value[1]
            check = np.concatenate([sign_words(store.take(pos[lo : lo + CHUNK // 8], np.float32), check_matrix, 64, 64) for lo in range(0, len(pos), CHUNK // 8)])
            name = f"{side}-{TaskContext.get().taskAttemptId()}"
            vectorfiles.write(folder, name, pos, ids, *check.T)
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

        return blocks

    laid = {side: sorted(r["name"] for r in reps.where(F.col("target") == side).select("pos", "id").repartitionByRange(n_blocks[side], "pos").mapInArrow(lay(f"block-{side}".lower()), "name string").collect()) for side in (True, False)}
    groups = max(math.ceil(n_sub / GROUP), min(n_sub, 12 // len(laid[False]), math.ceil(sum(counts.values()) * n_sub / 1e6)))
    cuts = [n_sub * i // groups for i in range(groups + 1)]
    jobs = [(name, lo, hi) for name in laid[False] for lo, hi in zip(cuts, cuts[1:])]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for job in b.column(0).to_pylist():
                name, lo, hi = jobs[job]
                store = vectorfiles.Vectors(folder, dim)
                own = np.ascontiguousarray(shared.value[0][:, lo * bits : hi * bits])
                for found in matches(store, Block(folder, name), [Block(folder, x) for x in laid[True]], own, bits, k, floor):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["t", "s", "cosine"])

    met = spark.range(0, len(jobs), 1, len(jobs)).mapInArrow(match, "t long, s long, cosine double")
    scored = met.groupBy("t", "s").agg(F.max("cosine").alias("cosine"))
    first = Window.partitionBy("class").orderBy("n")
    members = ranked.where("not target").select(F.first("pos").over(first).alias("s"), F.col("id").alias("source"))
    best = Window.partitionBy("t").orderBy(F.round("cosine", 9).desc(), "source")
    top = scored.join(members, "s").withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    classes = top.join(reps.where("target").select(F.col("pos").alias("t"), "class"), "t").select("class", "source", "cosine")
    found = materialize(unit.where("target").select(F.col("id").alias("target"), "class").join(classes, "class").select("target", "source", "cosine"))
    release(unit)
    release(ranked)
    delete(spark, folder)
    return found
