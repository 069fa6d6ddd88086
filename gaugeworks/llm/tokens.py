"""Vectorised word and shingle hashing over Arrow string buffers.

No per-row Python: words are found with byte classes and boundaries, and hashed
with one ``reduceat`` over the bytes of a whole batch. Hashes have 64 bits and
stand for the words; two of n words collide with a chance of n**2 / 2**65."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MULT = np.uint64(0x9E3779B97F4A7C15)
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _MULT | np.uint64(1), dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def words(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (lower-cased runs of a-z and 0-9) in text order, and the row of each."""
    text = pc.fill_null(pc.utf8_lower(text.cast(pa.large_string())), "")
    n = len(text)
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + n + 1]
    if n == 0 or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = _IN_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    begins[first] = inside[first]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    starts = np.flatnonzero(begins)
    heads = np.flatnonzero(begins[at])
    lengths = np.diff(np.append(heads, len(at)))
    place = np.arange(len(at)) - np.repeat(heads, lengths)
    powers = _powers(int(lengths.max()))
    hashes = mix(np.add.reduceat(_BYTE[data[at]] * powers[place], heads))
    return hashes, np.searchsorted(offsets, starts, side="right") - 1


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``k`` successive words of a row, each as one hash."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _MULT + hashes[i : i + n]
    same = rows[:n] == rows[k - 1 :]
    return mix(out[same]), rows[:n][same]


def _by_row_and_hash(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The order by row, then hash: one sort of a single key where rows fit it."""
    if len(rows) and rows.max() < 1 << 14:
        key = (rows.astype(np.uint64) << np.uint64(50)) | (hashes >> np.uint64(14))
        order = np.argsort(key, kind="stable")
        k, h = key[order], hashes[order]
        if not ((k[1:] == k[:-1]) & (h[1:] != h[:-1])).any():  # else the key is too short for two of the hashes
            return order
    return np.lexsort((hashes, rows))


def distinct(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each hash once a row, ordered by row, then hash."""
    order = _by_row_and_hash(hashes, rows)
    h, r = hashes[order], rows[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[keep], r[keep]


def token_sets(text: pa.Array, shingle: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The set of words, or of ``shingle`` successive words, of each row: hashes and rows, ordered."""
    h, r = words(text)
    if shingle > 1:
        h, r = shingles(h, r, shingle)
    return distinct(h, r)


def set_hash(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """One hash for each row's set, and the set's size (0: no token, hash 0)."""
    sizes = np.bincount(rows, minlength=n_rows)
    out = np.zeros(n_rows, np.uint64)
    if len(hashes):
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        total = np.add.reduceat(mix(hashes ^ _MULT), first)
        out[rows[first]] = mix(total + sizes[rows[first]].astype(np.uint64))
    return out, sizes
