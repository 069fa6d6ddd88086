"""Vectors in flat files of the shared folder, which tasks map into memory, so that no shuffle carries a vector.

A vector's position is one number: the number of its file, then its row (ROW_BITS). The number of a
file ends with the type it is stored in, the narrowest that holds its numbers without loss."""

from __future__ import annotations

import os
import re
import tempfile

import numpy as np
import pyarrow.fs

ROW_BITS = 16
TYPES = (np.float16, np.float32, np.float64)


def _at(folder: str, name: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(re.sub("^file:/+", "/", f"{folder}/{name}"))


def write(folder: str, name: str, *arrays: np.ndarray) -> None:
    """Store the bytes of ``arrays`` one after the other."""
    fs, path = _at(folder, name)
    fs.create_dir(os.path.dirname(path))
    with fs.open_output_stream(path) as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a))


def local_file(folder: str, name: str) -> str:
    """A path that can be mapped: the file itself, or a temporary copy (lost with the process's files) if the folder isn't mounted."""
    fs, path = _at(folder, name)
    if isinstance(fs, pyarrow.fs.LocalFileSystem):
        return path
    handle, copy = tempfile.mkstemp(prefix="gaugeworks-")
    os.close(handle)
    pyarrow.fs.copy_files(path, copy, source_filesystem=fs, destination_filesystem=pyarrow.fs.LocalFileSystem())
    return copy


def mapped(folder: str, name: str, kind) -> np.ndarray:
    path = local_file(folder, name)
    held = np.memmap(path, kind, "r")
    if os.path.basename(path) != name:
        os.unlink(path)  # a copy: it lasts as long as it is mapped
    return held


def narrow(x: np.ndarray) -> tuple[int, np.ndarray]:
    """The narrowest type (its number) that holds ``x`` without loss, and ``x`` in it."""
    for i, kind in enumerate(TYPES):
        with np.errstate(over="ignore"):
            y = x.astype(kind)
        if (y == x).all():
            return i, y
    raise ValueError("vectors aren't numbers")


def write_vectors(folder: str, number: int, x: np.ndarray) -> np.ndarray:
    """Store at most 2^ROW_BITS vectors as file ``number``; returns their positions."""
    kind, x = narrow(x)
    file = number * len(TYPES) + kind
    write(folder, str(file), x)
    return (file << ROW_BITS) + np.arange(len(x), dtype=np.int64)


class Vectors:
    """Reads vectors by position."""

    def __init__(self, folder: str, dim: int):
        self.folder, self.dim, self.files = folder, dim, {}

    def take(self, pos: np.ndarray, kind=np.float64) -> np.ndarray:
        out = np.empty((len(pos), self.dim), kind)
        file = pos >> ROW_BITS
        order = np.argsort(file, kind="stable")
        names, first = np.unique(file[order], return_index=True)
        for name, at in zip(names.tolist(), np.split(order, first[1:])):
            if name not in self.files:
                self.files[name] = mapped(self.folder, str(name), TYPES[name % len(TYPES)]).reshape(-1, self.dim)
            out[at] = self.files[name][pos[at] & ((1 << ROW_BITS) - 1)]
        return out
