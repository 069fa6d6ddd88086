"""Deeply nested records as flat tables that keep parent-child links.

:func:`flatten` takes any nested column and emits one child table for a path through
it, with Arrow kernels only: list offsets give the children, ``list_parent_indices``
the parent of each, and every key is carried down by one vectorised ``take``. No row
is visited in Python.

JSON text whose shape changes from row to row has no Arrow type of its own.
:func:`named_lists` first decodes it, strictly, into one nested type (a list of named
parents, each with its list of entries), once per text; what follows is the same
flattening."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _place_in_list(parents: np.ndarray) -> np.ndarray:
    """Position of each entry in its list, from sorted parent indices."""
    if not len(parents):
        return np.empty(0, np.int64)
    first = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
    return np.arange(len(parents)) - np.repeat(first, np.diff(np.r_[first, len(parents)]))


def flatten_array(column: pa.Array, path: list[str]) -> tuple[pa.Array, np.ndarray, list[np.ndarray], list[pa.Array]]:
    """Walk ``path`` through ``column``; ``[]`` enters a list, any other step a struct's field.

    Returns the values at the end, the row each belongs to, and for every list entered
    the positions in it and the list's entries, both aligned with the values."""
    row = np.arange(len(column), dtype=np.int64)
    places: list[np.ndarray] = []
    entries: list[pa.Array] = []
    for step in path:
        if step == "[]":
            parents = np.asarray(pc.list_parent_indices(column)).astype(np.int64)
            column = pc.list_flatten(column)
            row = row[parents]
            take = pa.array(parents)
            places = [p[parents] for p in places] + [_place_in_list(parents)]
            entries = [e.take(take) for e in entries] + [column]
        else:
            column = pc.struct_field(column, step)
    return column, row, places, entries


def _type_at(kind: T.DataType, path: list[str]) -> tuple[T.DataType, list[T.DataType]]:
    entered = []
    for step in path:
        if step == "[]":
            if not isinstance(kind, T.ArrayType):
                raise ValueError(f"{kind.simpleString()} is no list")
            kind = kind.elementType
            entered.append(kind)
        else:
            kind = kind[step].dataType
    return kind, entered


def flatten(df: DataFrame, keys: list[str], column: str, path: list[str], value: str = "value", link: str = "pos", carry: dict[str, tuple[int, str]] | None = None) -> DataFrame:
    """The child table at ``path`` of ``column``: ``keys``, one ``<link>_<depth>`` for every list entered, carried fields, ``value``.

    Keys and positions together name the parent of a row at every level, so the tables
    of a longer and a shorter path join on them. ``carry`` gives more columns as
    ``name: (depth, field)``, the field of the entry of the depth-th list (0 is the
    outermost) that the row lies in. Null and empty lists, and null structs on the
    way, have no children; null values at the end are kept. Result columns must not clash: name ``link``, ``value`` and ``carry`` apart from the keys."""
    carry = carry or {}
    kind, entered = _type_at(df.schema[column].dataType, path)
    links = [f"{link}_{i}" for i in range(len(entered))]
    names = [*keys, *links, *carry, value]
    if len(set(names)) < len(names):
        raise ValueError(f"result columns clash: {names}")
    fields = [T.StructField(k, df.schema[k].dataType) for k in keys] + [T.StructField(n, T.LongType()) for n in links]
    fields += [T.StructField(n, entered[i][f].dataType) for n, (i, f) in carry.items()] + [T.StructField(value, kind)]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            end, row, places, entries = flatten_array(b.column(len(keys)), path)
            take = pa.array(row)
            carried = [pc.struct_field(entries[i], f) for i, f in carry.values()]
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(take) for i in range(len(keys))), *(pa.array(p) for p in places), *carried, end], names=names)

    return df.select(*keys, column).mapInArrow(emit, T.StructType(fields))


class _Invalid(ValueError):
    pass


def _refuse(text: str):
    raise _Invalid(text)


def strict_json(text: str):
    """One JSON value, strictly read: no NaN or infinities, nothing before or after but white space. Raises ValueError."""
    try:
        return json.loads(text, parse_constant=_refuse, parse_int=float)
    except RecursionError as e:
        raise _Invalid("nested too deeply") from e


def _named(level) -> Iterator[tuple[str | None, object]]:
    """Entries of an object keyed by name, or of a list of objects with ``name``."""
    if isinstance(level, dict):
        yield from level.items()
    elif isinstance(level, list):
        for x in level:
            if isinstance(x, dict) and isinstance(x.get("name"), str):
                yield x["name"], x


def _entries(value) -> list[str | None]:
    """Names in a list as written: text or objects with ``name``; a list may be text holding JSON, a bare name a list of one."""
    if isinstance(value, str):
        if value.lstrip().startswith("["):
            try:
                inner = strict_json(value)
            except ValueError:
                inner = None
            if isinstance(inner, list):
                return _entries(inner)
        value = [value]
    if isinstance(value, dict):
        value = [value]
    if not isinstance(value, list):
        return []
    names = [x.get("name") if isinstance(x, dict) else x for x in value]
    return [n if isinstance(n, str) and n.strip() else None for n in names]


def named_lists(df: DataFrame, keys: list[str], body: str, levels: dict[str, str], nested: str = "nested") -> DataFrame:
    """``keys`` and ``nested``: for each ``level: list`` of ``levels``, the named parents of that level with their list of names.

    ``nested`` is ``array<struct<kind, parent, entries>>``; null where the body is null, blank or isn't valid JSON."""
    fields = [df.schema[k] for k in keys]

    def decode(text: str | None) -> list | None:
        if text is None or not text.strip():
            return None
        try:
            value = strict_json(text)
        except ValueError:
            return None
        if not isinstance(value, dict):
            return []
        return [(level, parent, _entries(x[field])) for level, field in levels.items() for parent, x in _named(value.get(level)) if isinstance(x, dict) and field in x]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs = [decode(t) for t in b.column(len(keys)).to_pylist()]
            parents = [p for d in docs if d for p in d]
            entries = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(p[2]) for p in parents])].astype(np.int32)), pa.array([n for p in parents for n in p[2]], pa.string()))
            structs = pa.StructArray.from_arrays([pa.array([p[0] for p in parents], pa.string()), pa.array([p[1] for p in parents], pa.string()), entries], ["kind", "parent", "entries"])
            ends = np.r_[0, np.cumsum([len(d or ()) for d in docs])].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), structs, mask=pa.array([d is None for d in docs], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], lists], names=[*keys, nested])

    parent = T.StructType([T.StructField("kind", T.StringType()), T.StructField("parent", T.StringType()), T.StructField("entries", T.ArrayType(T.StringType()))])
    schema = T.StructType([*fields, T.StructField(nested, T.ArrayType(parent))])
    return df.select(*keys, body).mapInArrow(emit, schema)


LEVELS = {"actions": "automl_default_parameters", "models": "actions"}


def manifest_children(df: DataFrame, key: str = "manifest_id", body: str = "body") -> DataFrame:
    """``manifest_id, kind, parent_name, pos, child_name``: every entry of the lists of names, null and blank ones with a null name.

    ``kind`` is ``actions`` (the parent is an action) or ``models`` (a model)."""
    nested = named_lists(df, [key], body, LEVELS)
    flat = flatten(nested, [key], "nested", ["[]", "entries", "[]"], value="child_name", carry={"kind": (0, "kind"), "parent_name": (0, "parent")})
    return flat.select(key, "kind", "parent_name", F.col("pos_1").alias("pos"), "child_name")
