"""Prefix sums, and neighbours in an order, without a window whose groups must fit one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.session import materialize


def prefix_sums(df: DataFrame, order: list, sums: dict[str, Column]) -> DataFrame:
    """``df`` with, for each entry of ``sums``, the sum of that value over all rows before (exclusive).

    Two passes: rows are range-partitioned and sorted by ``order`` (which must be total, else ties
    fall either way), and each partition adds up its own values while it's written; the totals of the
    partitions - one row each, so as many as shuffle partitions - are added up on the driver and
    put on top as the rows are read again. Rows are shuffled once, and no task holds more than
    one range. An empty input gives no rows; null values count as 0."""
    kinds = {k: "long" if df.select(v.alias("x")).schema["x"].dataType.typeName() in ("byte", "short", "integer", "long") else "double" for k, v in sums.items()}
    values = [F.coalesce(v, F.lit(0)).cast(kinds[k]).alias(f"_v_{k}") for k, v in sums.items()]
    ranged = df.select("*", *values).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    n, width = len(sums), len(df.columns)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = [0] * n
        for b in batches:
            before = []
            for i in range(n):
                v = np.asarray(b.column(width + i))
                total = np.cumsum(v)
                before.append(pa.array(run[i] + total - v))
                run[i] += total[-1] if len(v) else 0
            yield pa.RecordBatch.from_arrays([*b.columns, *before], names=names)

    schema = T.StructType([*ranged.schema.fields, *(T.StructField(f"_c_{k}", ranged.schema[f"_v_{k}"].dataType) for k in sums)])
    names = schema.names
    ranged = materialize(ranged.mapInArrow(add_up, schema))
    totals = sorted(ranged.groupBy("_part").agg(*(F.sum(f"_v_{k}").alias(k) for k in sums)).collect(), key=lambda r: r["_part"])
    run, rows = {k: 0 for k in sums}, []
    for r in totals:
        rows.append((r["_part"], *(float(x) if kinds[k] == "double" else x for k, x in run.items())))
        run = {k: run[k] + r[k] for k in sums}
    offsets = df.sparkSession.createDataFrame(rows, ", ".join(["_part int", *(f"_o_{k} {kinds[k]}" for k in sums)]))
    joined = ranged.join(F.broadcast(offsets), "_part")
    return joined.select(*(F.col(f"`{c}`") for c in df.columns if c not in sums), *((F.col(f"_o_{k}") + F.col(f"_c_{k}")).alias(k) for k in sums))


def _ranged(df: DataFrame, order: list) -> DataFrame:
    """``df`` range-partitioned by ``order`` and written, with the partition of each row as ``_part``.

    The number of partitions is left to the session; where they are small, neighbours are merged."""
    return materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))


def _same_group(by: list[str], other: str) -> Column:
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"{other}.{c}"))
    return same


def with_previous(df: DataFrame, by: list[str], order: list[str], columns: list[str], prefix: str = "prev_") -> DataFrame:
    """``df`` with ``<prefix><column>`` of the row before in its group, and ``<prefix>row``: whether there is one.

    Like ``lag``, but a group may span partitions: only the last row of each range
    partition is carried to the next, so a group of any size is shared out. Nulls sort first."""
    keys = list(dict.fromkeys([*by, *order]))
    ranged = _ranged(df, keys)
    row = F.struct(*keys, *(c for c in columns if c not in keys))
    ends = sorted(ranged.groupBy("_part").agg(F.max(row).alias("last")).collect(), key=lambda r: r["_part"])
    kind = ranged.select(row.alias("last")).schema["last"].dataType
    carried = [(b["_part"], a["last"]) for a, b in zip(ends, ends[1:])]
    carry = df.sparkSession.createDataFrame(carried, T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_carry", kind)]))
    w = Window.partitionBy("_part").orderBy(*keys)
    out = ranged.join(F.broadcast(carry), "_part", "left").withColumn("_prev", F.coalesce(F.lag(row).over(w), F.col("_carry")))
    out = out.withColumn("_prev", F.when(_same_group(by, "_prev"), F.col("_prev")))
    return out.select(*df.columns, *(F.col(f"_prev.{c}").alias(prefix + c) for c in columns), F.col("_prev").isNotNull().alias(f"{prefix}row"))


def with_next_known(df: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the first ``value`` that isn't null in this row or after it in its group.

    A window within each range partition, and one value a partition carried back over partitions."""
    keys = list(dict.fromkeys([*by, *order]))
    ranged = _ranged(df, keys)
    group = F.struct(*by)
    known = F.struct(group.alias("group"), F.struct(*keys).alias("at"), F.col(value).alias("value"))
    parts = sorted(ranged.groupBy("_part").agg(F.min(group).alias("first"), F.max(group).alias("last"), F.min(F.when(F.col(value).isNotNull(), known)).alias("known")).collect(), key=lambda r: r["_part"])
    carried, reach = [], None  # reach: (group, value) that the partitions before this one see next
    for p in reversed(parts):
        carried.append((p["_part"], reach[0], reach[1]) if reach and reach[0] == p["last"] else (p["_part"], None, None))
        if p["known"] is not None and p["known"]["group"] == p["first"]:
            reach = (p["first"], p["known"]["value"])
        elif not (reach and reach[0] == p["first"] == p["last"]):
            reach = None
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_group", ranged.select(group.alias("g")).schema["g"].dataType), T.StructField("_after", ranged.schema[value].dataType)])
    carry = df.sparkSession.createDataFrame(carried, schema)
    # from the end of the order, so that what is known next runs along; keys of descending order put nulls last, where ascending ones put them first
    w = Window.partitionBy("_part", *by).orderBy(*(F.col(k).desc() for k in keys)).rowsBetween(Window.unboundedPreceding, 0)
    after = F.when(group == F.col("_group"), F.col("_after"))
    out = ranged.join(F.broadcast(carry), "_part", "left").withColumn(name, F.coalesce(F.last(value, ignorenulls=True).over(w), after))
    return out.select(*df.columns, name)
