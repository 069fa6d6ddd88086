"""Writing results: ordered columns, stable JSON, split outcomes and appended logs."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.prefix import prefix_sums
from gaugeworks.session import materialize


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """CSV with a header. ``columns`` come first, in their order, each once; lists, maps and structs are written as JSON."""
    order = list(dict.fromkeys([*(columns or []), *df.columns]))
    nested = {f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct", "variant")}
    df.select(*(F.to_json(c).alias(c) if c in nested else c for c in order)).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Parquet by Spark's commit protocol: readers see all of it or none. An empty frame keeps its schema."""
    df.write.mode("overwrite").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines with keys in sorted order."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def json_array(df: DataFrame, order: list[str]) -> DataFrame:
    """``element`` lines of one JSON array in order: brackets and commas are part of the lines, so the array is written without being held anywhere."""
    numbered = prefix_sums(df, order, {"_n": F.lit(1).cast("long")})
    n = df.count()
    text = F.concat(F.when(F.col("_n") == 0, "[").otherwise(""), F.to_json(F.struct(*df.columns)), F.when(F.col("_n") == n - 1, "]").otherwise(","))
    return numbered.orderBy("_n").select(text.alias("element"))


def write_outcomes(df: DataFrame, ok, path: str) -> None:
    """Rows in two directories, ``generated`` and ``failed``, in one pass over the input."""
    df.withColumn("outcome", F.when(ok, "generated").otherwise("failed")).write.mode("overwrite").partitionBy("outcome").parquet(path)


def append_log(spark: SparkSession, path: str, events: DataFrame, schema: str) -> int:
    """Append events (``ord`` gives their order) with the next sequence numbers; returns the last one. A single writer is assumed.

    A log with a number missing at its end or a corrupt row is refused."""
    last = 0
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        old = spark.read.schema(schema).parquet(path).agg(F.max("seq").alias("last"), F.count("seq").alias("n"), F.count("*").alias("all")).first()
        if old["n"] != old["all"] or (old["last"] or 0) != old["n"]:
            raise ValueError("the log has gaps or rows without a number")
        last = old["last"] or 0
    numbered = materialize(prefix_sums(events, ["ord"], {"seq": F.lit(1).cast("long")}).withColumn("seq", F.col("seq") + 1 + F.lit(last)).drop("ord"))
    numbered.write.mode("append").parquet(path)
    return last + numbered.count()


def write_record(spark: SparkSession, path: str, record: dict, create: bool = False) -> bool:
    """One JSON record, whole or not at all: written beside its place, then renamed. With ``create`` an existing record is left as it is, and False returned."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target, part = fs_path(path), fs_path(f"{path}.{uuid.uuid4().hex}.part")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if create and fs.exists(target):
        return False
    out = fs.create(part, True)
    out.write(bytearray((json.dumps(record, sort_keys=True) + "\n").encode()))
    out.close()
    if not create and fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(part, target):
        fs.delete(part, False)
        return False
    return True
