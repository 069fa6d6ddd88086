"""Run logs as a stream: files are audited as they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "log_id long, run_id string, seq int, ts timestamp, iter string, stage string, status string, summary string, duration_sec int, context_tokens int"


def read_log(spark: SparkSession, path: str, schema: str = LOG, fmt: str = "parquet", files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(path)


def stage_counts(log: DataFrame, delay: str = "1 day", window: str = "1 day") -> DataFrame:
    """Events and errors by time window and stage; rows later than ``delay`` are left out, repeated deliveries count once."""
    once = log.withWatermark("ts", delay).dropDuplicates(["log_id", "ts"])
    return once.groupBy(F.window("ts", window), "stage").agg(F.count("*").alias("events"), F.count_if(F.col("status") == "error").alias("errors")).select(F.col("window.start").alias("window_start"), "stage", "events", "errors")


def sequence_alarms(log: DataFrame) -> DataFrame:
    """``run_id, seq, expected``: an event whose number isn't the next of its run, with state kept per run."""

    def check(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else 0
        rows = []
        for seq in sorted(x for b in batches for x in b["seq"].dropna()):
            if seq != last + 1:
                rows.append((key[0], int(seq), last + 1))
            last = int(seq)
        state.update((last,))
        yield pd.DataFrame(rows, columns=["run_id", "seq", "expected"])

    return log.groupBy("run_id").applyInPandasWithState(check, "run_id string, seq int, expected int", "last int", "append", "NoTimeout")
