"""References to records that do not exist, and what hangs on them.

:func:`check_references` decides every reference as of its own time in one global
order of (key, time): the lives of the targets and the references are events, and
running sums of what exists, has started and is there tell each reference its
answer. Every life takes back what it added before its key ends, so the sums need
no grouping, and a key that holds a third of all rows is spread over many tasks.

:func:`cascade` follows the foreign-key graph to its fixpoint: rows that depend on an
orphaned record are orphaned indirectly, level by level, by semi-joins on the groups
through which records depend on each other; a hot group is one key there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.paths import path_key, strip_blank
from gaugeworks.operators.prefix import prefix_sums
from gaugeworks.session import materialize

_FIRST, _LAST = -(1 << 62), 1 << 62
HOPS = 4


def references(df: DataFrame, table: str, row_key: str, field: str, key: Column, time: str) -> DataFrame:
    """``src_table, row_key, ref_field, key, at``: the references of one field; null and blank ones are none."""
    return df.select(F.lit(table).alias("src_table"), F.col(row_key).cast("long").alias("row_key"), F.lit(field).alias("ref_field"), F.nullif(key, F.lit("")).alias("key"), F.col(time).cast("timestamp").alias("at")).where("key is not null")


def lives(df: DataFrame, key: Column, start: str, end: str) -> DataFrame:
    """``key, start, end`` of target rows; an end of null is open, a start of null never comes."""
    return df.select(F.nullif(key, F.lit("")).alias("key"), F.col(start).cast("timestamp").alias("start"), F.col(end).cast("timestamp").alias("end")).where("key is not null")


def check_references(refs: DataFrame, targets: DataFrame) -> DataFrame:
    """``refs`` with ``orphan_reason``: null (it holds), ``missing``, ``deleted`` or ``late``.

    A reference without a time never holds: ``missing``, or ``late`` where its key exists."""
    hashed = [F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2")]
    us = lambda c: F.unix_micros(c)
    started = F.col("start").isNotNull()
    there = started & (F.col("end").isNull() | (F.col("end") > F.col("start")))

    def event(when: Column, there_: Column | int, started_: Column | int, exists_: int, on: Column) -> Column:
        one = lambda x: (F.lit(x) if isinstance(x, int) else x).cast("long")
        return F.when(on, F.struct(when.cast("long").alias("t"), one(there_).alias("there"), one(started_).alias("started"), one(exists_).alias("exists")))

    yes, no = F.lit(True), F.lit(0)
    events = F.array_compact(
        F.array(
            event(F.lit(_FIRST), 0, 0, 1, yes),
            event(us(F.col("start")), F.when(there, 1).otherwise(no), 1, 0, started),
            event(us(F.col("end")), -1, 0, 0, there & F.col("end").isNotNull()),
            event(F.lit(_LAST), F.when(there & F.col("end").isNull(), -1).otherwise(no), F.when(started, -1).otherwise(no), -1, yes),
        )
    )
    lived = targets.select(*hashed, F.explode(events).alias("e")).select("k1", "k2", "e.*")
    lived = lived.groupBy("k1", "k2", "t").agg(*(F.sum(c).alias(c) for c in ("there", "started", "exists")))
    zero = [F.lit(0).cast("long").alias(c) for c in ("there", "started", "exists")]
    asked = refs.select(*hashed, F.coalesce(us(F.col("at")), F.lit(_FIRST + 1)).alias("t"), *zero, F.struct("src_table", "row_key", "ref_field", "key", "at").alias("ref"))
    # written before it's ranged, as the ranges are found by a look at all rows: paths are read once
    both = materialize(lived.withColumn("ref", F.lit(None).cast(asked.schema["ref"].dataType)).unionByName(asked))
    # at one time the targets' events come before the references
    ordered = prefix_sums(both, ["k1", "k2", "t", F.col("ref").isNotNull(), "ref.src_table", "ref.row_key", "ref.ref_field"], {f"sum_{c}": F.col(c) for c in ("there", "started", "exists")})
    reason = F.when(F.col("sum_there") > 0, F.lit(None)).when(F.col("sum_started") > 0, "deleted").when(F.col("sum_exists") > 0, "late").otherwise("missing")
    return ordered.where("ref is not null").select("ref.*", reason.alias("orphan_reason"))


def cascade(orphans: DataFrame, records: DataFrame) -> DataFrame:
    """``src_table, row_key, depth`` of the records orphaned through others (depth 1: through a direct orphan).

    ``orphans`` names the direct ones (``src_table, row_key``); ``records`` has
    ``src_table, row_key, own, up``: the group a record stands for and the group it
    depends on, either null. Cycles end, as a record is taken once."""
    key = ["src_table", "row_key"]
    direct = materialize(orphans.select(*key).distinct())
    edges = materialize(records.where("own is not null and up is not null").select("up", F.col("own").alias("g")).distinct())
    # the walk is over groups; a group is orphaned with the first of its records
    frontier = materialize(records.where("own is not null").join(direct, key, "left_semi").select(F.col("own").alias("g")).distinct().withColumn("depth", F.lit(0)))
    seen, depth = frontier, 0
    while not frontier.isEmpty():
        level, found = frontier, None
        for _ in range(HOPS):  # so many levels in one job; what was seen before is left out once, at its end
            depth += 1
            level = edges.join(level.select(F.col("g").alias("up")), "up", "left_semi").select("g").distinct()
            step = level.withColumn("depth", F.lit(depth))
            found = step if found is None else found.unionByName(step)
        found = materialize(found.groupBy("g").agg(F.min("depth").alias("depth")).join(seen.select("g"), "g", "left_anti"))
        seen = seen.unionByName(found)
        frontier = found.where(F.col("depth") == depth)
    inherited = records.where("up is not null").join(seen.select(F.col("g").alias("up"), "depth"), "up")
    return inherited.groupBy(*key).agg((F.min("depth") + 1).alias("depth")).join(direct, key, "left_anti")


def direct_orphans(iterations: DataFrame, log: DataFrame, artifacts: DataFrame, stages: DataFrame) -> DataFrame:
    """``src_table, row_key, ref_field, orphan_reason, ref_month`` of the references of the run tables that don't hold: where the cascade starts."""
    stage = lambda c: F.nullif(F.lower(strip_blank(F.col(c))), F.lit(""))
    into = lambda kind, k: F.concat(F.lit(kind + ":"), k)  # noqa: E731  # both targets in one order; null stays null
    refs = references(log, "loop_log", "log_id", "stage", into("stage", stage("stage")), "ts")
    for f in ("best_ckpt_path", "inference_csv"):
        refs = refs.unionByName(references(iterations, "deft_iterations", "state_id", f, into("file", path_key(F.col(f))), "updated_at"))
    files = lives(artifacts, into("file", path_key(F.col("artifact_path"))), "created_at", "deleted_at")
    targets = files.unionByName(lives(stages, into("stage", stage("stage_name")), "introduced_at", "retired_at"))
    checked = check_references(refs, targets).where("orphan_reason is not null")
    return checked.select("src_table", "row_key", "ref_field", "orphan_reason", F.date_format("at", "yyyy-MM").alias("ref_month"))


def run_orphans(iterations: DataFrame, log: DataFrame, artifacts: DataFrame, stages: DataFrame) -> DataFrame:
    """``src_table, row_key, ref_field, orphan_reason, ref_month, orphan_kind, depth`` over the run tables: the whole cascade.

    Direct orphans (:func:`direct_orphans`, depth 0) have their reason. Inherited ones have no field or
    reason: an iteration's state depends on the iteration before it, a log event on the state of its iteration."""
    direct = materialize(direct_orphans(iterations, log, artifacts, stages))
    number = F.when(F.lower(strip_blank(F.col("iter"))) == "baseline", 0).otherwise(F.regexp_extract(F.lower(strip_blank(F.col("iter"))), r"^iter(\d{1,9})$", 1).try_cast("int"))
    group = lambda n: F.when(F.col("run_id").isNotNull() & n.isNotNull(), F.struct(F.col("run_id").alias("run"), n.cast("int").alias("n")))
    states = iterations.select(F.lit("deft_iterations").alias("src_table"), F.col("state_id").cast("long").alias("row_key"), group(number).alias("own"), group(number - 1).alias("up"), F.col("updated_at").alias("at"))
    events = log.select(F.lit("loop_log").alias("src_table"), F.col("log_id").cast("long").alias("row_key"), F.lit(None).cast(states.schema["own"].dataType).alias("own"), group(number).alias("up"), F.col("ts").alias("at"))
    records = materialize(states.unionByName(events))
    inherited = cascade(direct, records.drop("at")).join(records.select("src_table", "row_key", "at"), ["src_table", "row_key"])
    none = F.lit(None).cast("string")
    return direct.select("*", F.lit("direct").alias("orphan_kind"), F.lit(0).alias("depth")).unionByName(
        inherited.select("src_table", "row_key", none.alias("ref_field"), none.alias("orphan_reason"), F.date_format("at", "yyyy-MM").alias("ref_month"), F.lit("inherited").alias("orphan_kind"), "depth")
    )
