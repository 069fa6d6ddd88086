"""Event logs of runs: attribution to stages, sequence and transition audits, growth and durations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.paths import strip_blank
from gaugeworks.operators.prefix import prefix_sums, with_next_known, with_previous

# fixed values: what may follow each stage of an iteration, in the two pipelines
EDGES_1 = {
    "baseline": {"train": ("evaluate",), "evaluate": ("rca", "loop_stop"), "rca": ("+routing",)},
    "iter": {
        "routing": ("anomalygen", "anomalygen_finetune"), "anomalygen_finetune": ("anomalygen",), "anomalygen": ("data_mining",), "data_mining": ("data_merge",),
        "data_merge": ("train",), "train": ("evaluate",), "evaluate": ("rca", "loop_stop"), "rca": ("+routing",),
    },
}
EDGES_2 = {
    "train": ("evaluate_benchmark",), "evaluate_benchmark": ("benchmark_metrics",), "benchmark_metrics": ("loop_stop", "evaluate_proxy"), "evaluate_proxy": ("proxy_rcca",),
    "proxy_rcca": ("loop_stop", "+routing"), "routing": ("anomalygen",), "anomalygen": ("data_mining",), "data_mining": ("assemble_data",), "assemble_data": ("validate_data",), "validate_data": ("train",),
}


def iteration_number(col: Column) -> Column:
    """0 for ``baseline``, n for ``iterN``, null for anything else."""
    c = F.lower(strip_blank(col))
    return F.when(c == "baseline", 0).otherwise(F.regexp_extract(c, r"^iter(\d{1,9})$", 1).try_cast("int"))


def in_iteration_order(df: DataFrame, col: str) -> DataFrame:
    return df.orderBy(F.coalesce(iteration_number(F.col(col)), F.lit(1 << 30)), col)


def attribute(messages: DataFrame, stages: DataFrame, by: list[str], time: str = "ts", stage: str = "stage_id") -> DataFrame:
    """``messages`` with the stage each belongs to: the first stage of its group that ends at or after it; null after the last.

    Both sides are put in one order of time and the next stage is carried back, so it's a sort and no range join."""
    m = messages.withColumn("_stage", F.lit(None).cast(stages.schema[stage].dataType))
    s = stages.select(*by, time, F.col(stage).alias("_stage"))
    both = m.withColumn("_m", F.lit(0)).unionByName(s.withColumn("_m", F.lit(1)), allowMissingColumns=True)  # at one time messages come first
    return with_next_known(both, by, [time, "_m", "_stage"], "_stage", stage).where("_m = 0").drop("_m", "_stage")


#: Token counts of a message.
USAGE = ("input_tokens", "output_tokens", "cache_read", "cache_create", "create_5m", "create_1h")


def usage_per_stage(attributed: DataFrame, stages: DataFrame, by: list[str], stage: str = "stage_id", time: str = "ts", model: str = "model") -> DataFrame:
    """Of every stage: messages, the sum of each count of ``USAGE``, ``context_end`` (what the last message read) and ``models`` in the order first seen.

    Where cache creation isn't broken down, all of it counts as ``create_5m``. A stage without a message has zeros and no model."""
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    whole = (n("cache_create") > 0) & (n("create_5m") == 0) & (n("create_1h") == 0)
    a = attributed.where(F.col(stage).isNotNull()).withColumns({"create_5m": F.when(whole, n("cache_create")).otherwise(n("create_5m")), "_context": n("input_tokens") + n("cache_read") + n("cache_create")})
    sums = [F.sum(n(c)).alias(c) for c in USAGE]
    each = a.groupBy(*by, stage, model).agg(F.count("*").alias("messages"), F.min(time).alias("_first"), F.max(F.struct(F.col(time), F.col("_context"))).alias("_last"), *sums)
    seen = F.transform(F.array_sort(F.collect_list(F.when(F.col(model).isNotNull(), F.struct("_first", F.col(model).alias("m"))))), lambda x: x["m"])
    used = each.groupBy(*by, stage).agg(F.sum("messages").alias("messages"), F.max("_last")["_context"].alias("context_end"), seen.alias("models"), *(F.sum(c).alias(c) for c in USAGE))
    zero = [n(c).alias(c) for c in ("messages", "context_end", *USAGE)]
    return stages.select(*by, stage).join(used, [*by, stage], "left").select(*by, stage, *zero, F.coalesce("models", F.array().cast("array<string>")).alias("models"))


def sequence_gaps(log: DataFrame, by: list[str], seq: str = "seq", resync: bool = True) -> DataFrame:
    """Rows whose ``seq`` isn't one more than the row before (1 for the first): with ``expected``.

    Without ``resync`` the count goes on from the start, so one gap marks every later row."""
    order = [seq, *(["log_id"] if "log_id" in log.columns else [])]
    if resync:
        with_seq = with_previous(log, by, order, [seq])
        numbered = with_seq.withColumn("expected", F.coalesce(F.col(f"prev_{seq}") + 1, F.lit(1))).drop(f"prev_{seq}", "prev_row")
    else:
        ranked = prefix_sums(log, [*by, *order], {"_n": F.lit(1).cast("long")})
        first = ranked.groupBy(*(F.col(c).alias(f"_{c}") for c in by)).agg(F.min("_n").alias("_first"))
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        numbered = ranked.join(first, same).withColumn("expected", F.col("_n") - F.col("_first") + 1).select(*log.columns, "expected")
    return numbered.where(F.col(seq) != F.col("expected"))


def legal_steps(edges: dict, two_level: bool) -> list[tuple[str | None, str, str, int]]:
    """Edge table ``(kind, from, to, step)``: step 1 goes to the next iteration."""
    flat = [(kind, a, b) for kind, m in edges.items() for a, bs in m.items() for b in bs] if two_level else [(None, a, b) for a, bs in edges.items() for b in bs]
    return [(kind, a, b.lstrip("+"), int(b.startswith("+"))) for kind, a, b in flat]


def transitions(log: DataFrame, by: list[str], edges: dict | None = None) -> DataFrame:
    """Each event with the event before it in its run, and whether the step is ``legal``; first events have no step.

    After an error only ``loop_stop`` of the same iteration may follow, after ``loop_stop`` nothing."""
    two_level = edges is None
    steps = legal_steps(EDGES_1 if edges is None else edges, two_level)
    e = with_previous(log.withColumn("n", iteration_number(F.col("iter"))), by, ["seq", "log_id"], ["stage", "status", "n"])
    step = F.col("n") - F.col("prev_n")
    legal = F.lit(False)
    for kind, a, b, move in steps:
        here = (F.col("prev_stage") == a) & (F.col("stage") == b) & (step == move)
        if kind is not None:
            here = here & ((F.col("prev_n") == 0) if kind == "baseline" else (F.col("prev_n") > 0))
        legal = legal | here
    after_error = (F.col("stage") == "loop_stop") & (step == 0)
    legal = F.when(F.col("prev_stage") == "loop_stop", F.lit(False)).when(F.col("prev_status") == "error", after_error).otherwise(legal)
    return e.withColumn("legal", F.when(F.col("prev_row"), F.coalesce(legal, F.lit(False)))).drop("prev_row")


def continued_after_stop(log: DataFrame, passed: DataFrame, by: list[str], pairs: tuple[tuple[str, str], ...]) -> DataFrame:
    """Adjacent events of ``pairs`` in runs and iterations that had already passed (``by, n``)."""
    e = with_previous(log.withColumn("_n", iteration_number(F.col("iter"))), by, ["seq", "log_id"], ["stage", "_n"]).withColumn("n", F.col("prev__n"))
    hit = F.lit(False)
    for a, b in pairs:
        hit = hit | ((F.col("prev_stage") == a) & (F.col("stage") == b))
    return e.where(hit).join(passed, [*by, "n"], "left_semi")


def skipped_without_evidence(log: DataFrame, by: list[str], stage: str, evidence: DataFrame) -> DataFrame:
    """Iterations after the first that never ran ``stage`` although the iteration before had something for it.

    ``evidence`` has ``by, n, items``: how many items iteration n handed on. Iterations count from the log."""
    n = iteration_number(F.col("iter"))
    ran = log.withColumn("n", n).where("n > 0").groupBy(*by, "n").agg(F.count_if(F.col("stage") == stage).alias("times"))
    handed = evidence.select(*by, (F.col("n") + 1).alias("n"), "items")
    return ran.where("times = 0").join(handed, [*by, "n"]).where("items > 0").select(*by, "n", "items")


def last_ok_stage(log: DataFrame, by: list[str]) -> DataFrame:
    return log.where((F.col("status") == "ok") & (F.col("stage") != "loop_stop")).groupBy(*by).agg(F.max_by("stage", F.struct("seq", "log_id")).alias("last_ok"))


def latest(df: DataFrame, by: list[str], value: str, order: list[str]) -> DataFrame:
    """The last value of each group, and how many there were."""
    return df.groupBy(*by).agg(F.max_by(value, F.struct(*order)).alias("latest"), F.count("*").alias("n"))


def moved_after_end(df: DataFrame, by: list[str], state: str, order: list[str], final: tuple[str, ...]) -> DataFrame:
    """Changes of state that follow a final one."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_done", F.max(F.col(state).isin(*final).cast("int")).over(w)).where("_done = 1").drop("_done")


def durations(log: DataFrame, by: list[str], seconds: str = "duration_sec") -> DataFrame:
    """Total, mean rounded half to even with 1 as its least, and missing durations of each group."""
    s = F.col(seconds)
    return log.groupBy(*by).agg(F.sum(s).alias("total_sec"), F.greatest(F.lit(1).cast("double"), F.bround(F.avg(s))).alias("mean_sec"), F.count_if(s.isNull()).alias("missing"))


def growth(totals: DataFrame, by: list[str], order: str, total: str) -> DataFrame:
    """``new_unique``: the total less the last known one before it; null where that is negative or there's none."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    d = F.col(total) - F.last(total, ignorenulls=True).over(w)
    return totals.withColumn("new_unique", F.when(d >= 0, d))


def against_first(values: DataFrame, by: list[str], order: str, value: str, better: str = ">") -> DataFrame:
    """The difference to the group's first value and whether it's an improvement."""
    w = Window.partitionBy(*by).orderBy(order)
    d = F.col(value) - F.first(value).over(w)
    good = d > 0 if better in (">", ">=") else d < 0
    return values.withColumns({"delta": d, "improved": good, "regressed": (d != 0) & ~good})


def yield_drops(kept: DataFrame, by: list[str], order: str, n: str, least: float = 0.5) -> DataFrame:
    """Rows that kept less than ``least`` of what the row before kept."""
    before = with_previous(kept, by, [order], [n]).withColumnRenamed(f"prev_{n}", "before").drop("prev_row")
    return before.where(F.col(n) < F.lit(least) * F.col("before"))


def state_against_log(states: DataFrame, log: DataFrame, key: list[str]) -> DataFrame:
    """Keys of either side with ``verdict``: both, state_only, log_only."""
    s, g = states.select(*key).distinct().withColumn("_s", F.lit(1)), log.select(*key).distinct().withColumn("_l", F.lit(1))
    v = F.when(F.col("_s").isNull(), "log_only").when(F.col("_l").isNull(), "state_only").otherwise("both")
    return s.join(g, key, "full_outer").select(*key, v.alias("verdict"))


def run_status(log: DataFrame, violations: DataFrame, by: list[str]) -> DataFrame:
    """INVALID with any violation; else FAILED, COMPLETE or IN_PROGRESS by error events and how the run ended."""
    last = F.struct("seq", "log_id")
    r = log.groupBy(*by).agg(F.max_by("stage", last).alias("last_stage"), F.max_by("status", last).alias("last_status"), F.count_if(F.col("status") == "error").alias("errors"))
    bad = violations.select(*by).distinct().withColumn("_bad", F.lit(True))
    ended = F.col("last_stage") == "loop_stop"
    status = (
        F.when(F.col("_bad"), "INVALID").when(ended & (F.col("errors") > 0), "FAILED").when(ended & (F.col("last_status") == "ok"), "COMPLETE").when(F.col("last_status") == "error", "FAILED").otherwise("IN_PROGRESS")
    )
    return r.join(bad, by, "left").select(*by, "last_stage", "errors", status.alias("run_status"))


def sliding_windows(series: DataFrame, by: list[str], order: str, value: str, length: int, stride: int) -> DataFrame:
    """``window_no, start_at, values``: every ``stride``-th run of ``length`` successive values of a group, complete ones only."""
    w = Window.partitionBy(*by).orderBy(order)
    r = series.withColumns({"_rn": F.row_number().over(w) - 1, "values": F.collect_list(value).over(w.rowsBetween(0, length - 1)), "start_at": F.col(order)})
    full = (F.pmod("_rn", F.lit(stride)) == 0) & (F.size("values") == length)
    return r.where(full).select(*by, (F.col("_rn") / stride).cast("long").alias("window_no"), "start_at", "values")
