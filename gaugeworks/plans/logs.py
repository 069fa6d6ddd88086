"""Run-log analytics over ``loop_log``, ``deft_iterations`` and ``events`` (purchases end stages, other events are messages)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.operators import runlog as rl
from gaugeworks.plans.base import Module, rounded

M = Module()
add = M.add

_N = "case when lower(trim(iter)) = 'baseline' then 0 else try_cast(nullif(regexp_extract(lower(trim(iter)), '^iter(\\d{1,9})$', 1), '') as int) end"


@add("win_iteration_order", f"select log_id, {_N} n from loop_log")
def _(t):
    return t("loop_log").select("log_id", rl.iteration_number(F.col("iter")).alias("n"))


_ST = "with st as (select user_id, ts, event_id stage_id from events where event_type = 'purchase'), m as (select user_id, ts, event_id, value, event_type from events where event_type <> 'purchase'), a as (select m.*, st.stage_id from m asof left join st on m.user_id = st.user_id and st.ts >= m.ts)"


def attributed(t):
    e = t("events")
    stages = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("stage_id"))
    messages = e.where("event_type <> 'purchase'").select("user_id", "ts", "event_id", "value", "event_type")
    return rl.attribute(messages, stages, ["user_id"]), stages


@add("join_interval_asof", _ST + " select event_id, stage_id from a")
def _(t):
    return attributed(t)[0].select("event_id", "stage_id")


@add("agg_token_usage", _ST + """, u as (select *, (event_id % 90)::bigint i, (event_id % 7)::bigint o, (event_id % 50)::bigint r, (event_id % 3)::bigint c, case when event_id % 2 = 0 then (event_id % 3)::bigint else 0 end h from a where stage_id is not null),
f as (select *, case when c > 0 and h = 0 then c else 0 end m from u), l as (select user_id, stage_id, list(event_type order by t) models from (select user_id, stage_id, event_type, min(ts) t from f group by all) group by all),
g as (select user_id, stage_id, count(*) messages, arg_max(i + r + c, (ts, i + r + c)) context_end, sum(i)::bigint input_tokens, sum(o)::bigint output_tokens, sum(r)::bigint cache_read, sum(c)::bigint cache_create, sum(m)::bigint create_5m, sum(h)::bigint create_1h from f group by all)
select user_id, stage_id, coalesce(messages, 0) messages, coalesce(context_end, 0) context_end, coalesce(input_tokens, 0) input_tokens, coalesce(output_tokens, 0) output_tokens, coalesce(cache_read, 0) cache_read, coalesce(cache_create, 0) cache_create, coalesce(create_5m, 0) create_5m, coalesce(create_1h, 0) create_1h, coalesce(array_to_string(models, ','), '') models from st left join g using (user_id, stage_id) left join l using (user_id, stage_id)""")
def _(t):
    a, stages = attributed(t)
    e = F.col("event_id")
    a = a.withColumns({"input_tokens": e % 90, "output_tokens": e % 7, "cache_read": e % 50, "cache_create": e % 3, "create_5m": F.lit(0).cast("long"), "create_1h": F.when(e % 2 == 0, e % 3).otherwise(0)})
    return rl.usage_per_stage(a, stages, ["user_id"], model="event_type").withColumn("models", F.array_join("models", ","))


@add("win_seq_gap", "select log_id, seq, expected from (select log_id, seq, coalesce(lag(seq) over w + 1, 1) expected from loop_log window w as (partition by run_id order by seq nulls first, log_id)) where seq <> expected")
def _(t):
    return rl.sequence_gaps(t("loop_log"), ["run_id"]).select("log_id", "seq", "expected")


@add("win_seq_gap_strict", "select log_id, seq, expected::int expected from (select log_id, seq, row_number() over (partition by run_id order by seq nulls first, log_id) expected from loop_log) where seq <> expected")
def _(t):
    return rl.sequence_gaps(t("loop_log"), ["run_id"], resync=False).select("log_id", "seq", "expected")


def _edges(two_level: bool) -> str:
    rows = rl.legal_steps(rl.EDGES_1 if two_level else rl.EDGES_2, two_level)
    return ", ".join(f"({'null' if k is None else repr(k)}, '{a}', '{b}', {s})" for k, a, b, s in rows)


_TR = f"""with e as (select *, {_N} n from loop_log), w as (select *, lag(stage) over o prev_stage, lag(status) over o prev_status, lag(n) over o prev_n, row_number() over o rn from e window o as (partition by run_id order by seq nulls first, log_id)),
x(kind, a, b, s) as (values EDGES),
v as (select log_id, rn, case when rn = 1 then null when prev_stage = 'loop_stop' then false when prev_status = 'error' then coalesce(stage = 'loop_stop' and n - prev_n = 0, false)
 else exists (select 1 from x where a = prev_stage and b = stage and s = n - prev_n and (kind is null or (kind = 'baseline' and prev_n = 0) or (kind = 'iter' and prev_n > 0))) end legal from w)
select log_id, legal from v"""


@add("win_transition_legal", _TR.replace("EDGES", _edges(True)))
def _(t):
    return rl.transitions(t("loop_log"), ["run_id"]).select("log_id", "legal")


@add("win_transition_legal_2", _TR.replace("EDGES", _edges(False)))
def _(t):
    return rl.transitions(t("loop_log"), ["run_id"], rl.EDGES_2).select("log_id", "legal")


@add("win_no_continue", f"with p as (select distinct run_id, {_N} n from deft_iterations where status = 'complete'), e as (select log_id, run_id, stage, lag(stage) over o ps, lag({_N}) over o n from loop_log window o as (partition by run_id order by seq nulls first, log_id)) select log_id from e semi join p using (run_id, n) where (ps, stage) in (('benchmark_metrics', 'evaluate_proxy'), ('rca', 'routing'))")
def _(t):
    passed = t("deft_iterations").where("status = 'complete'").select("run_id", rl.iteration_number(F.col("iter")).alias("n")).distinct()
    return rl.continued_after_stop(t("loop_log"), passed, ["run_id"], (("benchmark_metrics", "evaluate_proxy"), ("rca", "routing"))).select("log_id")


@add("dq_skip_evidence", f"with l as (select run_id, {_N} n, count(*) filter (stage = 'anomalygen') times from loop_log where {_N} > 0 group by all), e as (select run_id, {_N} + 1 n, count(*) filter (inference_csv is not null) items from deft_iterations where {_N} is not null group by all) select run_id, n, items from l join e using (run_id, n) where times = 0 and items > 0")
def _(t):
    n = rl.iteration_number(F.col("iter"))
    evidence = t("deft_iterations").withColumn("n", n).where("n is not null").groupBy("run_id", "n").agg(F.count("inference_csv").alias("items"))
    return rl.skipped_without_evidence(t("loop_log"), ["run_id"], "anomalygen", evidence)


@add("win_last_ok_stage", "select run_id, iter, stage last_ok from (select *, row_number() over (partition by run_id, iter order by seq desc nulls last, log_id desc) n from loop_log where status = 'ok' and stage <> 'loop_stop') where n = 1")
def _(t):
    return rl.last_ok_stage(t("loop_log"), ["run_id", "iter"])


@add("win_latest_state", "select run_id, iter, status latest, n from (select run_id, iter, status, count(*) over (partition by run_id, iter) n, row_number() over (partition by run_id, iter order by updated_at desc, state_id desc) r from deft_iterations) where r = 1")
def _(t):
    return rl.latest(t("deft_iterations"), ["run_id", "iter"], "status", ["updated_at", "state_id"])


@add("win_terminal_moves", "select state_id from (select state_id, max((status in ('complete', 'failed'))::int) over (partition by run_id, iter order by updated_at, state_id rows between unbounded preceding and 1 preceding) d from deft_iterations) where d = 1")
def _(t):
    return rl.moved_after_end(t("deft_iterations"), ["run_id", "iter"], "status", ["updated_at", "state_id"], ("complete", "failed")).select("state_id")


@add("agg_durations", "select run_id, sum(duration_sec)::bigint total_sec, greatest(1.0, round_even(avg(duration_sec), 0)) mean_sec, count(*) - count(duration_sec) missing from loop_log group by 1")
def _(t):
    return rl.durations(t("loop_log"), ["run_id"])


_TOT = f"with k as (select run_id, {_N} n, sum(context_tokens)::bigint total from loop_log where {_N} is not null group by all)"


def totals(t):
    n = rl.iteration_number(F.col("iter"))
    return t("loop_log").withColumn("n", n).where("n is not null").groupBy("run_id", "n").agg(F.sum("context_tokens").alias("total"))


@add("win_growth_delta", _TOT + " select run_id, n, total, case when total - p >= 0 then total - p end new_unique from (select *, last_value(total ignore nulls) over (partition by run_id order by n rows between unbounded preceding and 1 preceding) p from k)")
def _(t):
    return rl.growth(totals(t), ["run_id"], "n", "total")


@add("win_iteration_delta", _TOT + " select run_id, n, total, total - f delta, total - f > 0 improved, total - f < 0 regressed from (select *, first_value(total) over (partition by run_id order by n) f from k)")
def _(t):
    return rl.against_first(totals(t), ["run_id"], "n", "total")


@add("win_yield_drop", _TOT + " select run_id, n, total, before from (select *, lag(total) over (partition by run_id order by n) before from k) where total < 0.5 * before")
def _(t):
    return rl.yield_drops(totals(t), ["run_id"], "n", "total")


@add("agg_sdg_summary", "with k as (select run_id, count(*) c from curation_rows where artifact_field = 'anomalygen_sdg_csv' group by 1) select sum(c)::bigint total, round(avg(c), 6) mean from k")
def _(t):
    k = t("curation_rows").where("artifact_field = 'anomalygen_sdg_csv'").groupBy("run_id").agg(F.count("*").alias("c"))
    return k.agg(F.sum("c").alias("total"), rounded(F.avg("c")).alias("mean"))


@add("join_state_log", "with s as (select distinct run_id, iter, true a from deft_iterations where run_id is not null and iter is not null), l as (select distinct run_id, iter, true b from loop_log where run_id is not null and iter is not null) select run_id, iter, case when a is null then 'log_only' when b is null then 'state_only' else 'both' end verdict from s full join l using (run_id, iter)")
def _(t):
    known = "run_id is not null and iter is not null"
    return rl.state_against_log(t("deft_iterations").where(known), t("loop_log").where(known), ["run_id", "iter"])


@add("dq_run_audit", """with v as (select distinct run_id from (select run_id, seq, coalesce(lag(seq) over (partition by run_id order by seq nulls first, log_id) + 1, 1) e from loop_log) where seq <> e),
r as (select run_id, count(*) filter (status = 'error') errors from loop_log group by 1), z as (select run_id, stage last_stage, status last_status from (select *, row_number() over (partition by run_id order by seq desc nulls last, log_id desc) n from loop_log) where n = 1)
select run_id, last_stage, errors, case when run_id in (select run_id from v where run_id is not null) then 'INVALID' when last_stage = 'loop_stop' and errors > 0 then 'FAILED' when last_stage = 'loop_stop' and last_status = 'ok' then 'COMPLETE' when last_status = 'error' then 'FAILED' else 'IN_PROGRESS' end run_status from r join z using (run_id)""")
def _(t):
    log = t("loop_log").where("run_id is not null")
    return rl.run_status(log, rl.sequence_gaps(log, ["run_id"]), ["run_id"])


@add("win_sliding", "with r as (select user_id, ts, event_id, row_number() over w - 1 rn, list(value) over (partition by user_id order by ts, event_id rows between current row and 7 following) v from events window w as (partition by user_id order by ts, event_id)) select user_id, (rn // 4)::bigint window_no, event_id start_at, round(list_sum(v), 6) total from r where rn % 4 = 0 and len(v) = 8")
def _(t):
    s = t("events").withColumn("o", F.struct("ts", "event_id"))
    w = rl.sliding_windows(s, ["user_id"], "o", "value", 8, 4)
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    return w.select("user_id", "window_no", F.col("start_at.event_id").alias("start_at"), rounded(total).alias("total"))


@add("stream_stage_counts", "select date_trunc('day', ts) window_start, stage, count(*) events, count(*) filter (status = 'error') errors from (select distinct on (log_id) * from loop_log) group by all")
def _(t):
    """The log read as a stream to its end; the watermark is wider than the log, so that nothing is late."""
    from gaugeworks.sources.sinks import write_parquet
    from gaugeworks.streaming import logstream

    where = t.scratch("log")
    write_parquet(t("loop_log").withColumn("ts", F.col("ts").cast("timestamp")), where)
    counts = logstream.stage_counts(logstream.read_log(t.spark, where), "3650 days")
    name = "stages_" + where.split("/")[-2]
    q = counts.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", t.scratch("stream")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return t.spark.table(name).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


QUERIES, ORACLE = M.queries, M.oracle
