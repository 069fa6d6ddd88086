"""Threshold and gap analysis over ``events`` (label ``view`` is the pass label, ``value`` the score) and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.operators import gaps
from gaugeworks.operators import thresholds as th
from gaugeworks.plans.base import Module, rounded, with_rounded
from gaugeworks.session import materialize

M = Module()
add = M.add

S = "with s as (select event_id row_id, user_id, case when event_type = 'view' then ' Pass ' else event_type end label, value score, event_type <> 'view' defect from events)"
SWEEP = (
    S
    + """, c as (select score threshold from s union select nextafter(min(score), -1e308) from s),
b as (select score, count(*) filter (defect) ng, count(*) filter (not defect) ok from s group by 1),
k as (select threshold, coalesce(sum(ng) filter (score > threshold), 0)::bigint tp, coalesce(sum(ok) filter (score > threshold), 0)::bigint fp, coalesce(sum(ok) filter (score <= threshold), 0)::bigint tn, coalesce(sum(ng) filter (score <= threshold), 0)::bigint fn from c cross join b group by 1),
w as (select *, tp / nullif(tp + fp, 0) precision_, tp / nullif(tp + fn, 0) recall, (tp + tn) / nullif(tp + fp + tn + fn, 0) accuracy, fp / nullif(fp + tn, 0) far from k),
sweep as (select *, 2 * precision_ * recall / nullif(precision_ + recall, 0) f1 from w)"""
)
SWEEP_OUT = " select threshold, tp, fp, tn, fn, round(precision_, 6) \"precision\", round(recall, 6) recall, round(accuracy, 6) accuracy, round(far, 6) far, tp + fn actual_no_pass, fp + tn actual_pass, tp + fp predicted_no_pass, round(f1, 6) f1 from sweep"
RATIOS = ("precision", "recall", "accuracy", "far", "f1")


def scored(t):
    e = t("events").withColumn("label", F.when(F.col("event_type") == "view", " Pass ").otherwise(F.col("event_type")))
    return th.scored(e, "event_id", "label", "value", "PASS", ["user_id"])


def swept(t):
    return materialize(th.threshold_sweep(scored(t)))


@add("agg_threshold_sweep", SWEEP + SWEEP_OUT)
def _(t):
    return with_rounded(th.threshold_sweep(scored(t)), *RATIOS)


@add("agg_confusion_at_t", SWEEP + SWEEP_OUT.replace("from sweep", "from (select 100.0::double threshold, tp, fp, tn, fn, precision_, recall, accuracy, far, f1 from sweep where threshold <= 100 order by sweep.threshold desc limit 1)"))
def _(t):
    return with_rounded(th.confusion_at(scored(t), 100.0), *RATIOS)


@add("sel_best_f1", SWEEP + SWEEP_OUT + " order by sweep.f1 desc nulls last, sweep.recall desc nulls last, sweep.precision_ desc nulls last, sweep.threshold desc limit 1")
def _(t):
    return with_rounded(th.best_f1(swept(t)), *RATIOS)


@add("sel_recall_100", SWEEP + SWEEP_OUT + " where tp + fn > 0 and sweep.recall >= 1 - 1e-12 order by sweep.f1 desc nulls last, sweep.precision_ desc nulls last, sweep.threshold desc limit 1")
def _(t):
    return with_rounded(th.recall_100(swept(t)), *RATIOS)


@add("sel_min_recall", SWEEP + SWEEP_OUT + " where tp + fn > 0 and sweep.recall >= 0.9 - 1e-12 order by sweep.f1 desc nulls last, sweep.precision_ desc nulls last, sweep.threshold desc limit 1")
def _(t):
    return with_rounded(th.min_recall(swept(t), 0.9), *RATIOS)


WEAK = S + ", w as (select *, upper(trim(label)) clean, case when defect then 20.0 - score else score - 20.0 end weakness from s)"


def weak(t):
    return th.with_weakness(scored(t), t.spark.range(1).select(F.lit(20.0).alias("threshold")))


@add("filter_missed", S + " select row_id, label, printf('%.6f', score) analysis_score, printf('%.6f', 20.0::double) analysis_threshold, 'NO_PASS' analysis_actual_label_group, 'PASS' analysis_predicted_label_group, 'MISSED_NO_PASS' analysis_outcome from s where defect and score <= 20")
def _(t):
    return th.missed(scored(t), t.spark.range(1).select(F.lit(20.0).alias("threshold")))


@add("sort_missed", S + " select row_id, row_number() over (order by round(score, 6), row_id) place from s where defect and score <= 5")
def _(t):
    from gaugeworks.operators.prefix import prefix_sums

    m = scored(t).where("defect and score <= 5")
    return prefix_sums(m, [F.round("score", 6), "row_id"], {"place": F.lit(1).cast("long")}).select("row_id", (F.col("place") + 1).alias("place"))


@add("fn_weakness", WEAK + " select row_id, round(weakness, 6) weakness from w")
def _(t):
    return weak(t).select("row_id", rounded("weakness").alias("weakness"))


@add("sel_topk_per_label", WEAK + " select row_id, clean, place from (select *, row_number() over (partition by clean order by weakness desc, row_id) place from w) where place <= 50")
def _(t):
    return th.weakest_per_label(weak(t)).select("row_id", "clean", "place")


@add("sel_spot_check", WEAK + " select row_id, defect, place from (select *, row_number() over (partition by defect order by weakness desc, row_id) place from w) where place <= 5")
def _(t):
    return th.spot_check(weak(t)).select("row_id", "defect", "place")


@add("agg_per_label_weakness", WEAK + " select clean, count(*) total, round(avg(weakness), 6) mean_weakness, round(median(weakness), 6) median_weakness, round(max(weakness), 6) max_weakness, count(*) filter (weakness > 0) misclassified from w group by 1")
def _(t):
    return with_rounded(th.weakness_per_label(weak(t)), "mean_weakness", "median_weakness", "max_weakness")


@add("agg_breakdown_pct", WEAK + ", k as (select clean, count(*) kept, count(*) filter (weakness > 0) misclassified, count(*) filter (weakness <= 0) marginal from w where weakness > -5 group by 1) select *, round(kept * 100.0 / sum(kept) over (), 6) kept_pct from k")
def _(t):
    return with_rounded(th.kept_breakdown(weak(t), 5.0), "kept_pct")


@add("win_drop_n", S + ", d as (select score, row_number() over (order by score) rn from s where defect) select (rn - 1)::int dropped, d.score cut, round((select count(*) from s where not defect and s.score >= d.score) / (select count(*) from s where not defect), 6) far from d where rn - 1 in (1, 2, 3, 5)")
def _(t):
    return with_rounded(th.drop_worst(scored(t)), "far")


STAT = "count(*) n, min(score) low, max(score) high, round(avg(score), 6) mean, round(median(score), 6) median, round(stddev_samp(score), 6) deviation"


@add("agg_score_stats", S + f" select defect, {STAT} from s group by 1")
def _(t):
    return with_rounded(th.score_stats(scored(t), "defect"), "mean", "median", "deviation")


@add("agg_per_component", S + f" select user_id, {STAT} from s group by 1")
def _(t):
    return with_rounded(th.score_stats(scored(t), "user_id"), "mean", "median", "deviation")


@add("agg_per_defect", S + ", g as (select label, count(*) n, (count(*) filter (not defect and score > 50)) / nullif(count(*) filter (not defect), 0) fp_rate, (count(*) filter (defect and score <= 50)) / nullif(count(*) filter (defect), 0) fn_rate, avg(score) filter (defect) - avg(score) filter (not defect) mean_gap from s group by 1) select label, n, round(fp_rate, 6) fp_rate, round(fn_rate, 6) fn_rate, round(mean_gap, 6) mean_gap from g")
def _(t):
    return with_rounded(th.group_errors(scored(t), 50.0, "label"), "fp_rate", "fn_rate", "mean_gap")


@add("agg_per_board", S + ", g as (select user_id, count(*) n, (count(*) filter (not defect and score > 50)) / nullif(count(*) filter (not defect), 0) fp_rate, (count(*) filter (defect and score <= 50)) / nullif(count(*) filter (defect), 0) fn_rate, avg(score) filter (defect) - avg(score) filter (not defect) mean_gap from s group by 1) select user_id, n, round(fp_rate, 6) fp_rate, round(fn_rate, 6) fn_rate, round(mean_gap, 6) mean_gap from g")
def _(t):
    return with_rounded(th.group_errors(scored(t), 50.0, "user_id"), "fp_rate", "fn_rate", "mean_gap")


@add("agg_crosstab", "select l_returnflag, count(*) filter (l_linestatus = 'F') \"F\", count(*) filter (l_linestatus = 'O') \"O\" from lineitem group by 1")
def _(t):
    return t("lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.count(F.lit(1))).na.fill(0, ["F", "O"])


@add("agg_calibration", S + " select least(10, 1 + floor((score - 0) / 50))::int bucket, count(*) n, round(avg(defect::int), 6) defect_rate, round(avg(score), 6) mean_score from s where score between 0 and 500 group by 1")
def _(t):
    return with_rounded(th.calibration(scored(t), 0.0, 500.0), "defect_rate", "mean_score")


@add("agg_histogram", S + ", e as (select min(score) lo, max(score) hi from s) select least(19, floor((score - lo) / ((hi - lo) / 20)))::int bin, count(*) filter (not defect) n_pass, count(*) filter (defect) n_defect, round(any_value(lo) + least(19, floor((score - lo) / ((hi - lo) / 20)))::int * ((any_value(hi) - any_value(lo)) / 20), 6) edge from s, e group by 1, least(19, floor((score - lo) / ((hi - lo) / 20)))::int")
def _(t):
    return with_rounded(th.histogram(scored(t)), "edge")


@add("agg_histogram_one_value", "select 0 bin, count(*) filter (o_orderstatus = 'O') n_pass, count(*) filter (o_orderstatus <> 'O') n_defect, 6.65::double edge from orders")
def _(t):
    """Scores that differ by less than a billionth share one bin."""
    score = 7 + F.col("o_orderkey") % 2 * 1e-10
    return with_rounded(th.histogram(t("orders").select(score.alias("score"), (F.col("o_orderstatus") != "O").alias("defect"))), "edge")


@add("agg_percentile_flag", S + " select user_id, round(avg(score), 6) mean, round((select quantile_cont(score, 0.55) from s), 6) cut from s group by 1 having avg(score) > (select quantile_cont(score, 0.55) from s)")
def _(t):
    return with_rounded(th.high_mean_groups(scored(t), "user_id", 0.55), "mean", "cut")


@add("agg_class_ratio", S + ", g as (select user_id, count(*) filter (not defect) n_pass, count(*) filter (defect) n_defect from s group by 1) select *, round(n_pass / nullif(n_defect, 0), 6) pass_per_defect, n_pass = 0 or n_defect = 0 single_class from g")
def _(t):
    return with_rounded(th.class_ratio(scored(t), "user_id"), "pass_per_defect")


# text answers: the truth from the line status, the answer from a sentence written out of the return flag
G = """with g as (select l_orderkey, l_linenumber, case l_linestatus when 'O' then ' ok' else 'NG' end truth_text,
  case l_returnflag when 'A' then 'First OK, then NG' when 'N' then 'it is OK.' when 'R' then case when l_linenumber = 1 then 'token' else 'ng' end end answer_text from lineitem),
j as (select *, upper(trim(truth_text)) truth, coalesce(regexp_extract_all(upper(answer_text), '\\b(OK|NG)\\b')[-1], 'UNKNOWN') answer from g),
o as (select *, case when answer = 'UNKNOWN' then 'unknown' when truth = 'NG' and answer = 'NG' then 'tp' when truth = 'OK' and answer = 'NG' then 'fp' when truth = 'OK' then 'tn' else 'fn' end outcome from j),
c as (select count(*) samples, count(*) filter (outcome = 'tp') tp, count(*) filter (outcome = 'fp') fp, count(*) filter (outcome = 'tn') tn, count(*) filter (outcome = 'fn') fn, count(*) filter (outcome = 'unknown') unknown from o),
m as (select *, coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0), 0) accuracy, coalesce(tp / nullif(tp + fp, 0), 0) precision_, coalesce(tp / nullif(tp + fn, 0), 0) recall, coalesce(fn / nullif(tp + fn, 0), 0) false_accept_rate, coalesce(fp / nullif(fp + tn, 0), 0) false_reject_rate from c)"""


def answers(t):
    e = t("lineitem")
    truth = F.when(F.col("l_linestatus") == "O", " ok").otherwise("NG")
    said = F.when(F.col("l_returnflag") == "A", "First OK, then NG").when(F.col("l_returnflag") == "N", "it is OK.").when(F.col("l_returnflag") == "R", F.when(F.col("l_linenumber") == 1, "token").otherwise("ng"))
    return gaps.judged(e, truth, said)


@add("agg_confusion_okng", G + " select samples, tp, fp, tn, fn, unknown, round(accuracy, 6) accuracy, round(precision_, 6) \"precision\", round(recall, 6) recall, round(false_accept_rate, 6) false_accept_rate, round(false_reject_rate, 6) false_reject_rate, round(coalesce(2 * precision_ * recall / nullif(precision_ + recall, 0), 0), 6) f1 from m")
def _(t):
    return with_rounded(gaps.okng_confusion(answers(t)), *gaps.METRICS)


@add("agg_kpi_gate", G + " select 'accuracy' metric, round(accuracy, 6) \"value\", 0.4::double threshold, accuracy >= 0.4 and unknown = 0 met from m")
def _(t):
    return with_rounded(gaps.kpi_gate(gaps.okng_confusion(answers(t)), "accuracy", 0.4, "benchmark"), "value")


@add("fn_okng_last", G + " select truth, answer, count(*) n from o group by all")
def _(t):
    return answers(t).groupBy("truth", "answer").agg(F.count("*").alias("n"))


Y = """with g as (select l_orderkey, l_linenumber, case l_linestatus when 'O' then 'Yes, there is a fault.' else 'B. No' end a, case l_returnflag when 'A' then 'no' when 'N' then 'yes and no' else 'Answer: YES' end b from lineitem),
y as (select *, case when regexp_matches(lower(a), '\\byes\\b') and not regexp_matches(lower(a), '\\bno\\b') then 'yes' when regexp_matches(lower(a), '\\bno\\b') and not regexp_matches(lower(a), '\\byes\\b') then 'no' end truth_yn,
  case when regexp_matches(lower(b), '\\byes\\b') and not regexp_matches(lower(b), '\\bno\\b') then 'yes' when regexp_matches(lower(b), '\\bno\\b') and not regexp_matches(lower(b), '\\byes\\b') then 'no' end answer_yn from g)"""


def yesno(t):
    a = F.when(F.col("l_linestatus") == "O", "Yes, there is a fault.").otherwise("B. No")
    b = F.when(F.col("l_returnflag") == "A", "no").when(F.col("l_returnflag") == "N", "yes and no").otherwise("Answer: YES")
    return gaps.yesno_errors(t("lineitem"), a, b)


@add("agg_yesno_fp_fn", Y + " select case truth_yn when 'no' then 'false_positive' else 'false_negative' end error_type, count(*) n from y where truth_yn <> answer_yn group by 1")
def _(t):
    return yesno(t).groupBy("error_type").agg(F.count("*").alias("n"))


@add("fn_yesno_exclusive", Y + " select l_orderkey, l_linenumber, truth_yn, answer_yn from y where truth_yn <> answer_yn")
def _(t):
    return yesno(t).select("l_orderkey", "l_linenumber", "truth_yn", "answer_yn")


QUERIES, ORACLE = M.queries, M.oracle
