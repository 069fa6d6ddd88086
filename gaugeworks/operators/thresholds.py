"""Classifier scores against thresholds: sweep, operating points, and what lies on the wrong side."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.labels import clean_label, is_defect
from gaugeworks.functions.numbers import NAN, f1, format_float, just_below, nan_low, ratio, weakness
from gaugeworks.operators.prefix import prefix_sums

TOLERANCE = 1e-12


def scored(df: DataFrame, row_id: str, label: str, score: str, pass_label: str = "PASS", keep: list[str] | None = None) -> DataFrame:
    """``row_id, label, score, defect``, and ``keep``."""
    return df.select(F.col(row_id).alias("row_id"), F.col(label).alias("label"), F.col(score).cast("double").alias("score"), is_defect(F.col(label), pass_label).alias("defect"), *(keep or []))


def metrics(counts: DataFrame, undefined: float = NAN) -> DataFrame:
    """``threshold`` and the four counts with every ratio of them; undefined ratios are NaN."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    with_ratios = counts.select(
        "threshold", "tp", "fp", "tn", "fn",
        ratio(tp, tp + fp, undefined).alias("precision"), ratio(tp, tp + fn, undefined).alias("recall"),
        ratio(tp + tn, tp + fp + tn + fn, undefined).alias("accuracy"), ratio(fp, fp + tn, undefined).alias("far"),
        (tp + fn).alias("actual_no_pass"), (fp + tn).alias("actual_pass"), (tp + fp).alias("predicted_no_pass"),
    )
    return with_ratios.withColumn("f1", f1(F.col("precision"), F.col("recall"), undefined))


def confusion_at(rows: DataFrame, threshold: float) -> DataFrame:
    """One row of metrics: above the threshold is predicted NO_PASS."""
    above = F.col("score") > F.lit(threshold)
    n = lambda c, name: F.count_if(c).alias(name)
    d = F.col("defect")
    return metrics(rows.agg(F.lit(threshold).alias("threshold"), n(d & above, "tp"), n(~d & above, "fp"), n(~d & ~above, "tn"), n(d & ~above, "fn")))


def threshold_sweep(rows: DataFrame) -> DataFrame:
    """Metrics at every distinct score and just below the lowest, in one pass over sorted scores.

    Counts per score are summed first; their prefix sums give all four counts, so the cost is that of one sort."""
    by_score = rows.where(F.col("score").isNotNull()).groupBy("score").agg(F.count_if("defect").alias("ng"), F.count_if(~F.col("defect")).alias("ok"))
    low = rows.agg(F.min("score").alias("low"), F.count_if(F.col("defect") & F.col("score").isNotNull()).alias("n"), F.count_if(~F.col("defect") & F.col("score").isNotNull()).alias("p")).first()
    if low["low"] is None:
        return metrics(rows.sparkSession.createDataFrame([], "threshold double, tp long, fp long, tn long, fn long"))
    n, p = F.lit(low["n"]), F.lit(low["p"])
    sums = prefix_sums(by_score, ["score"], {"fn_before": F.col("ng"), "tn_before": F.col("ok")})
    fn, tn = F.col("fn_before") + F.col("ng"), F.col("tn_before") + F.col("ok")
    counts = sums.select(F.col("score").alias("threshold"), (n - fn).alias("tp"), (p - tn).alias("fp"), tn.alias("tn"), fn.alias("fn"))
    first = rows.sparkSession.range(1).select(F.lit(just_below(low["low"])).alias("threshold"), n.alias("tp"), p.alias("fp"), F.lit(0).cast("long").alias("tn"), F.lit(0).cast("long").alias("fn"))
    return metrics(first.union(counts))


def _best(sweep: DataFrame, *order: str) -> DataFrame:
    return sweep.orderBy(*(nan_low(F.col(c)).desc() for c in order)).limit(1)


def best_f1(sweep: DataFrame) -> DataFrame:
    """The threshold of greatest F1; ties by recall, precision, threshold."""
    return _best(sweep, "f1", "recall", "precision", "threshold")


def recall_100(sweep: DataFrame) -> DataFrame:
    """The best threshold that misses no defect; no row if there is no defect."""
    return min_recall(sweep, 1.0)


def min_recall(sweep: DataFrame, least: float) -> DataFrame:
    """The best threshold of at least this recall; no row if none reaches it."""
    reached = sweep.where((F.col("actual_no_pass") > 0) & (F.col("recall") >= F.lit(least - TOLERANCE)))
    return _best(reached, "f1", "precision", "threshold")


def with_threshold(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """``rows`` with the one threshold of ``chosen`` (at most one row) as a column."""
    return rows.crossJoin(F.broadcast(chosen.select("threshold").limit(1)))


def missed(rows: DataFrame, chosen: DataFrame, pass_label: str = "PASS") -> DataFrame:
    """Defects predicted as pass, lowest formatted score first, with the analysis columns."""
    out = with_threshold(rows, chosen).where(F.col("defect") & (F.col("score") <= F.col("threshold")))
    text = format_float(F.col("score"))
    return out.select(
        "row_id", "label", text.alias("analysis_score"), format_float(F.col("threshold")).alias("analysis_threshold"),
        F.lit("NO_PASS").alias("analysis_actual_label_group"), F.lit(pass_label).alias("analysis_predicted_label_group"), F.lit("MISSED_NO_PASS").alias("analysis_outcome"),
    ).orderBy(F.col("analysis_score").cast("double"), "row_id")


def with_weakness(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    return with_threshold(rows, chosen).withColumn("weakness", weakness(F.col("score"), F.col("defect"), F.col("threshold")))


def weakest_per_label(weak: DataFrame, k: int = 50) -> DataFrame:
    """The k weakest rows of each cleaned label, ties by row id."""
    w = Window.partitionBy("clean").orderBy(F.col("weakness").desc(), "row_id")
    return weak.withColumn("clean", clean_label(F.col("label"))).withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def spot_check(weak: DataFrame, k: int = 5) -> DataFrame:
    """The k weakest passes and the k weakest defects, one row a sample."""
    once = Window.partitionBy("row_id").orderBy(F.col("weakness").desc())
    single = weak.withColumn("n", F.row_number().over(once)).where("n = 1")
    w = Window.partitionBy("defect").orderBy(F.col("weakness").desc(), "row_id")
    return single.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).drop("n")


def weakness_per_label(weak: DataFrame) -> DataFrame:
    return weak.groupBy(clean_label(F.col("label")).alias("clean")).agg(
        F.count("*").alias("total"), F.avg("weakness").alias("mean_weakness"), F.median("weakness").alias("median_weakness"), F.max("weakness").alias("max_weakness"), F.count_if(F.col("weakness") > 0).alias("misclassified")
    )


def kept_breakdown(weak: DataFrame, margin: float) -> DataFrame:
    """Per label: rows kept (weaker than minus the margin), their share of all kept, misclassified, and marginal ones."""
    kept = weak.where(F.col("weakness") > -F.lit(margin)).groupBy(clean_label(F.col("label")).alias("clean"))
    counts = kept.agg(F.count("*").alias("kept"), F.count_if(F.col("weakness") > 0).alias("misclassified"), F.count_if(F.col("weakness") <= 0).alias("marginal"))
    total = counts.agg(F.sum("kept").alias("all_kept"))
    return counts.crossJoin(F.broadcast(total)).withColumn("kept_pct", F.col("kept") * 100.0 / F.col("all_kept")).drop("all_kept")


def drop_worst(rows: DataFrame, drops: tuple[int, ...] = (1, 2, 3, 5)) -> DataFrame:
    """False-accept rate at full recall after leaving out the n lowest-scored defects.

    With s the (n+1)-th lowest defect score, it's the share of passes scored s or more."""
    lowest = [r[0] for r in rows.where("defect").select("score").orderBy("score").limit(max(drops) + 1).collect()]
    ok = ~F.col("defect")
    cuts = [(n, lowest[n]) for n in drops if n < len(lowest)]
    if not cuts:
        return rows.sparkSession.createDataFrame([], "dropped int, cut double, far double")
    one = rows.agg(F.count_if(ok).alias("ok"), *(F.count_if(ok & (F.col("score") >= F.lit(s))).alias(f"n{n}") for n, s in cuts))
    each = F.array(*(F.struct(F.lit(n).alias("dropped"), F.lit(s).alias("cut"), ratio(F.col(f"n{n}"), F.col("ok")).alias("far")) for n, s in cuts))
    return one.select(F.inline(each))


def score_stats(rows: DataFrame, *by: str | Column, exact: bool = True) -> DataFrame:
    """Extremes, mean, median and sample deviation of the scores of each group.

    The exact median keeps a group's distinct scores in memory; without ``exact`` it's a sketch of bounded size."""
    s = F.col("score")
    median = F.median(s) if exact else F.percentile_approx(s, 0.5, 10_000)
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.min(s).alias("low"), F.max(s).alias("high"), F.avg(s).alias("mean"), median.alias("median"), F.stddev_samp(s).alias("deviation"))


def group_errors(rows: DataFrame, threshold: float, *by: str) -> DataFrame:
    """False-positive and false-negative rates and the gap of the class means, by group; undefined is null."""
    above, d = F.col("score") > F.lit(threshold), F.col("defect")
    rate = lambda c, of: F.try_divide(F.count_if(c).cast("double"), F.count_if(of).cast("double"))
    mean = lambda c: F.avg(F.when(c, F.col("score")))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), rate(~d & above, ~d).alias("fp_rate"), rate(d & ~above, d).alias("fn_rate"), (mean(d) - mean(~d)).alias("mean_gap"))


def calibration(rows: DataFrame, low: float, high: float, buckets: int = 10) -> DataFrame:
    """Actual defect rate in equal-width score buckets; the upper edge belongs to the last."""
    b = F.least(F.width_bucket("score", F.lit(low), F.lit(high), F.lit(buckets)), F.lit(buckets))
    return rows.where(F.col("score").between(low, high)).groupBy(b.cast("int").alias("bucket")).agg(F.count("*").alias("n"), F.avg(F.col("defect").cast("int")).alias("defect_rate"), F.avg("score").alias("mean_score"))


def histogram(rows: DataFrame, bins: int = 20) -> DataFrame:
    """Counts by class over shared equal-width edges between the extremes. Scores that are all (nearly) equal
    share one bin, 5 % of the score wide either side, a millionth at least."""
    low, high = rows.agg(F.min("score"), F.max("score")).first()
    if low is None:
        return rows.sparkSession.createDataFrame([], "bin int, edge double, n_pass long, n_defect long")
    if math.isclose(low, high):
        room = max(abs(low) * 0.05, 1e-6)
        low, high, bins = low - room, low + room, 1
    width = (high - low) / bins
    b = F.least(F.floor((F.col("score") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return rows.where("score is not null").groupBy(b.alias("bin")).agg(F.count_if(~F.col("defect")).alias("n_pass"), F.count_if("defect").alias("n_defect")).withColumn("edge", F.lit(low) + F.col("bin") * F.lit(width))


def high_mean_groups(rows: DataFrame, by: str, q: float = 0.75, exact: bool = True) -> DataFrame:
    """Groups whose mean score lies above the overall q-quantile (see :func:`score_stats` for ``exact``)."""
    overall = rows.agg((F.percentile("score", F.lit(q)) if exact else F.percentile_approx("score", q, 10_000)).alias("cut"))
    return rows.groupBy(by).agg(F.avg("score").alias("mean")).crossJoin(F.broadcast(overall)).where(F.col("mean") > F.col("cut"))


def class_ratio(rows: DataFrame, *by: str) -> DataFrame:
    """Passes per defect with a flag for one-sided groups."""
    n_ok, n_ng = F.count_if(~F.col("defect")), F.count_if("defect")
    return rows.groupBy(*by).agg(n_ok.alias("n_pass"), n_ng.alias("n_defect")).withColumn("pass_per_defect", F.try_divide(F.col("n_pass").cast("double"), F.col("n_defect").cast("double"))).withColumn("single_class", (F.col("n_pass") == 0) | (F.col("n_defect") == 0))
