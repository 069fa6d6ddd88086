"""Text-label gap analysis: OK/NG and yes/no answers against the truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.labels import okng, yesno
from gaugeworks.functions.numbers import ratio

# fixed values: the keys under which a sample's truth and answer are looked up, in order
TRUTH_KEYS = ("gt", "ground_truth", "answer", "label", "target")
ANSWER_KEYS = ("response", "prediction", "pred", "model_response", "output")
METRICS = ("accuracy", "precision", "recall", "f1", "false_accept_rate", "false_reject_rate")


def first_present(doc: Column, keys: tuple[str, ...]) -> Column:
    """The text under the first key that is there in a variant object, even if it holds null (which gives null)."""
    out = F.lit(None).cast("string")
    for k in reversed(keys):
        out = F.when(F.try_variant_get(doc, f"$.{k}", "variant").isNotNull(), F.try_variant_get(doc, f"$.{k}", "string")).otherwise(out)
    return out


def judged(df: DataFrame, truth: Column, answer: Column) -> DataFrame:
    """``df`` with ``truth``, ``answer`` as OK, NG or UNKNOWN, and ``outcome`` (NG is positive)."""
    t, a = okng(truth), okng(answer)
    unknown = (t == "UNKNOWN") | (a == "UNKNOWN")
    outcome = F.when(unknown, "unknown").when((t == "NG") & (a == "NG"), "tp").when((t == "OK") & (a == "NG"), "fp").when((t == "OK") & (a == "OK"), "tn").otherwise("fn")
    return df.withColumns({"truth": t, "answer": a, "outcome": outcome})


def okng_confusion(rows: DataFrame) -> DataFrame:
    """One row: counts and six metrics over the parseable rows; an undefined ratio is 0."""
    n = {k: F.count_if(F.col("outcome") == k).alias(k) for k in ("tp", "fp", "tn", "fn", "unknown")}
    c = rows.agg(F.count("*").alias("samples"), *n.values())
    tp, fp, tn, fn = (F.col(k) for k in ("tp", "fp", "tn", "fn"))
    with_pr = c.withColumns({"accuracy": ratio(tp + tn, tp + fp + tn + fn, 0.0), "precision": ratio(tp, tp + fp, 0.0), "recall": ratio(tp, tp + fn, 0.0), "false_accept_rate": ratio(fn, tp + fn, 0.0), "false_reject_rate": ratio(fp, fp + tn, 0.0)})
    return with_pr.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"), 0.0))


def kpi_gate(confusion: DataFrame, metric: str, threshold: float, role: str, report_only: bool = False) -> DataFrame:
    """``metric, value, threshold, met``: met only for a benchmark that isn't report-only, and never with unknown answers.

    The comparison is ``>=`` for every metric, the two error rates included."""
    if metric not in METRICS or role not in ("proxy", "benchmark"):
        raise ValueError(f"no such metric or role: {metric}, {role}")
    gates = role == "benchmark" and not report_only
    met = (F.col(metric) >= F.lit(threshold)) & (F.col("unknown") == 0) if gates else F.lit(None).cast("boolean")
    return confusion.select(F.lit(metric).alias("metric"), F.col(metric).alias("value"), F.lit(threshold).alias("threshold"), met.alias("met"))


def yesno_errors(df: DataFrame, truth: Column, answer: Column) -> DataFrame:
    """Rows where both sides say exactly one of yes and no, and differ, as ``false_positive`` or ``false_negative``."""
    t, a = yesno(truth), yesno(answer)
    return df.withColumns({"truth_yn": t, "answer_yn": a}).where(t != a).withColumn("error_type", F.when(F.col("truth_yn") == "no", "false_positive").otherwise("false_negative"))
