"""Model evaluation beyond thresholds: classes, segmentation, detection, and metric contracts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.labels import compare


def accuracy(rows: DataFrame, *by: str) -> DataFrame:
    """``predicted`` against ``truth``, over all rows or by group."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.avg((F.col("predicted") == F.col("truth")).cast("int")).alias("accuracy"))


def confusion_matrix(rows: DataFrame) -> DataFrame:
    return rows.groupBy("truth", "predicted").agg(F.count("*").alias("n"))


def iou(matrix: DataFrame, ignore: int | None = 255) -> DataFrame:
    """``class, n_truth, n_predicted, n_both, iou`` of every class on either side; pixels of the ignored truth don't count."""
    m = matrix if ignore is None else matrix.where(F.col("truth") != ignore)
    rows = m.groupBy(F.col("truth").alias("class")).agg(F.sum("n").alias("n_truth"), F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n"))).alias("n_both"))
    cols = m.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("n_predicted"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    j = rows.join(cols, "class", "full_outer").select("class", z("n_truth").alias("n_truth"), z("n_predicted").alias("n_predicted"), z("n_both").alias("n_both"))
    return j.withColumn("iou", F.col("n_both") / (F.col("n_truth") + F.col("n_predicted") - F.col("n_both")))


def iou_summary(by_class: DataFrame) -> DataFrame:
    """Mean over the classes present in the truth, and pixel accuracy."""
    return by_class.agg(F.avg(F.when(F.col("n_truth") > 0, F.col("iou"))).alias("mean_iou"), (F.sum("n_both") / F.sum("n_truth")).alias("pixel_accuracy"), F.count_if(F.col("n_truth") > 0).alias("classes"))


def box_iou(a: Column, b: Column) -> Column:
    """Of two corner boxes."""
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    return F.coalesce(F.try_divide(w * h, area(a) + area(b) - w * h), F.lit(0.0))


def _greedy(found: list[dict], boxes: list[list[float]], least_iou: float) -> list[tuple[float, bool]]:
    """Detections by falling score, each taking the free box it overlaps most."""
    free, out = list(boxes), []
    for d in sorted(found, key=lambda d: -d["score"]):
        best, at, p = least_iou, None, d["box"]
        for i, b in enumerate(free):
            w = max(0.0, min(p[2], b[2]) - max(p[0], b[0]))
            h = max(0.0, min(p[3], b[3]) - max(p[1], b[1]))
            whole = (p[2] - p[0]) * (p[3] - p[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
            if whole > 0 and w * h / whole >= best:
                best, at = w * h / whole, i
        if at is not None:
            free.pop(at)
        out.append((d["score"], at is not None))
    return out


def matched_detections(predicted: DataFrame, truth: DataFrame, least_iou: float = 0.5) -> DataFrame:
    """Greedy matching by score within each image and class: ``image, class, score, hit``.

    ``predicted``: image, class, score, box; ``truth``: image, class, box. What is gathered is one image's boxes of a class."""
    p = predicted.groupBy("image", "class").agg(F.collect_list(F.struct(F.col("score").cast("double").alias("score"), "box")).alias("found"))
    t = truth.groupBy("image", "class").agg(F.collect_list("box").alias("boxes"))
    both = p.join(t, ["image", "class"], "left").select("image", "class", "found", "boxes")
    hits = "array<struct<score:double,hit:boolean>>"

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("score", pa.float64()), ("hit", pa.bool_())]))
        for b in batches:
            rows = [[{"score": s, "hit": h} for s, h in _greedy(f, x or [], least_iou)] for f, x in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, kind)], names=["image", "class", "hits"])

    kinds = [predicted.schema[c].dataType.simpleString() for c in ("image", "class")]
    return both.mapInArrow(match, f"image {kinds[0]}, class {kinds[1]}, hits {hits}").select("image", "class", F.inline("hits"))


def average_precision(matched: DataFrame, truth: DataFrame) -> DataFrame:
    """Average precision of each class: the mean over its boxes of the precision envelope at their recall."""
    n = truth.groupBy("class").agg(F.count("*").alias("boxes"))
    down = Window.partitionBy("class").orderBy(F.col("score").desc(), "image")
    run = down.rowsBetween(Window.unboundedPreceding, 0)
    p = matched.withColumn("precision", F.sum(F.col("hit").cast("int")).over(run) / F.row_number().over(down))
    up = Window.partitionBy("class").orderBy("score", F.col("image").desc())  # the same order from its end, so that the maximum runs along
    env = p.withColumn("envelope", F.max("precision").over(up.rowsBetween(Window.unboundedPreceding, 0)))
    ap = env.where("hit").groupBy("class").agg(F.sum("envelope").alias("s"))
    return n.join(ap, "class", "left").select("class", "boxes", F.coalesce(F.col("s") / F.col("boxes"), F.lit(0.0)).alias("ap"))


def evaluate_contract(results: DataFrame, targets: DataFrame, constraints: DataFrame) -> DataFrame:
    """``candidate, value, met, feasible, passed``: each candidate's metric against its target and every constraint.

    ``results``: candidate, metric, value; ``targets``: metric, operator, target (one row); ``constraints``: metric, operator, target. A constraint whose metric is missing or not finite fails."""
    holds = F.coalesce(compare(F.col("value"), F.col("operator"), F.col("target")) & ~F.isnan("value"), F.lit(False))
    primary = results.join(F.broadcast(targets), "metric").select("candidate", "value", "operator", holds.alias("met"))
    names = results.select("candidate").distinct().crossJoin(F.broadcast(constraints))
    checked = names.join(results, ["candidate", "metric"], "left").groupBy("candidate").agg(F.bool_and(holds).alias("feasible"))
    return primary.join(checked, "candidate", "left").withColumn("feasible", F.coalesce("feasible", F.lit(True))).withColumn("passed", F.col("met") & F.col("feasible"))


def pick_best(evaluated: DataFrame, order: str = "candidate") -> DataFrame:
    """The best candidate among the feasible ones, or among all if none is; less is better for ``<`` and ``<=``; the first on ties."""
    signed = F.when(F.col("operator").isin("<", "<="), -F.col("value")).otherwise(F.col("value"))
    return evaluated.orderBy(F.col("feasible").desc(), signed.desc_nulls_last(), order).limit(1)


def set_hash(df: DataFrame, key: str) -> DataFrame:
    """A hash of the set of keys that doesn't depend on their order, and their number."""
    h = df.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("k")).distinct().select(F.sha2("k", 256).alias("h"))
    parts = [F.expr(f"sum(cast(conv(substring(h, {i * 8 + 1}, 8), 16, 10) as decimal(20, 0)))") for i in range(8)]
    return h.agg(F.count("*").alias("n"), F.sha2(F.concat_ws("-", *(p.cast("string") for p in parts)), 256).alias("set_hash"))


def chunked(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Batches cut to at most ``size`` rows, for evaluators with bounded memory."""
    for b in batches:
        for at in range(0, len(b), size):
            yield b.iloc[at : at + size]
