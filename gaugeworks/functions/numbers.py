"""Ratios with a defined value for a zero denominator, score arithmetic, vectors and formats."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")


def ratio(a: Column, b: Column, undefined: float = NAN) -> Column:
    """``a / b``, ``undefined`` for a zero denominator: NaN in threshold tables, 0.0 in text-label ones."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(undefined))


def f1(precision: Column, recall: Column, undefined: float = NAN) -> Column:
    bad = F.isnan(precision) | F.isnan(recall) | (precision + recall == 0)
    return F.when(bad, F.lit(undefined)).otherwise(F.try_divide(2 * precision * recall, precision + recall))


def nan_low(col: Column) -> Column:
    """NaN as minus infinity, so that it loses every comparison for the best."""
    return F.when(F.isnan(col), F.lit(float("-inf"))).otherwise(col)


def just_below(x: float) -> float:
    """The largest double below ``x``."""
    return math.nextafter(x, -math.inf)


def is_finite(col: Column) -> Column:
    return col.isNotNull() & ~F.isnan(col) & (F.abs(col) < F.lit(float("inf")))


def format_float(col: Column) -> Column:
    """Six decimals, ``nan`` for NaN."""
    return F.when(F.isnan(col), "nan").otherwise(F.format_string("%.6f", col))


def format_pct(col: Column) -> Column:
    return F.when(F.isnan(col), "nan").otherwise(F.format_string("%.4f%%", col * 100))


def format_duration(seconds: Column) -> Column:
    """``1h 2m``, ``2m 3s`` or ``3s``: the two leading units; ``not recorded`` for null, zero and less."""
    s = seconds.try_cast("long")
    h, m, r = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))
    shown = F.when(h > 0, F.format_string("%dh %dm", h, m)).when(m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))
    return F.when(s > 0, shown).otherwise("not recorded")


def weakness(score: Column, defect: Column, threshold: Column) -> Column:
    """Signed distance on the wrong side of the threshold: positive is misclassified (a score at it counts as pass)."""
    return F.when(defect, threshold - score).otherwise(score - threshold)


def score_tier(gap: Column) -> Column:
    """Bands of the gap between two group means."""
    return F.when(gap < 0.03, "none").when(gap < 0.10, "weak").when(gap < 0.20, "moderate").otherwise("strong")


def binary_entropy(p: Column) -> Column:
    term = lambda x: F.when(x > 0, -x * F.ln(F.when(x > 0, x))).otherwise(0.0)
    return term(p) + term(1 - p)


def effective_lr(base: Column, batch: Column, gpus: Column, reference_batch: int = 1) -> Column:
    return base * batch * gpus / F.lit(reference_batch)


def fail_weight(n_pass: Column, n_defect: Column) -> Column:
    """The weight that balances the two classes; null without defects."""
    return F.try_divide(n_pass.cast("double"), n_defect.cast("double"))


def corners(bbox: Column) -> Column:
    """``[x, y, w, h]`` as ``[x0, y0, x1, y1]``."""
    return F.array(bbox[0], bbox[1], bbox[0] + bbox[2], bbox[1] + bbox[3])


def vector_ok(v: Column) -> Column:
    """Not empty, and nothing null or infinite in it."""
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: is_finite(x))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: Column, b: Column) -> Column:
    """In [-1, 1]; null for a zero vector or unequal lengths."""
    c = F.try_divide(dot(a, b), norm(a) * norm(b))
    return F.when((F.size(a) == F.size(b)) & c.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c)))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))), F.lit(0.0), lambda s, x: s + x))


def manhattan(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)


def parse_time(col: Column) -> Column:
    """ISO 8601 with ``Z``, an offset, or neither, which means UTC (the session's time zone is UTC); null otherwise."""
    return F.try_to_timestamp(F.trim(col))


def short_hash(col: Column) -> Column:
    """The first 16 hex digits of the text's SHA-256."""
    return F.substring(F.sha2(col, 256), 1, 16)
