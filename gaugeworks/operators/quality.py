"""Constraints as queries: each returns its violations as ``rule, key, detail``; nothing is raised until asked for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions import chat
from gaugeworks.functions.labels import safe_id, training_label
from gaugeworks.functions.paths import strip_blank


class Violations(ValueError):
    """Rows break a constraint."""


def violation(df: DataFrame, rule: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def all_of(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def raise_if_any(violations: DataFrame, show: int = 5) -> None:
    """Raise with the count and the first few."""
    first = violations.orderBy("rule", "key").limit(show).collect()
    if first:
        raise Violations(f"{violations.count()} violations, such as " + "; ".join(f"{r['rule']} {r['key']}: {r['detail']}" for r in first))


def first_offenders(violations: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` of each rule by key, with how many there are in all."""
    w = Window.partitionBy("rule").orderBy("key", "detail")
    first = violations.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
    return first.join(F.broadcast(violations.groupBy("rule").agg(F.count("*").alias("total"))), "rule")  # one row a rule


def required_fields(df: DataFrame, key: str, fields: list[str], order: list[str], n: int) -> DataFrame:
    """Null required fields among the first ``n`` records."""
    first = df.orderBy(*order).limit(n)
    return all_of(*(violation(first.where(F.col(f).isNull()), "null_field", F.col(key), F.lit(f)) for f in fields))


def label_spelling(df: DataFrame, key: str, label: str) -> DataFrame:
    """Labels that aren't in their canonical spelling, and blank ones."""
    blank = F.coalesce(strip_blank(F.col(label)), F.lit("")) == ""
    spelled = df.where(~blank & (F.col(label) != training_label(F.col(label))))
    return all_of(violation(df.where(blank), "blank_label", F.col(key), F.coalesce(F.col(label), F.lit(""))), violation(spelled, "label_spelling", F.col(key), F.col(label)))


def path_form(df: DataFrame, key: str, column: str) -> DataFrame:
    """Paths that are absolute, or name an image file where a directory is wanted."""
    p = F.translate(strip_blank(F.col(column)), "\\", "/")
    absolute = p.rlike(r"^(?:/|[A-Za-z]:/|file:)")
    image = F.lower(p).rlike(r"\.(?:jpe?g|png|bmp|tiff?)$")
    return all_of(violation(df.where(absolute), "absolute_path", F.col(key), F.col(column)), violation(df.where(image), "image_path", F.col(key), F.col(column)))


def paths_exist(df: DataFrame, key: str, path_key_: Column, listing: DataFrame) -> DataFrame:
    """Rows whose path key isn't among the listing's ``key``."""
    p = df.select(F.col(key).alias("_key"), path_key_.alias("_p")).where("_p is not null")
    return violation(p.join(listing.select(F.col("key").alias("_p")).distinct(), "_p", "left_anti"), "missing_file", F.col("_key"), F.col("_p"))


def class_balance(df: DataFrame, label: str, pass_label: str = "PASS") -> DataFrame:
    """A set of one class only."""
    n = df.agg(F.count_if(F.col(label) == pass_label).alias("ok"), F.count_if(F.col(label) != pass_label).alias("ng"))
    return violation(n.where("ok = 0 or ng = 0"), "single_class", F.lit("*"), F.concat_ws("/", "ok", "ng"))


def batch_size(df: DataFrame, batch: int, gpus: int) -> DataFrame:
    """Fewer rows per GPU than the batch."""
    n = df.agg(F.count("*").alias("n"))
    return violation(n.where(F.floor(F.col("n") / gpus) < batch), "batch_size", F.lit("*"), F.col("n"))


def conversations(df: DataFrame) -> DataFrame:
    """Records (``id, images, conversations``): two images, a prompt, an OK or NG answer, a safe and unique id, a target used once."""
    target = F.try_element_at("images", F.lit(1))
    rules = {"two_images": F.coalesce(F.size("images"), F.lit(0)) != 2, "no_prompt": F.coalesce(chat.prompt(F.col("conversations")), F.lit("")) == "", "no_answer": chat.answer(F.col("conversations")).isNull(), "unsafe_id": F.col("id").isNull() | (F.col("id") != safe_id(F.col("id")))}
    parts = [violation(df.where(c), rule, F.col("id"), F.to_json("images")) for rule, c in rules.items()]
    for rule, c in (("repeated_id", F.col("id")), ("repeated_target", target)):
        again = df.select(c.alias("c")).where("c is not null").groupBy("c").agg(F.count("*").alias("n")).where("n > 1")
        parts.append(violation(again, rule, F.col("c"), F.col("n")))
    return all_of(*parts)


def single_prompt(df: DataFrame, prompt: str) -> DataFrame:
    """More or fewer than one distinct prompt to inherit."""
    n = df.agg(F.count_distinct(prompt).alias("n"))
    return violation(n.where("n <> 1"), "single_prompt", F.lit("*"), F.col("n"))


def mining_counts(summaries: DataFrame, key: str) -> DataFrame:
    bad = summaries.where("candidate_count <> kept_count + rejected_count or kept_count < 0 or rejected_count < 0")
    return violation(bad, "mining_counts", F.col(key), F.concat_ws("/", "candidate_count", "kept_count", "rejected_count"))


def allocation(df: DataFrame, key: str, counts: str, recorded: str) -> DataFrame:
    """Allocation maps with a negative count, an empty sum, or a sum other than the recorded one."""
    values = F.map_values(counts)
    total = F.aggregate(values, F.lit(0).cast("long"), lambda s, x: s + x)
    bad = df.where(F.exists(values, lambda x: x < 0) | (total <= 0) | (total != F.col(recorded)))
    return violation(bad, "allocation", F.col(key), total)


def covered(rows: DataFrame, label: str, verdicts: DataFrame) -> DataFrame:
    """Labels of the rows without a verdict."""
    have = rows.select(F.upper(F.col(label)).alias("l")).where("l is not null").groupBy("l").agg(F.count("*").alias("n"))
    return violation(have.join(verdicts.select(F.upper(F.col(label)).alias("l")).distinct(), "l", "left_anti"), "uncovered_label", F.col("l"), F.col("n"))


def log_passed(log: DataFrame, by: str, line: str, order: str) -> DataFrame:
    """Logs whose last execution status isn't PASS, or in which any is FAIL."""
    s = F.regexp_extract(F.col(line), r"Execution status:?\s*(PASS|FAIL)", 1)
    r = log.withColumn("s", s).where("s <> ''").groupBy(by).agg(F.max_by("s", order).alias("last"), F.count_if(F.col("s") == "FAIL").alias("fails"))
    return violation(r.where("last <> 'PASS' or fails > 0"), "log_status", F.col(by), F.concat_ws("/", "last", "fails"))


def neighbour_spec(specs: DataFrame, key: str) -> DataFrame:
    """Nearest-neighbour settings out of range: ``topn, metric, filter_by_label, distance_threshold``."""
    rules = {"topn": F.coalesce(F.col("topn") < 1, F.lit(True)), "metric": ~F.coalesce(F.col("metric").isin("cosine", "euclidean", "manhattan"), F.lit(False)), "filter_by_label": ~F.coalesce(F.lower("filter_by_label").isin("true", "false"), F.lit(False))}
    return all_of(*(violation(specs.where(c), rule, F.col(key), F.col(rule)) for rule, c in rules.items()))


def time_series(series: DataFrame, by: str, time: str, value: str, least: int) -> DataFrame:
    """Series shorter than ``least``, with values that aren't finite, or with steps other than their commonest one."""
    w = Window.partitionBy(by).orderBy(time)
    steps = series.withColumn("step", F.unix_micros(time) - F.unix_micros(F.lag(time).over(w)))
    n = series.groupBy(by).agg(F.count("*").alias("n"), F.count_if(F.isnan(value) | (F.abs(value) == F.lit(float("inf")))).alias("bad"))
    common = steps.where("step is not null").groupBy(by, "step").agg(F.count("*").alias("c")).groupBy(by).agg(F.max_by("step", F.struct("c", -F.col("step"))).alias("usual"))
    odd = steps.where("step is not null").join(common, by).groupBy(by).agg(F.count_if(F.col("step") != F.col("usual")).alias("odd"))
    return all_of(violation(n.where(F.col("n") < least), "too_short", F.col(by), F.col("n")), violation(n.where("bad > 0"), "not_finite", F.col(by), F.col("bad")), violation(odd.where("odd > 0"), "uneven_steps", F.col(by), F.col("odd")))


def filled(series: DataFrame, values: list[str]) -> DataFrame:
    """Null and not-a-number values as 0."""
    return series.withColumns({c: F.when(F.isnan(c), 0.0).otherwise(F.coalesce(F.col(c), F.lit(0.0))) for c in values})


def metric_contract(metrics: DataFrame, key: str) -> DataFrame:
    """Metric targets (``name, operator, value``): a name, a known operator and a finite value."""
    rules = {"name": F.coalesce(strip_blank(F.col("name")), F.lit("")) == "", "operator": ~F.coalesce(F.col("operator").isin("<", "<=", ">", ">="), F.lit(False)), "value": F.col("value").isNull() | F.isnan("value") | (F.abs("value") == F.lit(float("inf")))}
    return all_of(*(violation(metrics.where(c), rule, F.col(key), F.col(rule)) for rule, c in rules.items()))
