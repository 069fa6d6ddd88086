"""Queries of the training-data operators, and SQL for those it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import history, mixing, overlap, packing, readability, vectors
from gaugeworks.session import load


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = F.col("state_field")
    side = F.when(field == "mining_target_embeddings", True).when(field == "mining_source_embeddings", False)
    top = vectors.most_similar(load(spark, sf_dir, "mining_embeddings"), "vec_id", side, "embedding")
    return top.select(F.least("target", "source").alias("vec_a"), F.greatest("target", "source").alias("vec_b"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.offered_rows(load(spark, sf_dir, "curation_rows")).select(F.col("id").alias("row_id"))


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New and repeated rows of each batch and field."""
    rows = load(spark, sf_dir, "curation_rows")
    cases = history.offered_rows(rows).select(F.col("id").alias("row_id"), F.lit(True).alias("repeated"))
    joined = rows.select("row_id", "batch_no", "artifact_field").join(cases, "row_id", "left")
    return joined.groupBy("batch_no", "artifact_field").agg(F.count("*").alias("rows"), F.count("repeated").alias("repeated"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = overlap.cross_split_pairs(load(spark, sf_dir, "split_records"))
    return pairs.select(F.least("evaluation", "training").alias("record_a"), F.greatest("evaluation", "training").alias("record_b"))


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation records that overlap with training, and their pairs, by split, source and kind of match."""
    rows = load(spark, sf_dir, "split_records")
    pairs = overlap.cross_split_pairs(rows).withColumnRenamed("evaluation", "record_id")
    named = rows.select("record_id", "split_field", mixing.source_key(F.col("source")).alias("source_name"))
    return pairs.join(named, "record_id").groupBy("split_field", "source_name", "how").agg(F.count("*").alias("pairs"), F.count_distinct("record_id").alias("records"))


def p7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill(p7_pack(spark, sf_dir))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents"), load(spark, sf_dir, "source_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = load(spark, sf_dir, "source_targets")
    return mixing.shares(mixing.mix(load(spark, sf_dir, "documents"), targets), targets)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    english = docs.where(readability.language(F.col("lang")) == "en")
    return readability.reading_bands(readability.reading_levels(english)).where("reading_band is not null").select("doc_id", "reading_band")


def p9_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readability.reading_bands(readability.reading_levels(load(spark, sf_dir, "documents")))


def p9_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mixing.source_key(F.col("source")).alias("source_name"))
    return named.join(readability.reading_levels(docs), "doc_id").groupBy("source_name").agg(F.count("*").alias("documents"), F.count("level").alias("graded"), F.avg("level").alias("mean_level"), F.percentile_approx("level", [0.1, 0.5, 0.9]).alias("level_deciles"))


QUERIES = {"p1_found": p1_found, "p3_found": p3_found, "p3_report": p3_report, "p5_found": p5_found, "p5_report": p5_report, "p7_pack": p7_pack, "p7_fill": p7_fill, "p8_mix": p8_mix, "p8_shares": p8_shares, "p9_found": p9_found, "p9_levels": p9_levels, "p9_profile": p9_profile}
P5 = r"""
with r as (select record_id, split_field in ('training_csv', 'combined_training_json') train, question,
    coalesce(regexp_replace(input_path, '^\s+|\s+$', '', 'g'), '') a, coalesce(regexp_replace(golden_path, '^\s+|\s+$', '', 'g'), '') b, coalesce(regexp_replace(label, '^\s+|\s+$', '', 'g'), '') c, coalesce(regexp_replace(object_name, '^\s+|\s+$', '', 'g'), '') d
  from split_records where split_field in ('training_csv', 'combined_training_json', 'validation_csv', 'kpi_test_csv')),
w as (select record_id, train, regexp_extract_all(lower(question), '[a-z0-9]+') w from r),
s as (select record_id, train, unnest(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) g from w where len(w) >= 3),
n as (select record_id, count(*) n from s group by 1),
near as (select e.record_id x, t.record_id y, count(*) o from s e join s t on e.g = t.g and t.train and not e.train group by all),
pairs as (select x, y from near join n a on a.record_id = x join n b on b.record_id = y where 5 * o >= 3 * (a.n + b.n - o)
  union select e.record_id, t.record_id from r e join r t on t.train and not e.train and e.a = t.a and e.b = t.b and e.c = t.c and e.d = t.d and e.a <> '' and e.d <> '')
select least(x, y) record_a, greatest(x, y) record_b from pairs"""

ORACLE: dict[str, str] = {"p5_found": P5}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
