"""Queries of the general operators for training-data pipelines: nested records, orphan references, failed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators import nested, orphans, parsing
from gaugeworks.session import load


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    children = nested.manifest_children(load(spark, sf_dir, "model_manifests"))
    return children.where("child_name is not null and trim(parent_name) != ''").select("manifest_id", "parent_name", "pos", "child_name")


def p2_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parent table: each named action or model with its place, and how many entries its list has."""
    lists = nested.named_lists(load(spark, sf_dir, "model_manifests"), ["manifest_id"], "body", nested.LEVELS)
    parents = nested.flatten(lists, ["manifest_id"], "nested", ["[]"], value="entry")
    return parents.select("manifest_id", F.col("pos_0").alias("parent_pos"), F.col("entry.kind").alias("kind"), F.col("entry.parent").alias("parent_name"), F.size("entry.entries").alias("n_entries"))


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries with and without a name, by kind of list and document."""
    docs = load(spark, sf_dir, "model_manifests")
    entries = nested.manifest_children(docs).groupBy("manifest_id", "kind").agg(F.count("child_name").alias("named"), F.count_if(F.col("child_name").isNull()).alias("blank"))
    return docs.select("manifest_id", "doc_kind").join(entries, "manifest_id").groupBy("doc_kind", "kind").agg(F.count("*").alias("documents"), F.sum("named").alias("named"), F.sum("blank").alias("blank"))


def _run_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [load(spark, sf_dir, t) for t in ("deft_iterations", "loop_log", "artifacts", "stages")]


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The direct orphans, at which the cascade starts; :func:`p4_report` and :func:`p4_inherited` follow it to its fixpoint."""
    return orphans.direct_orphans(*_run_tables(spark, sf_dir))


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = orphans.run_orphans(*_run_tables(spark, sf_dir))
    return every.groupBy("src_table", "ref_month", "orphan_kind", "orphan_reason").agg(F.count("*").alias("orphans"), F.max("depth").alias("deepest"))


def p4_inherited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that are orphans only through others, with the number of steps to the nearest direct one."""
    every = orphans.run_orphans(*_run_tables(spark, sf_dir))
    return every.where("orphan_kind = 'inherited'").select("src_table", "row_key", "ref_month", "depth")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.failed_lines(load(spark, sf_dir, "raw_lines"), load(spark, sf_dir, "defect_labels"))


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by kind and reason, with the edits a repair would take; a null reason is a valid line."""
    rows, events = parsing.split_lines(load(spark, sf_dir, "raw_lines"), load(spark, sf_dir, "defect_labels"))
    cols = ["line_kind", "fail_reason", "quote_edits", "delimiter_edits"]
    none = F.lit(None).cast("long")
    both = rows.withColumn("line_kind", F.lit("inference_csv")).select(*cols).unionByName(events.select(F.lit("loop_log").alias("line_kind"), "fail_reason", none.alias("quote_edits"), none.alias("delimiter_edits")))
    return both.groupBy("line_kind", "fail_reason").agg(F.count("*").alias("lines"), F.sum("quote_edits").alias("quote_edits"), F.sum("delimiter_edits").alias("delimiter_edits"))


def p6_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = parsing.split_lines(load(spark, sf_dir, "raw_lines"), load(spark, sf_dir, "defect_labels"))
    return rows.where("fail_reason is null").select(F.col("id").alias("line_id"), "input_path", "golden_path", "label", "object_name", "score")


def p6_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, events = parsing.split_lines(load(spark, sf_dir, "raw_lines"), load(spark, sf_dir, "defect_labels"))
    return events.where("fail_reason is null").drop("fail_reason").withColumnRenamed("id", "line_id")


QUERIES = {"p2_found": p2_found, "p2_parents": p2_parents, "p2_report": p2_report, "p4_found": p4_found, "p4_report": p4_report, "p4_inherited": p4_inherited, "p6_found": p6_found, "p6_report": p6_report, "p6_rows": p6_rows, "p6_events": p6_events}

_PATH = "nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '\\', '/'), '^file://', '', 'i'), '/{{2,}}', '/', 'g'), '(^|/)(?:\\.(?:/|$))+', '\\1', 'g'), '/+$', ''), '')"
_BLANKLESS = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"

P4 = f"""
with refs as (
  select 'deft_iterations' src_table, state_id row_key, 'best_ckpt_path' ref_field, {_PATH.format(c="best_ckpt_path")} k, updated_at tm from deft_iterations
  union all select 'deft_iterations', state_id, 'inference_csv', {_PATH.format(c="inference_csv")}, updated_at from deft_iterations
  union all select 'loop_log', log_id, 'stage', lower({_BLANKLESS.format(c="stage")}), ts from loop_log),
lives as (
  select 'deft_iterations' t, {_PATH.format(c="artifact_path")} k, created_at s, deleted_at e from artifacts
  union all select 'loop_log', lower({_BLANKLESS.format(c="stage_name")}), introduced_at, retired_at from stages),
checked as (
  select r.src_table, r.row_key, r.ref_field, r.tm, count(l.k) n, count(case when l.s <= r.tm then 1 end) started, count(case when l.s <= r.tm and (l.e is null or r.tm < l.e) then 1 end) there
  from refs r left join lives l on l.t = r.src_table and l.k = r.k where r.k is not null and r.k <> '' group by all)
select src_table, row_key, ref_field, case when started > 0 then 'deleted' when n > 0 then 'late' else 'missing' end orphan_reason, strftime(tm, '%Y-%m') ref_month
from checked where there = 0"""

P6 = f"""
with lines as (select line_id, line_kind, regexp_replace(raw_line, '\\r$', '') t from raw_lines where {_BLANKLESS.format(c="raw_line")} <> ''),
inference as (
  select line_id, regexp_full_match(t, '(?s)(?:"(?:[^"]|"")*"|[^",]*)(?:,(?:"(?:[^"]|"")*"|[^",]*))*') formed, regexp_extract_all(',' || t, '(?s),((?:"(?:[^"]|"")*"|[^",]*))', 1) f from lines where line_kind = 'inference_csv'),
named as (select line_id, formed, len(f) n, {_BLANKLESS.format(c="trim(f[3], chr(34))")} lab, {_BLANKLESS.format(c="trim(f[5], chr(34))")} score from inference)
select line_id, case when not formed then 'broken_quoting' when n <> 5 then 'column_count' when lower(lab) not in (select lower(label) from defect_labels) then 'invalid_label' else 'invalid_score' end fail_reason
from named where not formed or n <> 5 or lower(lab) not in (select lower(label) from defect_labels)
  or not regexp_full_match(score, '\\+?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') or isinf(try_cast(score as double))
union all
select line_id, case when bad then 'bad_json' else 'invalid_status' end
from (select line_id, j, not coalesce(json_valid(j), false) or left(j, 1) <> '{{' or regexp_matches(regexp_replace(j, '"(?:[^"\\\\]|\\\\.)*"', '""', 'g'), ',\\s*[}}\\]]') bad
  from (select line_id, {_BLANKLESS.format(c="t")} j from lines where line_kind = 'loop_log'))
where bad or coalesce(json_extract(case when not bad then j end, '$.status')::varchar, '') not in ('"ok"', '"error"')"""

_ITER = "case when lower(trim(iter)) = 'baseline' then 0 else try_cast(nullif(regexp_extract(lower(trim(iter)), '^iter(\\d{1,9})$', 1), '') as int) end"

_CASCADE = f"""
with recursive direct as ({P4}),
states as (select state_id, run_id, {_ITER} n, updated_at tm from deft_iterations where run_id is not null),
g as (select distinct s.run_id, s.n, 0 depth from states s join direct d on d.src_table = 'deft_iterations' and d.row_key = s.state_id where s.n is not null
  union select s.run_id, s.n, g.depth + 1 from g join states s on s.run_id = g.run_id and s.n = g.n + 1),
o as (select run_id, n, min(depth) + 1 depth from g group by all),
inherited as (select 'deft_iterations' src_table, s.state_id row_key, strftime(s.tm, '%Y-%m') ref_month, o.depth from states s join o on o.run_id = s.run_id and o.n = s.n - 1
  union all select 'loop_log', l.log_id, strftime(l.ts, '%Y-%m'), o.depth from (select *, {_ITER} n from loop_log) l join o on o.run_id = l.run_id and o.n = l.n),
every as (select src_table, row_key, ref_month, 'direct' orphan_kind, orphan_reason, 0 depth from direct
  union all select src_table, row_key, ref_month, 'inherited', null, depth from inherited i where not exists (select 1 from direct d where d.src_table = i.src_table and d.row_key = i.row_key))"""
P4_REPORT = f"""{_CASCADE}
select src_table, ref_month, orphan_kind, orphan_reason, count(*) orphans, max(depth) deepest from every group by all"""
P4_INHERITED = f"{_CASCADE} select src_table, row_key, ref_month, depth from every where orphan_kind = 'inherited'"

_UNQUOTED = "case when starts_with(f[{i}], chr(34)) then replace(f[{i}][2:-2], chr(34) || chr(34), chr(34)) else f[{i}] end"
P6_ROWS = P6[: P6.index("named as (")].rstrip().rstrip(",") + f"""
select line_id, {_UNQUOTED.format(i=1)} input_path, {_UNQUOTED.format(i=2)} golden_path, {_BLANKLESS.format(c=_UNQUOTED.format(i=3))} label, {_UNQUOTED.format(i=4)} object_name, {_BLANKLESS.format(c=_UNQUOTED.format(i=5))}::double score
from inference where line_id not in (select line_id from ({P6}))"""

ORACLE = {"p4_found": P4, "p4_report": P4_REPORT, "p4_inherited": P4_INHERITED, "p6_found": P6, "p6_rows": P6_ROWS}
