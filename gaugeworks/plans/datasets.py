"""Set building, leaks, splits, routing and allocation over ``split_records``, ``curation_rows``, ``part`` and ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.functions.paths import path_key, strip_blank
from gaugeworks.operators import dataset as ds
from gaugeworks.plans.base import Module
from gaugeworks.plans.pipeline import _BLANKLESS, _PATH

M = Module()
add = M.add

TRAIN = ("training_csv", "combined_training_json")


def by_role(t, *roles):
    return t("split_records").where(F.col("split_field").isin(*roles))


@add("agg_ordered_distinct", "with k as (select input_path \"key\", 0 column_no, min(record_id) first_row from split_records where input_path is not null group by 1 union all select golden_path, 1, min(record_id) from split_records where golden_path is not null group by 1) select \"key\", column_no, first_row from (select *, row_number() over (partition by \"key\" order by column_no, first_row) n from k) where n = 1")
def _(t):
    return ds.ordered_distinct(t("split_records"), ["input_path", "golden_path"], ["record_id"]).withColumn("first_row", F.col("first_row.record_id"))


@add("agg_first_wins", "select record_id from (select record_id, row_number() over (partition by input_path, golden_path order by record_id) n from split_records) where n = 1")
def _(t):
    return ds.first_wins(t("split_records"), [F.col("input_path"), F.col("golden_path")], ["record_id"]).select("record_id")


_UNION = "select 0 source_no, 'seed' source, record_id, input_path, golden_path, row_number() over (order by record_id) - 1 source_index from split_records where split_field = 'training_csv' union all select 1, 'pool', record_id, input_path, golden_path, row_number() over (order by record_id) - 1 from split_records where split_field = 'combined_training_json'"


def pools(t):
    cols = ["record_id", "input_path", "golden_path"]
    return {"seed": by_role(t, "training_csv").select(*cols), "pool": by_role(t, "combined_training_json").select(*cols)}


@add("set_union_provenance", f"select source_no, source, record_id, source_index from ({_UNION})")
def _(t):
    return ds.union_with_provenance(pools(t), "record_id").select("source_no", "source", "record_id", "source_index")


@add("set_union_csv_monotonic", f"select record_id, source, source_index from (select *, row_number() over (partition by input_path, golden_path order by source_no, source_index) n from ({_UNION})) where n = 1")
def _(t):
    return ds.assemble(pools(t), ["input_path", "golden_path"], "record_id").select("record_id", "source", "source_index")


_KEY = ", ".join(f"coalesce({_BLANKLESS.format(c=c)}, '') {c}" for c in ds.LEAK_KEY)


@add("join_semi_leak", f"with tr as (select record_id, {_KEY} from split_records where split_field in ('training_csv', 'combined_training_json')), va as (select distinct {_KEY} from split_records where split_field = 'validation_csv') select record_id from tr semi join va using (input_path, golden_path, label, object_name, boardname)")
def _(t):
    return ds.leaks(by_role(t, *TRAIN), by_role(t, "validation_csv"), ["record_id"])


@add("join_semi_target_leak", f"select record_id from split_records where split_field in ('training_csv', 'combined_training_json') and {_BLANKLESS.format(c='input_path')} in (select {_BLANKLESS.format(c='input_path')} from split_records where split_field in ('validation_csv', 'kpi_test_csv') and {_BLANKLESS.format(c='input_path')} <> '')")
def _(t):
    target = strip_blank(F.col("input_path")).alias("target")
    ev = by_role(t, "validation_csv", "kpi_test_csv").select(target).where("target <> ''").distinct()
    return by_role(t, *TRAIN).select("record_id", target).join(ev, "target", "left_semi").select("record_id")


_ROLES = f"with k as (select distinct split_field \"role\", {_PATH.format(c='input_path')} \"key\" from split_records where {_PATH.format(c='input_path')} is not null)"


def roles(t):
    return t("split_records").select(F.col("split_field").alias("role"), path_key(F.col("input_path")).alias("key"))


@add("set_intersect_roles", _ROLES + " select a.\"role\" role_a, b.\"role\" role_b, count(*) shared from k a join k b on a.\"key\" = b.\"key\" and a.\"role\" < b.\"role\" group by all")
def _(t):
    return ds.role_overlaps(roles(t))


@add("set_unique", f"select split_field \"role\", {_PATH.format(c='input_path')} \"key\", count(*) n from split_records where {_PATH.format(c='input_path')} is not null group by all having count(*) > 1")
def _(t):
    return ds.repeated_in_role(roles(t))


@add("set_synthetic_isolation", _ROLES + " select count(*) shared from (select \"key\" from k where \"role\" = 'combined_training_json' intersect select \"key\" from k where \"role\" in ('validation_csv', 'kpi_test_csv'))")
def _(t):
    k = roles(t).where("key is not null")
    return k.where("role = 'combined_training_json'").select("key").intersect(k.where("role in ('validation_csv', 'kpi_test_csv')").select("key")).agg(F.count("*").alias("shared"))


@add("set_train_subset", _ROLES + " select \"key\" from k where \"role\" = 'training_csv' except select \"key\" from k where \"role\" in ('combined_training_json', 'kpi_test_csv')")
def _(t):
    k = roles(t)
    return ds.outside(k.where("role = 'training_csv'"), k.where("role in ('combined_training_json', 'kpi_test_csv')"), "key")


@add("agg_unique_targets", _ROLES + ", a as (select distinct \"key\" from k where \"role\" in ('training_csv', 'combined_training_json')), b as (select distinct \"key\" from k where \"role\" in ('validation_csv', 'kpi_test_csv')) select (select count(*) from a) training, (select count(*) from b) evaluation, (select count(*) from a semi join b using (\"key\")) shared, (select count(*) from a anti join b using (\"key\")) training_only")
def _(t):
    k = roles(t)
    return ds.unique_targets(k.where(F.col("role").isin(*TRAIN)), k.where("role in ('validation_csv', 'kpi_test_csv')"), "key")


_ROUTE = "with p as (select distinct upper(label) u from split_records where label is not null), r as (select row_id, upper(c.label) u, p.u is not null to_mining, coalesce(upper(c.label) in ('PASS', 'EXCESS_SOLDER', 'MISSING', 'BRIDGE'), false) to_generator from curation_rows c left join p on upper(c.label) = p.u)"


@add("route_samples", _ROUTE + " select row_id, to_mining, to_generator from r")
def _(t):
    return ds.route(t("curation_rows"), t("split_records")).select("row_id", "to_mining", "to_generator")


@add("route_summary", _ROUTE + " select u label_upper, count(*) n, bool_or(to_mining) to_mining, bool_or(to_generator) to_generator from r group by 1")
def _(t):
    return ds.route_summary(ds.route(t("curation_rows"), t("split_records")))


@add("agg_label_counts", "select label, count(*) n from curation_rows group by 1")
def _(t):
    return ds.label_counts(t("curation_rows"), "label")


@add("join_anti_precheck", "select label, count(*) n_targets from mining_embeddings where state_field = 'mining_target_embeddings' and label is not null and label not in (select label from split_records where label is not null) group by 1")
def _(t):
    targets = t("mining_embeddings").where("state_field = 'mining_target_embeddings' and label is not null")
    return ds.labels_without_source(targets, t("split_records"), "label")


@add("join_anti_resume", "select c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def _(t):
    return t("customer").join(t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@add("alloc_uniform", "with g as (select distinct p_brand from part), r as (select p_brand, row_number() over (order by p_brand) n, count(*) over () k from g) select p_brand, (1003 // k + (n <= 1003 % k)::int)::bigint share from r")
def _(t):
    return ds.allocate_uniform(t("part"), "p_brand", 1003)


@add("alloc_proportional", "with g as (select p_brand, count(*) w from part group by 1), e as (select p_brand, w * 777 / sum(w) over () x from g), r as (select p_brand, floor(x) b, 777 - sum(floor(x)) over () l, row_number() over (order by round(x - floor(x), 9) desc, p_brand) n from e) select p_brand, (b + (n <= l)::int)::bigint share, b + (n <= l)::int < 1 too_small from r")
def _(t):
    return ds.allocate_proportional(t("part").groupBy("p_brand").agg(F.count("*").alias("w")), "p_brand", "w", 777)


@add("alloc_pairs")
def _(t):
    masks, cleans = t("part").select(F.col("p_name").alias("mask")).distinct(), t("part").select(F.col("p_brand").alias("clean")).distinct()
    return ds.pair_plan(masks, cleans, 3000)


@add("sel_quota_greedy", """with r as (select event_id id, event_type, case when event_type = 'view' and value < 2 then null else value / 100 end score, event_id % 3 attempt from events),
k as (select *, case when attempt = 0 and score >= 0.4 then 0 when attempt > 0 and score >= 0.4 then 1 when attempt > 0 then 2 else 3 end tier from r where score is not null),
n as (select *, row_number() over (partition by event_type order by tier, score desc, id) place from k) select id, event_type, tier, place from n where place <= 700""")
def _(t):
    e = t("events").select(F.col("event_id").alias("id"), "event_type", F.when(~((F.col("event_type") == "view") & (F.col("value") < 2)), F.col("value") / 100).alias("score"), (F.col("event_id") % 3).alias("attempt"))
    quotas = t("events").select("event_type").distinct().withColumn("quota", F.lit(700))
    return ds.refill(e, quotas, "event_type", 0.4).select("id", "event_type", "tier", "place")


@add("sel_best_round", "select user_id, event_id from (select user_id, event_id, row_number() over (partition by user_id order by value desc nulls last, event_id) n from events) where n = 1")
def _(t):
    return ds.best_round(t("events"), "user_id", "value", ["event_id"]).select("user_id", "event_id")


@add("join_round_align", "with b as (select user_id, max(value) v from events where event_type = 'view' group by 1), r as (select user_id, count(*) rounds, max(value) best from events where event_type <> 'view' group by 1) select user_id, b.v base_value, coalesce(rounds, 0) rounds, best from b left join r using (user_id)")
def _(t):
    base = t("events").where("event_type = 'view'").groupBy("user_id").agg(F.max("value").alias("value"))
    return ds.round_alignment(base, t("events").where("event_type <> 'view'").select("user_id", "value"), "user_id", "value")


@add("sample_shuffle_split")
def _(t):
    return ds.split_by_hash(t("split_records"), "record_id", {"train": 0.8, "eval": 0.2}).select("record_id", "part")


@add("split_temporal", "select event_id, case when row_number() over (order by ts, event_id) - 1 >= round(count(*) over () * 0.9) then 'validation' else 'train' end part from events")
def _(t):
    return ds.split_by_time(t("events"), "ts", "event_id", 0.1).select("event_id", "part")


@add("limit_prefix", "select event_id, ts from events order by ts, event_id limit 100")
def _(t):
    return t("events").orderBy("ts", "event_id").limit(100).select("event_id", "ts")


@add("agg_group_media", "with o as (select filepath, run_id, count(*) n, min(row_id) f from curation_rows where filepath is not null group by all) select filepath, sum(n)::bigint row_count, coalesce(list(run_id order by f) filter (run_id is not null), []) ids, left(sha256(filepath), 16) sample_id from o group by 1")
def _(t):
    return ds.media_map(t("curation_rows"), "filepath", "run_id", "row_id")


@add("join_multi_key_index", "with c as (select s_name canonical, unnest([lower(s_name), s_suppkey::varchar]) k from supplier), a as (select distinct l_suppkey::varchar asked from lineitem) select asked, count(canonical) n, case when count(canonical) = 1 then min(canonical) end canonical from a left join c on c.k = a.asked group by 1")
def _(t):
    catalog = t("supplier").select(F.col("s_name").alias("canonical"), "s_name", F.col("s_suppkey").cast("string").alias("s_suppkey"))
    return ds.resolve_names(t("lineitem").select(F.col("l_suppkey").cast("string").alias("asked")), catalog, ["s_name", "s_suppkey"])


@add("join_lookup_resolve", "with c as (select n_name canonical, unnest([lower(n_name), n_nationkey::varchar]) k from nation), a as (select distinct upper(n_name) asked from nation union select distinct c_mktsegment from customer) select asked, count(canonical) n, case when count(canonical) = 1 then min(canonical) end canonical from a left join c on c.k = lower(a.asked) group by 1")
def _(t):
    catalog = t("nation").select(F.col("n_name").alias("canonical"), "n_name", F.col("n_nationkey").cast("string").alias("no"))
    asked = t("nation").select(F.upper("n_name").alias("asked")).union(t("customer").select("c_mktsegment"))
    return ds.resolve_names(asked, catalog, ["n_name", "no"])


@add("set_merge_inputs", "select distinct filepath from (select filepath from curation_rows union select filepath from mining_embeddings) where filepath is not null")
def _(t):
    return t("curation_rows").select("filepath").union(t("mining_embeddings").select("filepath")).where("filepath is not null").distinct()


@add("set_missing_columns", "select unnest(['missing_a', 'missing_b']) missing")
def _(t):
    wanted = {*t("split_records").columns, "missing_a", "missing_b"}
    return t.spark.createDataFrame([(c,) for c in sorted(wanted - set(t("split_records").columns))], "missing string")


@add("join_left_outcome", "with m as (select distinct artifact_path p from artifacts where deleted_at is null) select state_id, case when best_ckpt_path is null then 'no_path' when m.p is null then 'failed' else 'generated' end outcome from deft_iterations d left join m on d.best_ckpt_path = m.p")
def _(t):
    have = t("artifacts").where("deleted_at is null").select(F.col("artifact_path").alias("best_ckpt_path")).distinct().withColumn("_in", F.lit(True))
    outcome = F.when(F.col("best_ckpt_path").isNull(), "no_path").when(F.col("_in"), "generated").otherwise("failed")
    return t("deft_iterations").join(have, "best_ckpt_path", "left").select("state_id", outcome.alias("outcome"))


@add("join_recover_images", "select c.row_id, s.record_id from curation_rows c join (select input_path, min(record_id) record_id from split_records group by 1) s on c.boardname = s.input_path or false")
def _(t):
    first = t("split_records").groupBy("input_path").agg(F.min("record_id").alias("record_id"))
    return t("curation_rows").join(first, F.col("boardname") == F.col("input_path")).select("row_id", "record_id")


@add("join_report_labels", "select s.vec_id, t.label target_label from mining_embeddings s join (select filepath, min(label) label from mining_embeddings where state_field = 'mining_target_embeddings' group by 1) t using (filepath)")
def _(t):
    e = t("mining_embeddings")
    targets = e.where("state_field = 'mining_target_embeddings'").groupBy("filepath").agg(F.min("label").alias("target_label"))
    return e.join(targets, "filepath").select("vec_id", "target_label")


@add("shard", "select doc_id, doc_id % 8 shard from documents")
def _(t):
    return t("documents").select("doc_id", F.pmod("doc_id", F.lit(8)).alias("shard"))


@add("agg_file_set_hash")
def _(t):
    from gaugeworks.operators.evaluation import set_hash

    return set_hash(by_role(t, "kpi_test_csv"), "record_id")


@add("agg_allocation_sum", "select p_brand, sum(p_size)::bigint total from part group by 1")
def _(t):
    per = t("part").groupBy("p_brand", "p_type").agg(F.sum("p_size").alias("n"))  # few types, so the maps are small
    maps = per.groupBy("p_brand").agg(F.map_from_entries(F.collect_list(F.struct("p_type", "n"))).alias("m"))
    return maps.select("p_brand", F.aggregate(F.map_values("m"), F.lit(0).cast("long"), lambda s, x: s + x).alias("total"))




QUERIES, ORACLE = M.queries, M.oracle
