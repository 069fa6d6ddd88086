"""Nearest neighbours and similarity floors over ``embeddings``: every id divisible by 50 is a target, the rest are sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.operators import similarity as sim
from gaugeworks.plans.base import Module, rounded, with_rounded

M = Module()
add = M.add

V = """with e as (select vec_id id, embedding::double[] vec, label from embeddings), tg as (select * from e where id % 50 = 0), sr as (select * from e where id % 50 <> 0),
p as (select tg.id t_id, tg.label t_label, sr.id s_id, sr.label s_label, greatest(-1, least(1, list_cosine_similarity(tg.vec, sr.vec))) sim, list_distance(tg.vec, sr.vec) l2 from tg cross join sr),
r as (select *, 1 - sim distance, row_number() over (partition by t_id order by 1 - sim, s_id) place from p),
rl as (select *, 1 - sim distance, row_number() over (partition by t_id order by 1 - sim, s_id) place from p where t_label = s_label)"""


def sides(t):
    e = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")
    return e.where("id % 50 = 0"), e.where("id % 50 <> 0")


@add("join_knn_topn", V + " select t_id, s_id, place, round(distance, 6) distance from r where place <= 5")
def _(t):
    return with_rounded(sim.nearest(*sides(t)).select("t_id", "s_id", "place", "distance"), "distance")


@add("join_knn_label", V + " select t_id, s_id, place, round(distance, 6) distance from rl where place <= 5")
def _(t):
    return with_rounded(sim.nearest(*sides(t), on_label=True).select("t_id", "s_id", "place", "distance"), "distance")


@add("fn_euclidean", V + " select t_id, s_id, place, round(l2, 6) distance from (select *, row_number() over (partition by t_id order by l2, s_id) place from p where l2 <= 1.3) where place <= 3")
def _(t):
    return with_rounded(sim.nearest(*sides(t), k=3, metric="euclidean", max_distance=1.3).select("t_id", "s_id", "place", "distance"), "distance")


@add("join_knn_mined", V + " select s_id, count(*) n_targets, round(min(distance), 6) best_distance from r where place <= 5 group by 1")
def _(t):
    return with_rounded(sim.mined(sim.nearest(*sides(t))), "best_distance")


FLOOR = V + ", f as (select s_id id, max(sim) max_similarity, max(sim) >= 0.3 kept from p group by 1)"


@add("join_nested_loop_max", FLOOR + " select id, round(max_similarity, 6) max_similarity, kept from f")
def _(t):
    targets, sources = sides(t)
    return with_rounded(sim.similarity_floor(sources, targets, 0.3).select("id", "max_similarity", "kept"), "max_similarity")


@add("sel_best_target", V + " select s_id id, t_id matched_target from (select *, row_number() over (partition by s_id order by sim desc, t_id) n from p where t_label = s_label) where n = 1")
def _(t):
    targets, sources = sides(t)
    return sim.similarity_floor(sources, targets, 0.0, on_label=True).select("id", "matched_target")


@add("agg_similarity_summary", FLOOR + " select count(*) candidate_count, count(*) filter (kept) kept_count, count(*) filter (not kept) rejected_count, 0.3::double similarity_threshold, round(min(f.max_similarity), 6) min_similarity, round(max(f.max_similarity), 6) max_similarity, round(avg(f.max_similarity), 6) mean_similarity from f")
def _(t):
    targets, sources = sides(t)
    return with_rounded(sim.floor_summary(sim.similarity_floor(sources, targets, 0.3), 0.3), "min_similarity", "max_similarity", "mean_similarity")


@add("agg_retrieval", V + """, h as (select *, (t_label = s_label)::int hit from r where place <= 5), c as (select *, sum(hit) over (partition by t_id order by place) hits from h),
q as (select t_id, min(place) filter (hit = 1) f, sum(hit * hits / place) / nullif(sum(hit), 0) ap from c group by 1)
select count(*) queries, round(avg(coalesce((f <= 1)::int, 0)), 6) rank_1, round(avg(coalesce((f <= 5)::int, 0)), 6) rank_5, round(avg(coalesce(ap, 0)), 6) mean_ap from q""")
def _(t):
    return with_rounded(sim.retrieval(sim.nearest(*sides(t))), "rank_1", "rank_5", "mean_ap")


@add("agg_knn_classify", V + ", v as (select t_id, t_label, s_label, count(*) votes, sum(distance) far from r where place <= 5 group by all) select t_id, t_label, s_label predicted, votes from (select *, row_number() over (partition by t_id order by votes desc, round(far, 9), s_label) n from v) where n = 1")
def _(t):
    return sim.knn_labels(sim.nearest(*sides(t)))


@add("agg_semantic_dedup", "select b.vec_id id, min(a.vec_id) duplicate_of from embeddings a join embeddings b on a.vec_id < b.vec_id and round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 12) >= 0.3 group by 1")
def _(t):
    return sim.semantic_duplicates(t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label"), 0.3)


@add("agg_top3_mean", "with e as (select user_id, value, row_number() over (partition by user_id order by value desc) n from events) select user_id, round(avg(value), 6) best_mean from e where n <= 3 group by 1")
def _(t):
    return with_rounded(sim.mean_of_best(t("events"), "user_id", "value"), "best_mean")


@add("join_hash_unique_build", "select l_orderkey, count(*) n, round(sum(o_totalprice), 2) total from lineitem join orders on l_orderkey = o_orderkey group by 1")
def _(t):
    probe = t("lineitem").select(F.col("l_orderkey").cast("string").alias("k"), "l_orderkey")
    build = t("orders").select(F.col("o_orderkey").cast("string").alias("k"), "o_totalprice")
    joined, _ = sim.strict_lookup(probe, build, "k")
    return joined.groupBy("l_orderkey").agg(F.count("*").alias("n"), rounded(F.sum("o_totalprice"), 2).alias("total"))


@add("join_strict_violations", "select 'missing' rule, c_custkey::varchar \"key\" from customer where c_custkey not in (select o_custkey from orders) union all select 'duplicate', o_custkey::varchar from orders group by o_custkey having count(*) > 1")
def _(t):
    probe, build = t("customer").select(F.col("c_custkey").cast("string").alias("k")), t("orders").select(F.col("o_custkey").cast("string").alias("k"))
    return sim.strict_lookup(probe, build, "k")[1]


QUERIES, ORACLE = M.queries, M.oracle
