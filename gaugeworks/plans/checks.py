"""Constraints over whole tables, each as its violations."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.functions.paths import path_key
from gaugeworks.operators import dataset as ds
from gaugeworks.operators import evaluation as ev
from gaugeworks.operators import quality as q
from gaugeworks.plans.base import Module, rounded, with_rounded
from gaugeworks.plans.pipeline import _BLANKLESS, _PATH

M = Module()
add = M.add


@add("dq_label_case", f"with s as (select record_id::varchar \"key\", label, {_BLANKLESS.format(c='label')} b from split_records) select 'blank_label' rule, \"key\", coalesce(label, '') detail from s where coalesce(b, '') = '' union all select 'label_spelling', \"key\", label from s where b <> '' and label <> case when label = 'PASS' then label else lower(b) end")
def _(t):
    return q.label_spelling(t("split_records"), "record_id", "label")


@add("limit_errors_5", f"with s as (select record_id::varchar \"key\", coalesce(label, '') detail from split_records where coalesce({_BLANKLESS.format(c='label')}, '') = '') select 'blank_label' rule, \"key\", detail, place, total from (select *, row_number() over (order by \"key\", detail) place, count(*) over () total from s) where place <= 5")
def _(t):
    return q.first_offenders(q.label_spelling(t("split_records"), "record_id", "label").where("rule = 'blank_label'"))


@add("limit_json_check", "with f as (select * from split_records order by added_at, record_id limit 200) select 'null_field' rule, record_id::varchar \"key\", 'label' detail from f where label is null union all select 'null_field', record_id::varchar, 'question' from f where question is null")
def _(t):
    return q.required_fields(t("split_records"), "record_id", ["label", "question"], ["added_at", "record_id"], 200)


_P = f"translate({_BLANKLESS.format(c='filepath')}, '\\', '/')"


@add("dq_abs_or_flat_path", f"select 'absolute_path' rule, row_id::varchar \"key\", filepath detail from curation_rows where regexp_matches({_P}, '^(?:/|[A-Za-z]:/|file:)') union all select 'image_path', row_id::varchar, filepath from curation_rows where regexp_matches(lower({_P}), '\\.(?:jpe?g|png|bmp|tiff?)$')")
def _(t):
    return q.path_form(t("curation_rows"), "row_id", "filepath")


@add("dq_paths_exist", f"select 'missing_file' rule, state_id::varchar \"key\", {_PATH.format(c='best_ckpt_path')} detail from deft_iterations where {_PATH.format(c='best_ckpt_path')} not in (select {_PATH.format(c='artifact_path')} from artifacts where {_PATH.format(c='artifact_path')} is not null)")
def _(t):
    listing = t("artifacts").select(path_key(F.col("artifact_path")).alias("key")).where("key is not null")
    return q.paths_exist(t("deft_iterations"), "state_id", path_key(F.col("best_ckpt_path")), listing)


@add("dq_batch_size", "select 'batch_size' rule, '*' \"key\", count(*)::varchar detail from nation having count(*) // 4 < 16")
def _(t):
    return q.all_of(q.batch_size(t("nation"), 16, 4), q.batch_size(t("orders"), 16, 4))


@add("dq_single_class", "select 'single_class' rule, '*' \"key\", '0/' || count(*) detail from region")
def _(t):
    return q.all_of(q.class_balance(t("region"), "r_name"), q.class_balance(t("curation_rows"), "label"))


def dialogues(t):
    e = t("split_records")
    images = F.when(F.col("golden_path").isNull(), F.array("input_path")).otherwise(F.array("input_path", "golden_path"))
    null = F.lit(None).cast("string")
    turn = lambda who, text: F.struct(F.lit(who).alias("from"), text.alias("value"), null.alias("role"), null.alias("content"))
    return e.select(F.col("object_name").alias("id"), images.alias("images"), F.array(turn("human", F.col("question")), turn("gpt", F.when(F.col("label") == "PASS", "OK").otherwise("NG"))).alias("conversations"))


@add("dq_sharegpt", """select * from (with d as (select object_name id, input_path target, case when golden_path is null then 1 else 2 end n, nullif(regexp_replace(question, '^\\s+|\\s+$', '', 'g'), '') p from split_records)
select 'two_images' rule, count(*) n from d where n <> 2 union all select 'no_prompt', count(*) from d where p is null union all select 'unsafe_id', count(*) from d where id is null or id <> trim(regexp_replace(regexp_replace(id, '^\\s+|\\s+$', '', 'g'), '[^A-Za-z0-9._-]+', '-', 'g'), '-')
union all select 'repeated_id', count(*) from (select id from d where id is not null group by 1 having count(*) > 1) union all select 'repeated_target', count(*) from (select target from d where target is not null group by 1 having count(*) > 1)) where n > 0""")
def _(t):
    return q.conversations(dialogues(t)).groupBy("rule").agg(F.count("*").alias("n"))


@add("dq_roles", "select split_field \"role\", count(*) n, count(*) filter (input_path is null or trim(input_path) = '') no_target, count(*) - count(golden_path) no_golden from split_records group by 1")
def _(t):
    blank = F.col("input_path").isNull() | (F.trim("input_path") == "")
    return t("split_records").groupBy(F.col("split_field").alias("role")).agg(F.count("*").alias("n"), F.count_if(blank).alias("no_target"), F.count_if(F.col("golden_path").isNull()).alias("no_golden"))


@add("dq_single_prompt", "select 'single_prompt' rule, '*' \"key\", count(distinct question)::varchar detail from split_records having count(distinct question) <> 1")
def _(t):
    return q.single_prompt(t("split_records"), "question")


@add("dq_mining_counts", "with m as (select o_orderkey, count(*) c, count(*) filter (l_quantity > 25) k, count(*) filter (l_quantity < 25) r from orders join lineitem on l_orderkey = o_orderkey group by 1) select 'mining_counts' rule, o_orderkey::varchar \"key\", c || '/' || k || '/' || r detail from m where c <> k + r")
def _(t):
    m = t("orders").join(t("lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey").agg(F.count("*").alias("candidate_count"), F.count_if(F.col("l_quantity") > 25).alias("kept_count"), F.count_if(F.col("l_quantity") < 25).alias("rejected_count"))
    return q.mining_counts(m, "o_orderkey")


@add("dq_allocation", "with m as (select p_brand, sum(p_size)::bigint s, count(distinct p_type) k from part group by 1) select 'allocation' rule, p_brand \"key\", s::varchar detail from m where s <> 2000")
def _(t):
    per = t("part").groupBy("p_brand", "p_type").agg(F.sum("p_size").alias("n"))
    maps = per.groupBy("p_brand").agg(F.map_from_entries(F.collect_list(F.struct("p_type", "n"))).alias("m")).withColumn("recorded", F.lit(2000))
    return q.allocation(maps, "p_brand", "m", "recorded")


@add("dq_route_coverage", "with k as (select upper(label) l, count(*) n from curation_rows where label is not null group by 1) select 'uncovered_label' rule, l \"key\", n::varchar detail from k where l not in (select upper(label) from defect_labels)")
def _(t):
    return q.covered(t("curation_rows"), "label", t("defect_labels"))


@add("dq_label_coverage", "with r as (select upper(label) u, count(*) n from curation_rows group by 1) select u label_upper, n, u in ('PASS', 'EXCESS_SOLDER', 'MISSING', 'BRIDGE') routed from r where u is not null")
def _(t):
    s = ds.route_summary(ds.route(t("curation_rows"), t("defect_labels").limit(0)))
    return s.where("label_upper is not null").select("label_upper", "n", (F.col("to_mining") | F.col("to_generator")).alias("routed"))


@add("dq_log_pass", "with s as (select user_id::varchar u, case event_type when 'error' then 'FAIL' else 'PASS' end s, event_id from events where event_type in ('error', 'view')), r as (select u, arg_max(s, event_id) l, count(*) filter (s = 'FAIL') f from s group by 1) select 'log_status' rule, u \"key\", l || '/' || f detail from r where l <> 'PASS' or f > 0")
def _(t):
    line = F.when(F.col("event_type") == "error", "Execution status: FAIL").when(F.col("event_type") == "view", "Execution status: PASS").otherwise("step")
    return q.log_passed(t("events").withColumn("line", line), "user_id", "line", "event_id")


@add("dq_log_spot", "select status, count(*) n from loop_log group by 1")
def _(t):
    return t("loop_log").groupBy("status").agg(F.count("*").alias("n"))


@add("dq_nn_spec", "with s as (select p_partkey, p_size % 7 topn, case p_size % 4 when 0 then 'cosine' when 1 then 'euclidean' when 2 then 'manhattan' else 'dot' end metric, case when p_size % 5 = 0 then 'maybe' else 'False' end f from part) select 'topn' rule, p_partkey::varchar \"key\", topn::varchar detail from s where topn < 1 union all select 'metric', p_partkey::varchar, metric from s where metric = 'dot' union all select 'filter_by_label', p_partkey::varchar, f from s where f = 'maybe'")
def _(t):
    size = F.col("p_size")
    s = t("part").select("p_partkey", (size % 7).alias("topn"), F.element_at(F.array(*map(F.lit, ("cosine", "euclidean", "manhattan", "dot"))), size % 4 + 1).alias("metric"), F.when(size % 5 == 0, "maybe").otherwise("False").alias("filter_by_label"))
    return q.neighbour_spec(s, "p_partkey")


@add("dq_timeseries", """with s as (select user_id u, ts, value v, epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts)) d from events), k as (select u, d, count(*) c from s where d is not null group by all),
m as (select u, arg_max(d, (c, -d)) usual from k group by 1) select 'too_short' rule, u::varchar "key", count(*)::varchar detail from s group by u having count(*) < 60
union all select 'uneven_steps', u::varchar, count(*)::varchar from s join m using (u) where d is not null and d <> usual group by u""")
def _(t):
    return q.time_series(t("events").withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", "value", 60)


@add("dq_series_filled", "select row_id, round(coalesce(psnr, 0), 6) psnr from curation_rows")
def _(t):
    return q.filled(t("curation_rows").select("row_id", "psnr"), ["psnr"]).withColumn("psnr", rounded("psnr"))


@add("dq_metric_contract", "with s as (select p_partkey, case when p_size % 3 = 0 then ' ' else p_name end n, case p_size % 5 when 0 then '==' else '<=' end o from part) select 'name' rule, p_partkey::varchar \"key\", n detail from s where n = ' ' union all select 'operator', p_partkey::varchar, o from s where o = '=='")
def _(t):
    size = F.col("p_size")
    return q.metric_contract(t("part").select("p_partkey", F.when(size % 3 == 0, " ").otherwise(F.col("p_name")).alias("name"), F.when(size % 5 == 0, "==").otherwise("<=").alias("operator"), F.col("p_retailprice").alias("value")), "p_partkey")


_METRIC = "with r as (select l_suppkey c, avg(l_extendedprice) p, avg(l_discount) d from lineitem group by 1), e as (select c, p, p <= 52000 met, d >= 0.0495 feasible from r)"


def evaluated(t):
    r = t("lineitem").groupBy(F.col("l_suppkey").alias("candidate")).agg(F.round(F.avg("l_extendedprice"), 6).alias("price"), F.round(F.avg("l_discount"), 9).alias("discount"))
    results = r.select("candidate", F.inline(F.array(F.struct(F.lit("price").alias("metric"), F.col("price").alias("value")), F.struct(F.lit("discount").alias("metric"), F.col("discount").alias("value")))))
    rule = "metric string, operator string, target double"
    return ev.evaluate_contract(results, t.spark.createDataFrame([("price", "<=", 52000.0)], rule), t.spark.createDataFrame([("discount", ">=", 0.0495)], rule))


@add("dq_metric_result", _METRIC + " select c candidate, round(p, 6) \"value\", met, feasible, met and feasible passed from e")
def _(t):
    return with_rounded(evaluated(t).select("candidate", "value", "met", "feasible", "passed"), "value")


@add("sel_best_iteration", _METRIC + " select c candidate, feasible from e order by feasible desc, round(p, 6), c limit 1")
def _(t):
    return ev.pick_best(evaluated(t)).select("candidate", "feasible")


@add("sel_best_trial", "select run_id, log_id from (select run_id, log_id, row_number() over (partition by run_id order by context_tokens desc nulls last, log_id) n from loop_log where run_id is not null) where n = 1")
def _(t):
    return ds.best_round(t("loop_log").where("run_id is not null"), "run_id", "context_tokens", ["log_id"]).select("run_id", "log_id")


_CLS = "with s as (select p_size % 6 truth, p_partkey % 6 predicted from part)"


def classified(t):
    return t("part").select((F.col("p_size") % 6).cast("long").alias("truth"), (F.col("p_partkey") % 6).cast("long").alias("predicted"))


@add("agg_accuracy", _CLS + " select count(*) n, round(avg((truth = predicted)::int), 6) accuracy from s")
def _(t):
    return with_rounded(ev.accuracy(classified(t)), "accuracy")


@add("agg_accuracy_per_class", _CLS + " select truth, count(*) n, round(avg((truth = predicted)::int), 6) accuracy from s group by 1")
def _(t):
    return with_rounded(ev.accuracy(classified(t), "truth"), "accuracy")


_IOU = _CLS + ", f as (select * from s where truth <> 5), c as (select k, (select count(*) from f where truth = k) n_truth, (select count(*) from f where predicted = k) n_predicted, (select count(*) from f where truth = k and predicted = k) n_both from (select distinct truth k from f union select distinct predicted from f))"


@add("agg_confusion_matrix_iou", _IOU + " select k \"class\", n_truth, n_predicted, n_both, round(n_both / (n_truth + n_predicted - n_both), 6) iou from c")
def _(t):
    return with_rounded(ev.iou(ev.confusion_matrix(classified(t)), 5), "iou")


@add("agg_iou_summary", _IOU + " select round(avg(n_both / (n_truth + n_predicted - n_both)) filter (n_truth > 0), 6) mean_iou, round(sum(n_both) / sum(n_truth), 6) pixel_accuracy, count(*) filter (n_truth > 0) classes from c")
def _(t):
    return with_rounded(ev.iou_summary(ev.iou(ev.confusion_matrix(classified(t)), 5)), "mean_iou", "pixel_accuracy")


@add("agg_chunk_loss", "select o_orderpriority, round(avg(o_totalprice), 6) loss from orders group by 1")
def _(t):
    return t("orders").groupBy("o_orderpriority").agg(rounded(F.avg("o_totalprice")).alias("loss"))


@add("agg_detection_map")
def _(t):
    """Each order is an image and each of its lines a true box; detections are the same boxes shifted by the discount."""
    e = t("lineitem")
    x, y = F.col("l_linenumber") * 100.0, F.col("l_quantity")
    truth = e.select(F.col("l_orderkey").alias("image"), F.col("l_returnflag").alias("class"), F.array(x, y, x + 10, y + 10).alias("box"))
    d = F.col("l_discount") * 50
    found = e.where("l_linestatus = 'O'").select(F.col("l_orderkey").alias("image"), F.col("l_returnflag").alias("class"), F.col("l_tax").cast("double").alias("score"), F.array(x + d, y, x + 10 + d, y + 10).alias("box"))
    return with_rounded(ev.average_precision(ev.matched_detections(found, truth), truth), "ap")


QUERIES, ORACLE = M.queries, M.oracle
