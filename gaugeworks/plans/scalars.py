"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.functions import chat, labels, numbers, paths
from gaugeworks.plans.base import Module, rounded
from gaugeworks.plans.pipeline import _BLANKLESS, _PATH

M = Module()
add = M.add


@add("fn_clean_label", f"select label, upper({_BLANKLESS.format(c='label')}) clean, upper({_BLANKLESS.format(c='label')}) <> 'PASS' defect, count(*) n from mining_embeddings group by all")
def _(t):
    return t("mining_embeddings").groupBy("label").agg(F.count("*").alias("n")).withColumns({"clean": labels.clean_label(F.col("label")), "defect": labels.is_defect(F.col("label"))})


@add("fn_normalize_label_pass", f"select label, case when label = 'PASS' then label else lower({_BLANKLESS.format(c='label')}) end training_label, count(*) n from split_records group by all")
def _(t):
    return t("split_records").groupBy("label").agg(F.count("*").alias("n")).withColumn("training_label", labels.training_label(F.col("label")))


_STEM = "regexp_replace(regexp_extract(translate(filepath, '\\', '/'), '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1')"
_NAMED = f"regexp_replace(regexp_extract({_STEM}, '^[^+]*\\+(.*)$', 1), '_[^_]*$', '')"


@add("fn_label_from_filename", f"select row_id, nullif({_NAMED}, '') name_label from curation_rows")
def _(t):
    return t("curation_rows").select("row_id", labels.label_in_name(F.col("filepath")).alias("name_label"))


@add("fn_defect_type", f"select coalesce(nullif({_NAMED}, ''), 'unknown') defect_type, count(*) n from curation_rows group by 1")
def _(t):
    return t("curation_rows").groupBy(labels.defect_type(F.col("filepath")).alias("defect_type")).agg(F.count("*").alias("n"))


@add("fn_anomaly_prefix", "select distinct regexp_replace(regexp_extract(translate(filepath, '\\', '/'), '([^/]*)$', 1), '_[0-9]+\\.(?:png|jpg)$', '') prefix from curation_rows where artifact_field = 'anomalygen_sdg_csv'")
def _(t):
    return t("curation_rows").where("artifact_field = 'anomalygen_sdg_csv'").select(labels.anomaly_prefix(F.col("filepath")).alias("prefix")).distinct()


@add("fn_first_nonblank_column", f"select record_id, coalesce(nullif({_BLANKLESS.format(c='object_name')}, ''), nullif({_BLANKLESS.format(c='boardname')}, ''), nullif({_BLANKLESS.format(c='source')}, '')) first_value from split_records")
def _(t):
    return t("split_records").select("record_id", labels.first_nonblank(F.col("object_name"), F.col("boardname"), F.col("source")).alias("first_value"))


@add("fn_path_key", f"select artifact_id, {_PATH.format(c='artifact_path')} path_key from artifacts")
def _(t):
    return t("artifacts").select("artifact_id", paths.path_key(F.col("artifact_path")).alias("path_key"))


_SL = "regexp_replace(translate(filepath, '\\', '/'), '/+$', '')"


# the folder in which a relative path lies behind what is put before it
_LAND = "case row_id % 4 when 0 then '/data/' when 1 then '/other/' when 2 then '/' else '/data/' end"
_FLAT = "regexp_replace(regexp_replace(regexp_replace({p}, '/{{2,}}', '/', 'g'), '(/\\.)+(/|$)', '\\2', 'g'), '(.)/+$', '\\1')"


@add("fn_path_resolve", f"select row_id, {_FLAT.format(p=f'case when starts_with({_SL}, chr(47)) then {_SL} else {_LAND} || {_SL} end')} resolved from curation_rows")
def _(t):
    """Relative paths are put behind segments that lead up and down again."""
    climb = F.element_at(F.array(*map(F.lit, ("x/y/../../", "../other/./", "../../../", ""))), (F.col("row_id") % 4 + 1).cast("int"))
    p = F.col("filepath")
    return t("curation_rows").select("row_id", paths.resolve(F.when(paths.slashes(p).startswith("/"), p).otherwise(F.concat(climb, p)), "/data").alias("resolved"))


_ABS = _FLAT.format(p=f"case when starts_with({_SL}, '/') then {_SL} else '/data/' || {_SL} end")


@add("fn_path_keys", f"select row_id, unnest(list_distinct([{_SL}, {_ABS}, regexp_extract({_SL}, '([^/]*)$', 1)])) lookup_key from curation_rows where filepath is not null")
def _(t):
    rows = t("curation_rows").where("filepath is not null")
    return rows.select("row_id", F.explode(paths.lookup_keys(F.col("filepath"), "/data")).alias("lookup_key"))


_ART = "regexp_replace(translate(artifact_path, '\\', '/'), '/+$', '')"


@add("fn_path_relative", f"select artifact_id, case when {_ART} = '/data/ws1' or starts_with({_ART}, '/data/ws1/') then regexp_replace(substr({_ART}, 10), '^/', '') end relative from artifacts")
def _(t):
    return t("artifacts").select("artifact_id", paths.relative(F.col("artifact_path"), "/data/ws1").alias("relative"))


@add("fn_path_under", f"select artifact_id, {_ART} = '/data/ws1' or starts_with({_ART}, '/data/ws1/') under from artifacts")
def _(t):
    return t("artifacts").select("artifact_id", paths.is_under(F.col("artifact_path"), "/data/ws1").alias("under"))


@add("fn_siamese_path", "select record_id, '/data/' || regexp_replace(translate(input_path, '\\', '/'), '/+$', '') || case when regexp_matches(lower(regexp_replace(translate(input_path, '\\', '/'), '/+$', '')), '\\.(?:jpe?g|png|bmp)$') then '' else '/' || object_name || '_SolderLight.jpg' end image from split_records")
def _(t):
    return t("split_records").select("record_id", paths.pair_image("/data", F.col("input_path"), F.col("object_name"), F.lit("SolderLight")).alias("image"))


@add("fn_expand_lighting", "select record_id, unnest(['SolderLight', 'LowAngle', 'White']) light from split_records")
def _(t):
    return t("split_records").select("record_id", F.explode(F.array(*map(F.lit, ("SolderLight", "LowAngle", "White")))).alias("light"))


@add("fn_parse_ts", "select event_id, epoch_us(ts) micros from events")
def _(t):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.when(F.col("event_id") % 2 == 0, "Z").otherwise("+00:00"))
    return t("events").select("event_id", F.unix_micros(numbers.parse_time(text)).alias("micros"))


@add("fn_format_float", "select event_id, printf('%.6f', value) six, printf('%.4f%%', value * 100) pct from events")
def _(t):
    return t("events").select("event_id", numbers.format_float(F.col("value")).alias("six"), numbers.format_pct(F.col("value")).alias("pct"))


@add("fn_duration", "select log_id, case when coalesce(duration_sec, 0) <= 0 then 'not recorded' when duration_sec >= 3600 then printf('%dh %dm', duration_sec // 3600, duration_sec % 3600 // 60) when duration_sec >= 60 then printf('%dm %ds', duration_sec // 60, duration_sec % 60) else printf('%ds', duration_sec) end took from (select log_id, (duration_sec * (1 + log_id % 5) - log_id % 3)::int duration_sec from loop_log)")
def _(t):
    """Durations up to hours, zero and less among them."""
    spread = F.col("duration_sec") * (1 + F.col("log_id") % 5) - F.col("log_id") % 3
    return t("loop_log").select("log_id", numbers.format_duration(spread).alias("took"))


@add("fn_safe_divide", "select p_partkey, round(p_retailprice / nullif(p_size % 5, 0), 6) r, round(2 * (p_size / 50) * 0.5 / nullif(p_size / 50 + 0.5, 0), 6) f1 from part")
def _(t):
    size = F.col("p_size")
    return t("part").select("p_partkey", rounded(numbers.ratio(F.col("p_retailprice"), size % 5)).alias("r"), rounded(numbers.f1(size / 50, F.lit(0.5))).alias("f1"))


@add("fn_nextafter", "select nextafter(min(value), -1e308) below from events")
def _(t):
    low = t("events").agg(F.min("value")).first()[0]
    return t.spark.range(1).select(F.lit(numbers.just_below(low)).alias("below"))


@add("fn_compare", "select l_orderkey, l_linenumber, case l_linenumber % 4 when 0 then l_quantity < 25 when 1 then l_quantity <= 25 when 2 then l_quantity > 25 else l_quantity >= 25 end holds from lineitem")
def _(t):
    op = F.element_at(F.array(*map(F.lit, ("lt", "<=", "GT", "ge"))), F.col("l_linenumber") % 4 + 1)
    return t("lineitem").select("l_orderkey", "l_linenumber", labels.compare(F.col("l_quantity"), op, F.lit(25.0)).alias("holds"))


@add("fn_parse_target", """select p_partkey, case when p_partkey % 4 = 0 then 'far_pct' when p_partkey % 4 = 3 then null else lower(replace(p_name, ' ', '_')) end "name",
    case when p_partkey % 4 = 0 then 'FAR' when p_partkey % 4 = 3 then null else p_name end display_name, case p_partkey % 4 when 0 then '<=' when 1 then '>=' when 2 then '<' end "operator",
    case p_partkey % 4 when 0 then p_size::double when 1 then p_size / 100 when 2 then -p_size::double end target, case p_partkey % 4 when 0 then '%' when 1 then '' when 2 then 'px' end unit,
    case p_partkey % 4 when 0 then 'far_at_recall' when 3 then null else 'unconfigured' end evaluator, case when p_partkey % 4 = 0 then case when p_partkey % 8 = 0 then 99.5 else 100 end end::double recall_target_pct,
    case when p_partkey % 4 = 2 then 'dusk' end evaluation_context from part""")
def _(t):
    """FAR at a named or the usual recall, numbers without a digit before or behind the point, a context, and texts that are no target."""
    n = F.col("p_size")
    far = F.concat(F.lit("FAR <= "), n.cast("string"), F.lit(". %"), F.when(F.col("p_partkey") % 8 == 0, " at Recall = 99.5 %").otherwise(""))
    share = F.concat("p_name", F.lit(">="), F.regexp_replace(F.format_string("%.2f", n / 100), "^0", ""))
    drift = F.concat(F.lit(" "), "p_name", F.lit(" < -"), n.cast("string"), F.lit("px AT dusk "))
    text = F.element_at(F.array(far, share, drift, F.concat("p_name", F.lit(" at least "), n.cast("string"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    return t("part").select("p_partkey", labels.parse_target(text).alias("x")).select("p_partkey", "x.*")


@add("fn_slug", "select p_partkey, case p_partkey % 4 when 0 then 'far_pct' when 1 then 'far' when 2 then 'primary_metric' else trim(regexp_replace(lower(p_brand || ' ' || p_type), '[^a-z0-9]+', '_', 'g'), '_') end slug from part")
def _(t):
    k = F.col("p_partkey") % 4
    name = F.when(k <= 1, " Far!").when(k == 2, "+ %").otherwise(F.concat_ws(" ", "p_brand", "p_type"))
    return t("part").select("p_partkey", labels.metric_key(name, F.when(k == 1, "").otherwise("%")).alias("slug"))


@add("fn_platform_slug", """select c_custkey, case c_custkey % 4 when 0 then replace(lower(c_mktsegment), ' ', '-') || '-gpu' when 1 then null when 2 then null else 'c-' || c_custkey end slug,
    case c_custkey % 4 when 0 then c_mktsegment || '-GPU' when 1 then 'job' when 2 then regexp_replace(c_name, '[^A-Za-z0-9._-]+', '-', 'g') || '-' || repeat('x', 40) else 'C-_-' || c_custkey end safe from customer""")
def _(t):
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, F.concat(F.lit(""), "c_mktsegment", F.lit(" GPU"))).when(k == 1, "..++--").when(k == 2, F.concat("c_name", F.lit(" "), F.lit("x" * 40), F.lit("-."))).otherwise(F.concat(F.lit("_C _ "), F.col("c_custkey").cast("string"), F.lit("-")))
    return t("customer").select("c_custkey", labels.platform_slug(name).alias("slug"), labels.safe_id(name).alias("safe"))


@add("fn_gpu_arch", "select p_partkey, a arch, coalesce(rtrim(a, 'af') in ('sm_10', 'sm_25'), null) supported from (select p_partkey, case when p_partkey % 5 = 4 then case when p_size >= 10 then 'sm_' || p_size || '0' else 'sm_' || p_size || '0' end || 'f' when p_size >= 10 then 'sm_' || p_size || case p_partkey % 5 when 1 then 'a' else '' end end a from part)")
def _(t):
    n = F.col("p_size").cast("string")
    form = F.element_at(F.array(F.concat(F.lit(" SM"), n), F.concat(F.lit("sm-"), n, F.lit("A")), F.concat(F.lit("compute_"), n), n, F.concat(n, F.lit(".0f"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    return t("part").select("p_partkey", labels.gpu_arch(form).alias("arch"), labels.gpu_supported(form, ["SM10a", "2.5"]).alias("supported"))


@add("fn_cosine", "select a.vec_id, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) cosine, round(sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: (x[1]::double - x[2]::double) ** 2))), 6) euclidean, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: abs(x[1]::double - x[2]::double))), 6) manhattan from embeddings a join embeddings b on b.vec_id = 0")
def _(t):
    one = t("embeddings").where("vec_id = 0").select(F.col("embedding").alias("b"))
    e = t("embeddings").crossJoin(F.broadcast(one))
    a, b = F.col("embedding"), F.col("b")
    return e.select("vec_id", rounded(numbers.cosine(a, b)).alias("cosine"), rounded(numbers.euclidean(a, b)).alias("euclidean"), rounded(numbers.manhattan(a, b)).alias("manhattan"))


@add("fn_vector_validate", "select vec_id, coalesce(embedding is not null and len(embedding) > 0 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), false) usable from mining_embeddings")
def _(t):
    return t("mining_embeddings").select("vec_id", F.coalesce(numbers.vector_ok(F.col("embedding")), F.lit(False)).alias("usable"))


_TURNS = "event_id, '  event ' || event_type || ' ' prompt_text, case when event_id % 3 = 0 then 'ng ' when event_id % 3 = 1 then 'OK' else 'maybe' end said"


def turns(t):
    e = t("events").select("event_id", F.concat(F.lit("  event "), "event_type", F.lit(" ")).alias("p"), F.when(F.col("event_id") % 3 == 0, "ng ").when(F.col("event_id") % 3 == 1, "OK").otherwise("maybe").alias("said"))
    null = F.lit(None).cast("string")
    turn = lambda a, b, c, d: F.struct(a.alias("from"), b.alias("value"), c.alias("role"), d.alias("content"))
    return e.select("event_id", F.array(turn(F.lit("system"), F.lit("x"), null, null), turn(F.lit("human"), F.col("p"), null, null), turn(null, null, F.lit("assistant"), F.lit("first")), turn(null, null, F.lit("user"), F.lit("again")), turn(F.lit("gpt"), F.col("said"), null, null)).alias("turns"))


@add("fn_prompt_and_label", f"with e as (select {_TURNS} from events) select event_id, trim(prompt_text) prompt, case when upper(trim(said)) in ('OK', 'NG') then upper(trim(said)) end answer from e")
def _(t):
    return turns(t).select("event_id", chat.prompt(F.col("turns")).alias("prompt"), chat.answer(F.col("turns")).alias("answer"))


@add("fn_turn_role", f"with e as (select {_TURNS} from events) select event_id, unnest(['system', 'human', 'assistant', 'user', 'gpt']) \"role\", unnest(['x', prompt_text, 'first', 'again', said]) \"value\" from e")
def _(t):
    return turns(t).select("event_id", F.explode("turns").alias("x")).select("event_id", chat.role(F.col("x")).alias("role"), chat.value(F.col("x")).alias("value"))


@add("fn_strip_media_tag", "select doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') said from documents")
def _(t):
    return t("documents").select("doc_id", chat.without_media(F.concat(F.lit("<video>\n"), "text")).alias("said"))


@add("fn_bbox_xywh_xyxy", "select l_orderkey, l_linenumber, l_quantity x0, l_tax y0, round(l_quantity + l_discount, 6) x1, round(l_tax + l_linenumber, 6) y1 from lineitem")
def _(t):
    box = numbers.corners(F.array("l_quantity", "l_tax", "l_discount", F.col("l_linenumber").cast("double")))
    return t("lineitem").select("l_orderkey", "l_linenumber", box.alias("b")).select("l_orderkey", "l_linenumber", F.col("b")[0].alias("x0"), F.col("b")[1].alias("y0"), rounded(F.col("b")[2]).alias("x1"), rounded(F.col("b")[3]).alias("y1"))


@add("fn_score_tier", "select l_orderkey, l_linenumber, case when l_discount < 0.03 then 'none' when l_discount < 0.10 then 'weak' when l_discount < 0.20 then 'moderate' else 'strong' end tier from lineitem")
def _(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", numbers.score_tier(F.col("l_discount")).alias("tier"))


@add("fn_entropy", "select p_partkey, round(case when p_size in (0, 50) then 0 else -(p_size / 50) * ln(p_size / 50) - (1 - p_size / 50) * ln(nullif(1 - p_size / 50, 0)) end, 6) entropy from part where p_size <= 50")
def _(t):
    return t("part").where("p_size <= 50").select("p_partkey", rounded(numbers.binary_entropy(F.col("p_size") / 50)).alias("entropy"))


@add("fn_effective_lr", "select p_brand, round(avg(p_retailprice) * 8 * 4 / 256, 6) lr, round((count(*) filter (p_size > 10)) / nullif(count(*) filter (p_size <= 10), 0), 6) fail_weight from part group by 1")
def _(t):
    g = t("part").groupBy("p_brand").agg(F.avg("p_retailprice").alias("base"), F.count_if(F.col("p_size") > 10).alias("ok"), F.count_if(F.col("p_size") <= 10).alias("ng"))
    return g.select("p_brand", rounded(numbers.effective_lr(F.col("base"), F.lit(8), F.lit(4), 256)).alias("lr"), rounded(numbers.fail_weight(F.col("ok"), F.col("ng"))).alias("fail_weight"))


@add("fn_nested_get", "select event_id, json_extract(props, '$.k')::bigint k from events")
def _(t):
    return t("events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "long").alias("k"))


@add("fn_nested_pop", "select event_id, '{\"a\":1}' left_over from events")
def _(t):
    entries = F.from_json(F.concat(F.lit('{"a":1,'), F.substring("props", 2, 1 << 30)), "map<string,long>")
    return t("events").select("event_id", F.to_json(F.map_filter(entries, lambda k, v: k != "k")).alias("left_over"))


@add("fn_redact", "select c_custkey, 'api_key=***; Bearer *** for ' || c_name line from customer")
def _(t):
    secret = F.concat(F.lit("api_key="), F.sha2("c_name", 256), F.lit("; Bearer "), F.md5("c_name"), F.lit(" for "), "c_name")
    return t("customer").select("c_custkey", labels.redact(secret).alias("line"))


@add("fn_normalize_text_match", "select p_partkey, lower(p_name) = lower(p_type) exact, contains(lower(p_name), 'ring') or contains('ring', lower(p_name)) loose from part")
def _(t):
    exact, _ = labels.answers_match(F.col("p_name"), F.col("p_type"))
    _, loose = labels.answers_match(F.col("p_name"), F.lit(" RING "))
    return t("part").select("p_partkey", exact.alias("exact"), loose.alias("loose"))


@add("fn_normalize_depth_path", "select distinct s_suppkey, map_from_entries([('front', struct_pack(h5 := 'scene/' || s_nationkey || '.h5', k := s_name))])['front'].h5 h5 from supplier")
def _(t):
    cams = F.create_map(F.lit("front"), F.struct(F.concat(F.lit("/old/scene/"), F.col("s_nationkey").cast("string"), F.lit(".h5")).alias("h5"), F.col("s_name").alias("k")))
    moved = F.transform_values(cams, lambda k, v: F.struct(paths.relative(v["h5"], "/old").alias("h5"), v["k"].alias("k")))
    return t("supplier").select("s_suppkey", moved["front"]["h5"].alias("h5"))


@add("filter_isin_ci", "select row_id from curation_rows where upper(label) in ('PASS', 'BRIDGE')")
def _(t):
    return t("curation_rows").where(F.upper("label").isin("PASS", "BRIDGE")).select("row_id")


@add("filter_guardrail", "select row_id from curation_rows where coalesce(case when psnr is null then null when psnr >= 30 then 1 else 0 end, 1) = 1")
def _(t):
    flag = F.when(F.col("psnr").isNotNull(), (F.col("psnr") >= 30).cast("int"))
    return t("curation_rows").where(F.coalesce(flag, F.lit(1)) == 1).select("row_id")


@add("filter_bool_field", "select vec_id from mining_embeddings where state_field = 'mining_target_embeddings' and label is not null")
def _(t):
    keep = t("mining_embeddings").withColumn("flag", (F.col("state_field") == "mining_target_embeddings") & F.col("label").isNotNull())
    return keep.where("flag").select("vec_id")


@add("filter_video_length", "select log_id from loop_log where duration_sec <= 300")
def _(t):
    return t("loop_log").where("duration_sec <= 300").select("log_id")


@add("filter_numeric_columns", "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax from lineitem")
def _(t):
    e = t("lineitem")
    return e.select(*(f.name for f in e.schema.fields if f.dataType.typeName() in ("long", "integer", "double", "float", "short", "byte", "decimal")))


@add("fn_sha256_id", "select c_custkey, left(sha256(c_name), 16) sample_id from customer")
def _(t):
    return t("customer").select("c_custkey", numbers.short_hash(F.col("c_name")).alias("sample_id"))


@add("fn_file_dir_collapse", f"select row_id, regexp_replace({_SL}, '/?[^/]*$', '') folder, case when ends_with({_SL}, '_SolderLight.jpg') then regexp_replace(regexp_extract({_SL}, '([^/]*)$', 1), '_SolderLight\\.jpg$', '') end object_name from curation_rows")
def _(t):
    folder, name = paths.collapse(F.col("filepath"))
    return t("curation_rows").select("row_id", folder.alias("folder"), name.alias("object_name"))


@add("fn_prefix_once", "select vec_id, case when starts_with(filepath, 'kpi/images/') then filepath else 'kpi/images/' || filepath end path from mining_embeddings")
def _(t):
    return t("mining_embeddings").select("vec_id", paths.prefixed_once(paths.prefixed_once(F.col("filepath"), "kpi/images/"), "kpi/images/").alias("path"))


QUERIES, ORACLE = M.queries, M.oracle
