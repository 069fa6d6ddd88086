"""Sources and sinks: tables are written in each format to the shared folder and read back through the readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.plans.base import Module, rounded
from gaugeworks.sources import readers, sinks

M = Module()
add = M.add

_C = "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer"
_CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


_LENIENT = r"""select line_id from raw_lines where line_kind = 'loop_log' and regexp_matches(raw_line, '^\s*\{') and json_extract_string(case when json_valid(raw_line) then raw_line end, '$.status') = 'error'
and not regexp_matches(regexp_replace(raw_line, '"(?:[^"\\]|\\.)*"', '""', 'g'), ',\s*[}\]]')"""


def written(t, table, kind):
    """The table as files of a kind; returns the path."""
    path = t.scratch(f"{table}.{ {'json_array': 'json'}.get(kind, kind)}")
    df = t(table)
    if kind == "csv":
        sinks.write_csv(df, path)
    elif kind == "jsonl":
        sinks.write_jsonl(df, path)
    elif kind == "json_array":
        sinks.json_array(df, [df.columns[0]]).coalesce(1).write.text(path)
    else:
        sinks.write_parquet(df, path)
    return path


@add("scan_csv_scored", "select event_id::varchar event_id, round(value, 6) score from events")
def _(t):
    path = t.scratch("scores.csv")
    sinks.write_csv(t("events").select("event_id", F.col("event_type").alias("label"), F.col("value").alias("siamese_score")), path)
    return readers.read_scored(t.spark, path)[0].select("event_id", rounded("score").alias("score"))


@add("scan_csv_bad_rows", "select event_id::varchar event_id from events where event_id % 7 = 0")
def _(t):
    path = t.scratch("scores.csv")
    score = F.when(F.col("event_id") % 14 == 0, "").when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("string"))
    sinks.write_csv(t("events").select("event_id", F.col("event_type").alias("label"), score.alias("siamese_score")), path)
    return readers.read_scored(t.spark, path)[1].select("event_id")


@add("scan_annotations", f"select kind, count(*) n, sum(c_custkey)::bigint keys from ({_C}), (select unnest(['csv', 'jsonl', 'parquet']) kind) group by 1")
def _(t):
    out = None
    for kind in ("csv", "jsonl", "parquet"):
        one = readers.read_annotations(t.spark, written(t, "customer", kind), _CUSTOMER).agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))
        out = one if out is None else out.unionByName(one)
    return out


@add("scan_frame", _C)
def _(t):
    return readers.read_annotations(t.spark, written(t, "customer", "json_array"), _CUSTOMER)


@add("scan_json_array", "select n_nationkey, n_name from nation")
def _(t):
    rows = readers.read_json_array(t.spark, written(t, "nation", "json_array"))
    return rows.select(F.variant_get("record", "$.n_nationkey", "int").alias("n_nationkey"), F.variant_get("record", "$.n_name", "string").alias("n_name"))


@add("scan_json_envelope", "select event_id, json_extract(props, '$.k')::bigint k from events")
def _(t):
    form = F.element_at(F.array(F.concat(F.lit("["), "props", F.lit("]")), F.concat(F.lit('{"results": 3, "samples": ['), "props", F.lit("]}")), F.concat(F.lit('{"predictions": ['), "props", F.lit('], "other": []}'))), (F.col("event_id") % 3 + 1).cast("int"))
    rows = readers.json_records(t("events").select("event_id", form.alias("body")), "body")
    return rows.select("event_id", F.variant_get("record", "$.k", "long").alias("k"))


@add("scan_json_records_any", "select count(*) n, count(distinct event_id) documents from events")
def _(t):
    form = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"items": ['), "props", F.lit("]}"))).otherwise(F.col("props"))
    rows = readers.json_records(t("events").select("event_id", form.alias("body")), "body", readers.RECORD_KEYS, single=True)
    return rows.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("documents"))


@add("scan_jsonl_strict", _C)
def _(t):
    return readers.read_jsonl(t.spark, written(t, "customer", "jsonl"), _CUSTOMER)


@add("scan_jsonl_lenient", _LENIENT)
def _(t):
    good = readers.log_errors(t("raw_lines").where("line_kind = 'loop_log'"), "raw_line", ["line_id", "raw_line"], "status string")
    strict = F.try_variant_get(F.try_parse_json("raw_line"), "$.status", "string")
    return good.where((strict == "error") & F.col("raw_line").rlike(r"^\s*\{")).select("line_id")


@add("scan_log_collect_errors")
def _(t):
    lines = readers.log_errors(t("raw_lines").where("line_kind = 'loop_log'"), "raw_line", ["line_id"], "seq int, status string")
    return lines.select("line_id", F.col("event.seq").alias("seq"), "error")


@add("scan_parquet_rows", "select l_orderkey, l_linenumber, l_quantity from lineitem")
def _(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


@add("scan_parquet_projected", "select filepath from curation_rows where regexp_replace(filepath, '^\\s+|\\s+$', '', 'g') <> ''")
def _(t):
    return readers.one_column(t.spark, f"{t.sf_dir}/curation_rows.parquet", "filepath")


@add("scan_parquet_meta", "select count(*) \"rows\", 'psnr_missing' missing from curation_rows")
def _(t):
    proof = readers.table_proof(t("curation_rows"), ["row_id", "psnr_missing"])
    return t.spark.createDataFrame([(proof["rows"], ",".join(proof["missing"]))], "rows long, missing string")


@add("scan_csv_count", "select count(*) n from orders")
def _(t):
    return readers.read_annotations(t.spark, written(t, "orders", "csv"), kind="csv").agg(F.count("*").alias("n"))


@add("join_dir_pairs_inner", "select 'part' side, 1 n where false union all select 'paired', 4 union all select 'unpaired', 1")
def _(t):
    a, b = t.scratch("a"), t.scratch("b")
    for i, name in enumerate(("region", "nation", "customer", "supplier", "part")):
        for where in [a, b] if i < 4 else [a]:
            sinks.write_csv(t(name).limit(3).coalesce(1), f"{where}/{name}.csv")
    top = F.regexp_extract("path", r"([^/]+\.csv)/", 1).alias("name")
    left, right = (readers.list_files(t.spark, x, "part-*").select("path", top) for x in (a, b))
    both, alone = readers.paired_files(left, right)
    return both.agg(F.lit("paired").alias("side"), F.count("*").cast("int").alias("n")).unionByName(alone.agg(F.lit("unpaired").alias("side"), F.count("*").cast("int").alias("n")))


@add("scan_dir_recursive", "select count(*)::int n from (select unnest(['region', 'nation', 'supplier']))")
def _(t):
    root = t.scratch("tree")
    for i, name in enumerate(("region", "nation", "supplier")):
        sinks.write_csv(t(name).coalesce(1), f"{root}/level{i}/{name}")
    return readers.list_files(t.spark, root, "part-*.csv").agg(F.count("*").cast("int").alias("n"))


@add("scan_catalog", "select s_name \"name\", s_suppkey::varchar \"value\" from supplier")
def _(t):
    docs = t("supplier").select(F.col("s_name").alias("path"), F.concat(F.lit("---\nname: "), "s_name", F.lit("\nid: '"), F.col("s_suppkey").cast("string"), F.lit("'\n---\nid: no\n")).alias("content"))
    return readers.front_matter(docs).where("key = 'id'").select(F.col("path").alias("name"), "value")


@add("join_catalog_union", "with a as (select s_name n, 'm' d from supplier where s_suppkey % 2 = 0), b as (select s_name n, 'd' d from supplier where s_suppkey % 3 = 0) select n \"name\", coalesce(a.d, b.d) description, case when a.d is not null and b.d is not null then 'evaluate,train' when a.d is not null then 'train' else 'evaluate,train' end actions from a full join b using (n)")
def _(t):
    s = t("supplier").withColumn("name", F.col("s_name"))
    a = s.where("s_suppkey % 2 = 0").select("name", F.lit("m").alias("description"), F.array(F.lit("train")).alias("actions"))
    b = s.where("s_suppkey % 3 = 0").select("name", F.lit("d").alias("description"), F.array(F.lit("train"), F.lit("evaluate")).alias("actions"))
    return readers.catalog_union(a, b).withColumn("actions", F.array_join("actions", ","))


@add("scan_s3_selective", "select 'copied' outcome, 5 n union all select 'failed', 1 union all select 'refused', 1 union all select 'skipped', 5")
def _(t):
    root, to = t.scratch("from").removeprefix("file:"), t.scratch("to").removeprefix("file:")
    names = [f"{x}.txt" for x in ("region", "nation", "customer", "supplier", "part")]
    for n in names:
        t.spark.createDataFrame([(n,)], "value string").coalesce(1).write.text(f"{root}/{n}")
    files = readers.list_files(t.spark, root, "part-*").select(F.regexp_extract("path", r"/from/(.*)$", 1).alias("key"))
    keys = files.unionByName(t.spark.createDataFrame([("absent.txt",), ("../../outside.txt",)], "key string"))
    first = readers.copy_selected(t.spark, keys, root, to).groupBy("outcome").agg(F.count("*").cast("int").alias("n")).collect()
    again = readers.copy_selected(t.spark, files, root, to).groupBy("outcome").agg(F.count("*").cast("int").alias("n")).collect()
    return t.spark.createDataFrame([tuple(r) for r in first + again], "outcome string, n int")


@add("scan_kitti", "select l_orderkey, l_linenumber, l_returnflag \"type\", l_quantity x0, l_tax y0 from lineitem where l_linenumber <> 1")
def _(t):
    q = lambda c: F.col(c).cast("string")
    line = F.concat_ws(" ", "l_returnflag", F.lit("0 0 0"), q("l_quantity"), q("l_tax"), F.lit("9 9 1"))
    rows = t("lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") == 1, "short line").otherwise(line).alias("t"))
    return readers.kitti(rows, "t", ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "type", "x0", "y0")


@add("scan_video_clip", "select n_name video, c.i chunk_no, n_name || '-' || c.i caption from nation, (select unnest([0, 1]) i) c")
def _(t):
    chunk = lambda i: F.struct(F.concat("n_name", F.lit(f"-{i}")).alias("caption"))
    return readers.video_chunks(t("nation").select(F.to_json(F.array(F.struct(F.col("n_name").alias("video"), F.array(chunk(0), chunk(1)).alias("chunks")))).alias("b")), "b")


@add("scan_coco", "select l_orderkey image_id, l_returnflag category, round(l_quantity + 2, 6) x1 from lineitem")
def _(t):
    ids = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    cats = F.array(*(F.struct(F.lit(i).alias("id"), F.lit(n).alias("name")) for i, n in ((1, "A"), (2, "N"), (3, "R"))))
    box = F.struct(F.col("l_orderkey").alias("image_id"), ids.alias("category_id"), F.array("l_quantity", F.lit(0.0), F.lit(2.0), F.lit(3.0)).alias("bbox"))
    docs = t("lineitem").select(F.to_json(F.struct(cats.alias("categories"), F.array(box).alias("annotations"))).alias("b"))
    return readers.coco_boxes(docs, "b").select("image_id", "category", F.round(F.col("box")[2], 6).alias("x1"))


@add("scan_grounding", "select n_nationkey, n_name expression, 0.5::double score from nation")
def _(t):
    inst = F.struct(F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("bbox"), F.lit(0.5).alias("score"))
    docs = t("nation").select("n_nationkey", F.to_json(F.struct(F.array(F.struct(F.col("n_name").alias("text"), F.array(inst).alias("instances"))).alias("expressions"))).alias("b"))
    return readers.grounding(docs, "b").select("n_nationkey", "expression", "score")


@add("sink_csv_metrics", _C)
def _(t):
    return t.spark.read.schema(_CUSTOMER).option("header", True).csv(written(t, "customer", "csv"))


@add("sink_csv_ordered", "select 'c_name,c_custkey,c_nationkey,c_acctbal,c_mktsegment' header")
def _(t):
    path = t.scratch("ordered.csv")
    sinks.write_csv(t("customer").coalesce(1), path, ["c_name"])
    return t.spark.read.text(path).where("value like 'c_name%'").select(F.col("value").alias("header")).distinct()


@add("sink_csv_json_cell", "select vec_id::varchar vec_id, len(embedding) n from embeddings")
def _(t):
    path = t.scratch("cells.csv")
    sinks.write_csv(t("embeddings"), path)
    back = readers.read_annotations(t.spark, path, kind="csv")
    return back.select("vec_id", F.size(F.from_json("embedding", "array<float>")).cast("long").alias("n"))


@add("sink_parquet_atomic", _C)
def _(t):
    return t.spark.read.parquet(written(t, "customer", "parquet"))


@add("sink_jsonl_stable", "select count(*) n from customer")
def _(t):
    lines = t.spark.read.text(written(t, "customer", "jsonl"))
    return lines.where(F.col("value").rlike(r'^\{"c_acctbal":.*"c_custkey":.*"c_mktsegment":.*"c_name":.*"c_nationkey":')).agg(F.count("*").alias("n"))


@add("sink_json_array", "select n_nationkey, n_name from nation")
def _(t):
    return t.spark.read.option("multiLine", True).schema("n_nationkey int, n_name string").json(written(t, "nation", "json_array"))


@add("sink_append_log", "select row_number() over (order by e.part, n_nationkey) seq, n_name from nation, (select unnest([0, 1]) part) e")
def _(t):
    path, schema = t.scratch("log"), "seq long, n_name string"
    for _ in range(2):
        sinks.append_log(t.spark, path, t("nation").select(F.col("n_nationkey").alias("ord"), "n_name"), schema)
    return t.spark.read.schema(schema).parquet(path)


@add("sink_partitioned_outcome", "select case when c_acctbal > 0 then 'generated' else 'failed' end outcome, count(*) n from customer group by 1")
def _(t):
    path = t.scratch("outcomes")
    sinks.write_outcomes(t("customer"), F.col("c_acctbal") > 0, path)
    return t.spark.read.parquet(path).groupBy("outcome").agg(F.count("*").alias("n"))


@add("sink_empty_same_schema", "select 'c_acctbal,c_custkey,c_mktsegment,c_name,c_nationkey' columns, 0 n")
def _(t):
    path = t.scratch("empty")
    sinks.write_parquet(t("customer").where(F.lit(False)), path)
    back = t.spark.read.parquet(path)
    return back.agg(F.lit(",".join(sorted(back.columns))).alias("columns"), F.count("*").cast("int").alias("n"))


@add("scan_dir_pairs", "select 4 paired")
def _(t):
    return M.queries["join_dir_pairs_inner"](t.spark, t.sf_dir).where("side = 'paired'").select(F.col("n").alias("paired"))


@add("sink_atomic_record", "select 2 \"rows\", true first, false again")
def _(t):
    path = t.scratch("job.json")
    done = [sinks.write_record(t.spark, path, {"state": s}, create) for s, create in (("new", True), ("other", True), ("running", False))]
    state = t.spark.read.schema("state string").json(path).first()["state"]
    return t.spark.createDataFrame([(sum(done) if state == "running" else 0, done[0], done[1])], "rows int, first boolean, again boolean")


@add("fn_file_sha256", "select r_regionkey, sha256(r_name || chr(10)) digest from region")
def _(t):
    root = t.scratch("frozen")
    for r in t("region").select("r_regionkey", "r_name").collect():  # five rows, whatever the scale
        t.spark.createDataFrame([(r["r_name"],)], "value string").coalesce(1).write.text(f"{root}/{r['r_regionkey']}")
    files = readers.file_digests(t.spark, root, "part-*.txt")
    return files.select(F.regexp_extract("path", r"/frozen/(\d+)/", 1).cast("int").alias("r_regionkey"), F.col("sha256").alias("digest"))


QUERIES, ORACLE = M.queries, M.oracle
