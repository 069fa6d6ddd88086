"""Reading annotation, prediction and log files in the formats they come in."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.labels import file_stem
from gaugeworks.functions.paths import basename, strip_blank
from gaugeworks.operators.prefix import prefix_sums

# fixed values: file endings and where a document may keep its list of records, in order
FORMATS = {".parquet": "parquet", ".pq": "parquet", ".jsonl": "jsonl", ".ndjson": "jsonl", ".json": "json", ".csv": "csv"}
PREDICTION_KEYS = ("results", "samples", "predictions", "individual_results")
RECORD_KEYS = ("annotations", "data", "samples", "items")


def infer_format(path: str) -> str:
    """By the ending of the path, in any case."""
    for ending, kind in FORMATS.items():
        if path.lower().rstrip("/").endswith(ending):
            return kind
    raise ValueError(f"no known ending: {path}")


def read_annotations(spark: SparkSession, path: str, schema: str | None = None, kind: str | None = None) -> DataFrame:
    """A table in one of the four formats; CSV cells are text unless ``schema`` says otherwise."""
    kind = kind or infer_format(path)
    reader = spark.read.schema(schema) if schema else spark.read
    if kind == "parquet":
        return reader.parquet(path)
    if kind == "csv":
        return reader.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return reader.option("multiLine", kind == "json").json(path)


def required(df: DataFrame, *columns: str) -> DataFrame:
    """``df``, or an error that lists the columns there are."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"no column {missing}; there are {df.columns}")
    return df


def read_scored(spark: SparkSession, path: str, label: str = "label", score: str = "siamese_score") -> tuple[DataFrame, DataFrame]:
    """Scored rows and the offending ones (score blank or not a number), each with its ``file`` and ``line``: (good, bad).

    Lines count records from 2, below the header, in each file."""
    raw = required(read_annotations(spark, path, kind="csv"), label, score)
    placed = raw.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("_at"))
    ranked = prefix_sums(placed, ["_at"], {"_n": F.lit(1).cast("long")})
    first = ranked.groupBy("file").agg(F.min("_n").alias("_first"))
    rows = ranked.join(first, "file").withColumn("line", F.col("_n") - F.col("_first") + 2).drop("_at", "_n", "_first").withColumn("score", strip_blank(F.col(score)).try_cast("double"))
    return rows.where("score is not null"), rows.where("score is null")


def json_records(docs: DataFrame, body: str, keys: tuple[str, ...] = PREDICTION_KEYS, single: bool = False) -> DataFrame:
    """``record`` (variant) of each document: its list, the list under the first of ``keys`` that holds one, or with ``single`` the object itself."""
    v = F.try_parse_json(body)
    at = F.try_variant_get(v, "$", "array<variant>")
    for k in keys:
        at = F.coalesce(at, F.try_variant_get(v, f"$.{k}", "array<variant>"))
    if single:
        at = F.coalesce(at, F.when(v.isNotNull(), F.array(v)))
    return docs.select(*[c for c in docs.columns if c != body], F.posexplode(at).alias("record_no", "record"))


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """The objects of one JSON array; anything else, and an empty one, is an error."""
    text = spark.read.text(path, wholetext=True)
    if text.where(~F.startswith(F.ltrim("value"), F.lit("["))).count():
        raise ValueError(f"no JSON array: {path}")
    rows = json_records(text, "value", ())
    if rows.isEmpty():
        raise ValueError(f"no records: {path}")
    return rows


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """JSON lines, blank ones skipped. Strict: a line that doesn't parse ends the read; else it's in ``_corrupt_record``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(schema + ", _corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def log_errors(lines: DataFrame, text: str, keep: list[str], schema: str) -> DataFrame:
    """``keep``, ``event`` and ``error``: log lines parsed one by one, a bad one noted and passed over."""
    e = F.from_json(text, schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    blank = F.coalesce(strip_blank(F.col(text)), F.lit("")) == ""
    return lines.where(~blank).select(*keep, e.alias("event")).withColumn("error", F.when(F.col("event").isNull() | F.col("event._bad").isNotNull(), "bad_json"))


def one_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """A single column read from Parquet, null and blank values left out."""
    return spark.read.parquet(path).select(column).where(strip_blank(F.col(column)) != "")


def table_proof(df: DataFrame, columns: list[str]) -> dict:
    """Row count and missing columns, read from file footers where the format has them."""
    return {"rows": df.count(), "missing": sorted(set(columns) - set(df.columns))}


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, name, length`` of the files below a directory; their contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", basename(F.col("path")).alias("name"), "length")


def paired_files(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files of two listings with equal names, and those of the left without a partner."""
    r = right.select("name", F.col("path").alias("right_path"))
    return left.join(r, "name"), left.join(r, "name", "left_anti")


def file_digests(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, sha256`` of every file below a directory, to be held against frozen values; one file's content at a time is in memory."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def kitti(lines: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``type, x0, y0, x1, y1`` of label lines of eight or more fields."""
    f = F.split(strip_blank(F.col(text)), r"\s+")
    box = [F.try_element_at(f, F.lit(i + 5)).try_cast("double").alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return lines.where(F.size(f) >= 8).select(*keep, F.element_at(f, 1).alias("type"), *box)


def coco_boxes(docs: DataFrame, body: str) -> DataFrame:
    """``image_id, category, box`` of COCO documents, with corner boxes."""
    schema = "images array<struct<id:long,file_name:string>>, categories array<struct<id:long,name:string>>, annotations array<struct<image_id:long,category_id:long,bbox:array<double>>>"
    d = docs.select(F.from_json(body, schema).alias("d"))
    names = d.select(F.inline("d.categories")).select(F.col("id").alias("category_id"), F.col("name").alias("category")).distinct()
    boxes = d.select(F.inline("d.annotations"))
    corner = F.array(F.col("bbox")[0], F.col("bbox")[1], F.col("bbox")[0] + F.col("bbox")[2], F.col("bbox")[1] + F.col("bbox")[3])
    return boxes.join(names, "category_id", "left").select("image_id", "category", corner.alias("box"))


def grounding(docs: DataFrame, body: str) -> DataFrame:
    """``expression, instance, box, score`` of grounding records (``expressions[].instances[]``)."""
    schema = "expressions array<struct<text:string,instances:array<struct<bbox:array<double>,score:double>>>>"
    e = docs.select(*[c for c in docs.columns if c != body], F.explode(F.from_json(body, schema)["expressions"]).alias("e"))
    return e.select(*[c for c in docs.columns if c != body], F.col("e.text").alias("expression"), F.posexplode("e.instances").alias("instance", "i")).select("*", F.col("i.bbox").alias("box"), F.col("i.score").alias("score")).drop("i")


def video_chunks(docs: DataFrame, body: str) -> DataFrame:
    """``video, chunk_no, caption`` of a list of videos with nested ``chunks``."""
    schema = "array<struct<video:string,chunks:array<struct<caption:string>>>>"
    v = docs.select(F.explode(F.from_json(body, schema)).alias("v"))
    return v.select(F.col("v.video").alias("video"), F.posexplode("v.chunks").alias("chunk_no", "c")).select("video", "chunk_no", F.col("c.caption").alias("caption"))


def front_matter(files: DataFrame) -> DataFrame:
    """``path, key, value`` of the ``key: value`` lines between two ``---`` lines at the top of text files (``path, content``)."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, text in zip(b["path"], b["content"]):
                lines = (text or "").splitlines()
                if not lines or lines[0].strip() != "---":
                    continue
                for line in lines[1:]:
                    if line.strip() == "---":
                        break
                    key, sep, value = line.partition(":")
                    if sep and key.strip() and not key.startswith((" ", "#", "-")):
                        rows.append((path, key.strip(), value.strip().strip("'\"")))
            yield pd.DataFrame(rows, columns=["path", "key", "value"])

    return files.select("path", "content").mapInPandas(parse, "path string, key string, value string")


def catalog_union(manifest: DataFrame, directory: DataFrame) -> DataFrame:
    """Both catalogs' entries by ``name``: the manifest's description before the directory's, actions united."""
    m = manifest.select("name", F.col("description").alias("m_text"), F.col("actions").alias("m_actions"))
    d = directory.select("name", F.col("description").alias("d_text"), F.col("actions").alias("d_actions"))
    none = F.array().cast("array<string>")
    actions = F.array_sort(F.array_union(F.coalesce("m_actions", none), F.coalesce("d_actions", none)))
    return m.join(d, "name", "full_outer").select("name", F.coalesce("m_text", "d_text").alias("description"), actions.alias("actions"))


def copy_selected(spark: SparkSession, keys: DataFrame, root: str, to: str, skip_existing: bool = True) -> DataFrame:
    """Copy exactly the files named in ``keys`` (``key``) from one directory to another: ``key, outcome, detail``.

    Every worker copies its own; what fails is reported, not raised. Both are directories all workers reach; nothing outside ``root`` is read, or written outside ``to``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        import shutil

        base, out = os.path.realpath(root), os.path.realpath(to)
        for b in batches:
            rows = []
            for key in b["key"]:
                source, target = os.path.realpath(os.path.join(base, key)), os.path.realpath(os.path.join(out, key))
                if not source.startswith(base + os.sep) or not target.startswith(out + os.sep):
                    rows.append((key, "refused", "outside the root"))
                elif skip_existing and os.path.isfile(target) and os.path.getsize(target):
                    rows.append((key, "skipped", ""))
                else:
                    try:
                        os.makedirs(os.path.dirname(target), exist_ok=True)
                        shutil.copyfile(source, target + ".part")
                        os.replace(target + ".part", target)
                        rows.append((key, "copied", ""))
                    except OSError as e:
                        rows.append((key, "failed", str(e)))
            yield pd.DataFrame(rows, columns=["key", "outcome", "detail"])

    return keys.select("key").where("key is not null").distinct().mapInPandas(run, "key string, outcome string, detail string")


def stem_label(path: Column) -> Column:
    """The stem of a file's name."""
    return file_stem(path)
