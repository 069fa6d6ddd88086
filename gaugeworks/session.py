"""Session helpers: loading tables, and cutting lineage in the cluster's shared folder."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_shipped: set[str] = set()


def _file_system(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, through the shared folder, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    name = f"{shared_dir(spark)}/gaugeworks/{app}/gaugeworks.zip"
    path, fs = _file_system(spark, name)
    out = fs.create(path, True)
    out.write(bytearray(held.getvalue()))
    out.close()
    spark.sparkContext.addPyFile(name)
    _shipped.add(app)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one only where that is unset (tests)."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        where = tempfile.mkdtemp(prefix="gaugeworks-")
        spark.sparkContext.setCheckpointDir(where)
        where = spark.sparkContext.getCheckpointDir()
    return where.rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """The name of a new folder in the shared one."""
    return f"{shared_dir(spark)}/gaugeworks/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, survives the loss of any executor, and makes results of
    Python stages that are used twice come out the same both times."""
    spark = df.sparkSession
    ship(spark)
    path = shared_folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, name: str) -> None:
    """Delete a folder."""
    path, fs = _file_system(spark, name)
    fs.delete(path, True)


def release(df: DataFrame) -> None:
    """Delete the table behind a frame made by :func:`materialize` once nothing reads it any more."""
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/gaugeworks/" in name:
            delete(df.sparkSession, name)


def release_all(spark: SparkSession) -> None:
    """Delete every table written by :func:`materialize`; frames that read them are void afterwards."""
    path, fs = _file_system(spark, f"{shared_dir(spark)}/gaugeworks")
    if fs.exists(path):
        for x in fs.listStatus(path):
            if x.getPath().getName() != spark.sparkContext.applicationId:
                fs.delete(x.getPath(), True)
