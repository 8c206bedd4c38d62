"""Session settings the operators rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A document with a repeated key is still a JSON document.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs a later operator one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Lists of ids of this length are looked for one by one in a file's statistics and Bloom filters.
    "spark.sql.parquet.pushdown.inFilterThreshold": "64",
    # Merge the sessions of a key before the shuffle, not only after it.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session; cluster sizing stays the caller's."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a session in one process may set a folder of its own where there is none; a cluster
    has to name one that every executor can reach.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if context.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/attemptlog/{name}-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, in any file system Spark knows."""
    files, where = _files(spark, path)
    return files.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder."""
    files, where = _files(spark, path)
    return [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job of ours has written and no one reads any more."""
    files, where = _files(spark, path)
    files.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder unless it is there."""
    files, where = _files(spark, path)
    files.mkdirs(where)


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder; what readers see of it appears at once."""
    files, where = _files(spark, path)
    if not files.rename(where, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{path} could not be renamed to {target}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Remove the folders of tables that ``materialize`` wrote and no one reads any more."""
    for df in tables:
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            remove(df.sparkSession, folder)
