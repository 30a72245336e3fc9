"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
#: Folders of intermediate tables that may exist.
_STAGED: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir); where it is unset, a temporary one of our own in local mode, where
    there is one machine only, and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not found and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not found and app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="episodica-")
    return found or _OWN[app]


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table; it is deleted by clear(), or when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/episodica/{uuid.uuid4().hex}/{name}"
    if not _STAGED:
        atexit.register(clear, spark)
    _STAGED.append(path.rpartition("/")[0])
    return path


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables, once the results of earlier queries have been written: a long session calls it between queries."""
    while _STAGED:
        _delete(spark, _STAGED.pop())


def _delete(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:
        return
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._staged = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialize() returned, before the driver ends. Nothing may read them any more.

    The driver's garbage is collected then: only that lets Spark drop the shuffles behind them.
    """
    for table in tables:
        folder = table._staged.rpartition("/")[0]
        _delete(table.sparkSession, folder)
        if folder in _STAGED:
            _STAGED.remove(folder)
    if tables:
        gc.collect()
        tables[0].sparkSession.sparkContext._jvm.System.gc()


def materialize_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like materialize, but bucketed by key: a join on key that brings the other side into as many partitions doesn't move it."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    table = f"episodica_{name}_{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, key).format("parquet").saveAsTable(table)
    atexit.register(_drop, spark, table)
    return spark.table(table)


def _drop(spark: SparkSession, table: str) -> None:
    if spark.sparkContext._jsc is not None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
