"""Shared scratch tables.

Long lineages are cut by writing Parquet into the folder that the cluster names in
``spark.checkpoint.dir``; every executor can read it again, so a lost executor costs a task
and not the query. A folder set by ``SparkContext.setCheckpointDir`` serves as well. Without either, a
folder of our own is made in local mode only (tests); on a cluster that is an error, as a machine's own disk is not shared.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one narrow key column that may be broadcast (about 16 bytes each in memory).
BROADCAST_ROWS = 200_000


def scratch_dir(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidewatch-"))
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/tidewatch/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and return a scan of what was written."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidewatch_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table made by :func:`saved` that no later plan reads."""
    path = getattr(df, "_tidewatch_path", None)
    if path is None:
        return
    spark = df.sparkSession
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


#: A table below this size may sit in one row group, which one task would read alone.
SMALL_BYTES = 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores if it is small; larger tables are read in splits anyway."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size < SMALL_BYTES else df


def hinted(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A broadcast hint on a narrow key table, only when its counted rows are within the bound."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df
