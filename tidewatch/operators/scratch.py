"""Cutting lineage with reliable checkpoints in the folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir.

    Where that is unset, a folder of our own is made in local mode only (tests); on a cluster that is an
    error, as a machine's own disk is not shared.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidewatch-"))
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_folder(spark)}/tidewatch/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint."""
    _folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` as a scratch table: columns are packed, unlike a checkpoint's rows, and its size is that of its files.

    A checkpoint keeps the size that was estimated for its plan, which a self join squares: after twenty rounds that is a number of megabytes.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
