"""Positions in a total order without one task for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidewatch.llm import store

_INDEX = (1 << 33) - 1


def numbered(df: DataFrame, group: str, order: list, name: str) -> tuple[DataFrame, DataFrame]:
    """(``df`` with ``pos``, the place from 0 of each row in its ``group``; (group, n) of each group).

    ``df`` must be a stored table without a column ``tie``; equal rows are dealt by the place where they are stored, so
    that many repeats don't meet in one task. Rows are range partitioned and sorted, which numbers them within a
    partition; only the counts per partition and group are put in order, which are as many as partitions and groups.
    """
    keys = [F.col(group).asc_nulls_first(), *order]
    tied = df.withColumn("tie", F.monotonically_increasing_id())
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = store.saved(
        tied.repartitionByRange(n, *keys, F.col("tie")).sortWithinPartitions(*keys, F.col("tie")).drop("tie")
        .withColumn("_at", F.monotonically_increasing_id()), name)
    part, index = F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND(F.lit(_INDEX))
    counts = runs.groupBy(part, group).agg(F.count("*").alias("_n"), F.min(index).alias("_from"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = store.saved(counts.withColumn("_shift", F.coalesce(before, F.lit(0)) - F.col("_from")), f"{name}-starts")
    totals = starts.groupBy(group).agg(F.sum("_n").alias("n"))
    shifts = store.hinted(starts.select("_part", F.col(group).alias("_group"), "_shift"))
    rows = runs.select("*", part)
    out = rows.join(shifts, (rows["_part"] == shifts["_part"]) & rows[group].eqNullSafe(shifts["_group"]))
    return out.select(*df.columns, (index + F.col("_shift")).alias("pos")), totals
