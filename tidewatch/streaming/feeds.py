"""Late data, replays, tumbling counts, anchored episodes and upserts on streams.

State is bounded by the watermark: nothing is kept for a key whose window can't change any more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewatch.operators import merge


def once_per_key(stream: DataFrame, keys: list[str], at: str, late: str = "3 days") -> DataFrame:
    """Rows by natural key once, however often a poll repeats them within ``late``."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def tumbling(stream: DataFrame, keys: list[str], at: str, size: str = "7 days", late: str = "3 days") -> DataFrame:
    """(keys, window_start, n): closed windows only (append mode); a window closes ``late`` after its end."""
    counts = stream.withWatermark(at, late).groupBy(F.window(at, size), *keys).agg(F.count("*").alias("n"))
    return counts.select(*keys, F.col("window.start").alias("window_start"), "n")


def episodes(stream: DataFrame, key: str, at: str, days: int = 90, late: str = "3 days") -> DataFrame:
    """(key, first_at, last_at, n) of episodes anchored at their first row, emitted when they can't grow.

    A session window won't do: an episode ends a fixed time after its first row, not after a gap.
    Rows of one batch are sorted by time; a row before the open episode's start but within the
    watermark counts to it.
    """
    span = pd.Timedelta(days=days)
    key_type = dict(stream.dtypes)[key]

    def fold(k, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last, n = state.get if state.exists else (None, None, 0)
        out = []
        times = sorted(t for b in batches for t in b[at].dropna())
        for t in times:
            if first is not None and t <= first + span:
                last, n = max(last, t), n + 1
            else:
                if first is not None:
                    out.append((k[0], first, last, n))
                first, last, n = t, t, 1
        if first is not None:
            end = int((first + span).timestamp() * 1000) + 1
            if state.hasTimedOut or state.getCurrentWatermarkMs() >= end:
                out.append((k[0], first, last, n))
                state.remove()
            else:
                state.update((first, last, n))
                state.setTimeoutTimestamp(end)
        yield pd.DataFrame(out, columns=[key, "first_at", "last_at", "n"])

    return (
        stream.withWatermark(at, late).groupBy(key).applyInPandasWithState(
            fold, f"{key} {key_type}, first_at timestamp, last_at timestamp, n long", "first_at timestamp, last_at timestamp, n long",
            "append", GroupStateTimeout.EventTimeTimeout)
    )


BUCKETS = 64


def _versions(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """Per bucket the numbers of the committed batches that wrote it, from the folders' names."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[int, list[int]] = {}
    if fs.exists(root):
        for state in fs.listStatus(root):
            name = state.getPath().getName()
            if name.startswith("state-") and fs.exists(jvm.org.apache.hadoop.fs.Path(state.getPath(), "_SUCCESS")):
                for part in fs.listStatus(state.getPath()):
                    kind, _, value = part.getPath().getName().partition("=")
                    if kind == "_bucket":
                        out.setdefault(int(value), []).append(int(name.split("-")[1]))
    return out


def _read(spark: SparkSession, path: str, chosen: dict[int, int]) -> DataFrame:
    return spark.read.parquet(*[f"{path}/state-{n}/_bucket={b}" for b, n in sorted(chosen.items())])


def current_state(spark: SparkSession, path: str) -> DataFrame:
    """The table that :func:`upsert_sink` keeps under ``path``: each bucket's newest committed version."""
    return _read(spark, path, {b: max(ns) for b, ns in _versions(spark, path).items()})


def upsert_sink(path: str, keys: list[str], hash_col: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that keeps a table of the newest state under ``path`` (read it with :func:`current_state`).

    Keys are dealt into buckets by hash; a batch rewrites the buckets that it touches, in a folder of its own. A replayed
    batch starts from the versions before it and writes the same folder again, so the table never doubles a batch.
    Of each touched bucket the version before stays for such a replay, older ones are deleted.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        new = merge.last_per_key(batch, keys, [F.col(hash_col).desc()])
        touched = {r[0] for r in batch.select(bucket).distinct().collect()}
        if not touched:
            return
        stamp = F.lit(str(number))
        before = {b: max(n for n in ns if n < number) for b, ns in _versions(spark, path).items() if b in touched and min(ns) < number}
        if before:
            state = merge.upsert(_read(spark, path, before), new, keys, hash_col, stamp)
        else:
            state = new.withColumn("last_changed_at", stamp).withColumn("withdrawn_at", F.lit(None).cast("string"))
        state.withColumn("_bucket", bucket).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/state-{number}")
        jvm = spark._jvm
        for b, ns in _versions(spark, path).items():
            for n in sorted(n for n in ns if b in touched and n < before.get(b, 0)):
                old = jvm.org.apache.hadoop.fs.Path(f"{path}/state-{n}/_bucket={b}")
                old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    return write


def window_is_complete(page: DataFrame, previous: DataFrame, at: str, full: int) -> DataFrame:
    """One row: whether a poll joins the one before without a gap (null if there was none).

    A full page whose oldest row is newer than the newest one known before may have missed rows.
    """
    now = page.agg(F.count("*").alias("n"), F.min(at).alias("oldest"))
    was = previous.agg(F.max(at).alias("newest"))
    gap = (F.col("n") >= full) & (F.col("oldest") > F.col("newest"))
    return now.crossJoin(F.broadcast(was)).select("n", F.when(F.col("newest").isNull(), F.lit(None)).otherwise(~gap).alias("complete"))
