"""Shards of bounded size by extendible hashing.

A document's key is a hash; a bucket is a prefix of its bits. A bucket that holds more bytes than
the limit is split on its next bit, others stay: the directory is the set of buckets at the least
depth at which each fits. Splitting never looks at documents: their bytes are summed once per
prefix of ``depth`` bits, and the levels above are sums of sums, so the directory comes from a table of
at most 2**depth rows. ``depth`` follows the total (64 entries per expected shard).

Only where an entry of full depth is still too large (a hot spot in the key) are its own documents
looked at again: they continue with the next bits of a second hash of key and text, and rows
that are equal in everything with a number per row, so that repeated rows split too. A single
document above the limit is a shard of its own, marked ``oversized``.

Defined cases: null texts have 0 bytes; null ids share a key until the second hash; a very long text above
the limit is an oversized shard; rows that repeat are placed one by one; an empty table
gives an empty directory; other columns are ignored by ``sharded``, kept by ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import store

LIMIT = 32 << 20
SHARDS = 64
MORE_BITS = 30


def _bits(hex8: Column, depth: int) -> Column:
    """The first ``depth`` bits (at most 32) of eight hex digits, as a string of 0 and 1."""
    return F.substring(F.lpad(F.conv(hex8, 16, 2), 32, "0"), 1, depth)


def _buckets(entries: DataFrame, depth: int, limit: int) -> DataFrame:
    """(entry, bucket, bytes, docs): the shortest prefix of each entry that fits, or the entry."""
    at = entries.select("entry", "bytes", "docs", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("d"))
    nodes = at.groupBy(F.expr("substring(entry, 1, d)").alias("bucket"), "d").agg(
        F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
    fits = nodes.where((F.col("bytes") <= limit) | (F.col("d") == depth))
    # a bucket is used if its parent is too large; the root has no parent
    up = nodes.select(F.col("bucket").alias("parent"), F.col("bytes").alias("above"))
    used = (
        fits.withColumn("parent", F.when(F.col("d") > 0, F.expr("substring(bucket, 1, d - 1)")))
        .join(up, "parent", "left").where((F.col("above") > limit) | (F.col("d") == 0))
        .select("bucket", "d", "bytes", "docs")
    )
    return (
        at.select("entry", "d", F.expr("substring(entry, 1, d)").alias("bucket"))
        .join(used, ["bucket", "d"]).select("entry", "bucket", "bytes", "docs")
    )


def balanced_limit(docs: DataFrame, shards: int = SHARDS, most: int = LIMIT) -> int:
    """The byte limit at which about ``shards`` shards hold ``docs``, but never above ``most``."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(1, min(most, total // shards))


def _keyed(docs: DataFrame, *carried: Column) -> DataFrame:
    return docs.select(
        *carried, "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8).alias("k1"),
        F.substring(F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))), 9, 8).alias("k2"))


def _placed(rows: DataFrame, limit: int, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``rows`` (of :func:`_keyed`) with the bucket of each row and that bucket's bytes."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(24, max(6, (-(-total // limit)).bit_length() + 6))
    rows = rows.withColumn("entry", _bits(F.col("k1"), depth))
    entries = rows.groupBy("entry").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs"))
    directory = store.saved(_buckets(entries, depth, limit), "directory")
    # every entry of a bucket that is too large has full depth, so it is that bucket's only one
    deep = directory.where((F.col("bytes") > limit) & (F.col("docs") > 1)).select("entry")
    n_deep, n_all = deep.count(), directory.count()
    first = rows.join(store.hinted(directory, n_all), "entry")
    if not n_deep:
        return first.select(*keep, "bucket", "bytes")
    # bits of the second hash, then of the row's number, which is fixed when these rows are written; entry by entry
    more = rows.join(store.hinted(deep, n_deep), "entry").withColumn("n", F.monotonically_increasing_id()).withColumn(
        "path", F.concat(_bits(F.col("k2"), MORE_BITS), _bits(F.substring(F.md5(F.col("n").cast("string")), 1, 8), MORE_BITS)))
    found = first.where((F.col("bytes") <= limit) | (F.col("docs") == 1)).select(*keep, "bucket", "bytes")
    return found.unionByName(_deeper(more, limit, keep))


def sharded(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, shard (bit string), depth, shard_bytes, oversized."""
    found = _placed(store.saved(_keyed(docs), "shard-rows"), limit, ["doc_id", "n_bytes"])
    return found.select(
        "doc_id", "n_bytes", F.col("bucket").alias("shard"), F.length("bucket").alias("depth"),
        F.col("bytes").alias("shard_bytes"), (F.col("bytes") > limit).alias("oversized"))


def _deeper(rows: DataFrame, limit: int, keep: list[str]) -> DataFrame:
    """Rows of entries that are too large, split on the bits of ``path``, a few bits a round."""
    step, at, out = 6, 0, None
    width = 2 * MORE_BITS
    held = list(dict.fromkeys([*keep, "n_bytes", "entry", "path"]))
    rows = store.saved(rows.select(*held), "deep")
    while True:
        d = rows.withColumn("head", F.col("entry")).withColumn("entry", F.concat("entry", F.substring("path", at + 1, step)))
        sums = d.groupBy("head", "entry").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs"))
        levels = sums.withColumn("d", F.explode(F.sequence(F.lit(1), F.lit(step)))).withColumn(
            "bucket", F.expr("substring(entry, 1, length(head) + d)"))
        nodes = levels.groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
        fit = (
            levels.select("entry", "bucket", "d").join(nodes, "bucket")
            .withColumn("last", F.col("d") == step)
            .where((F.col("bytes") <= limit) | F.col("last"))
            .groupBy("entry").agg(F.min_by(F.struct("bucket", "bytes", "docs"), "d").alias("b"))
            .select("entry", "b.*")
        )
        placed = d.drop("head").join(fit, "entry")
        at += step
        open_ = (F.col("bytes") > limit) & (F.col("docs") > 1) & F.lit(at < width)
        done = placed.where(~open_).select(*keep, "bucket", "bytes")
        out = done if out is None else out.unionByName(done)
        if at >= width:
            return out
        rows = store.saved(placed.where(open_).select(*held), "deep")
        if rows.isEmpty():
            return out


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Write the rows of ``docs``, one folder for each shard of :func:`sharded`.

    The folders are named after the column ``shard``, with underscores before it while ``docs`` has such a column.
    """
    name = "shard"
    while name in docs.columns:
        name = f"_{name}"
    # the row travels with its keys as one struct, so each row goes where it was counted
    found = _placed(_keyed(docs, F.struct(*docs.columns).alias("_row")), limit, ["_row"])
    found.select("_row.*", F.col("bucket").alias(name)).repartition(name).write.partitionBy(name).parquet(path)
