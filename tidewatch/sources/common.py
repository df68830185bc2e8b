"""Shared steps of readers."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per file of whole-file JSON."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows of NDJSON, rejected lines): a line that is no object of the schema is rejected, blank ones are skipped."""
    raw = spark.read.text(path).where("trim(value) <> ''")
    row = raw.select("value", F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    good = row.where("r._bad is null and r is not null").select("r.*").drop("_bad")
    return good, row.where("r._bad is not null or r is null").select(F.lit("malformed line").alias("reason"), F.col("value").alias("record"))


def split(rows: DataFrame, *rules: tuple[Column, str]) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): the first rule that holds is the reason."""
    reason = F.lit(None).cast("string")
    for bad, why in reversed(rules):
        reason = F.when(F.coalesce(bad, F.lit(False)), why).otherwise(reason)
    d = rows.withColumn("_reason", reason)
    record = F.to_json(F.struct(*rows.columns))
    return d.where("_reason is null").drop("_reason"), d.where("_reason is not null").select(F.col("_reason").alias("reason"), record.alias("record"))


def urls(text: Column, pattern: str = r"[,;\s]+") -> Column:
    """Distinct http urls of a delimited text, in order."""
    return F.array_distinct(F.filter(F.split(F.coalesce(text, F.lit("")), pattern), lambda u: u.rlike("^https?://")))


def clamp(values: Column, most: int = 20) -> Column:
    """At most ``most`` distinct values, in order (a rule of the stored tables)."""
    return F.slice(F.array_distinct(F.coalesce(values, F.array().cast("array<string>"))), 1, most)


def zip_members(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(archive, member, text) of zip files, also of zips inside zips; members are streamed one by one."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def members(data: bytes, name: str) -> Iterator[tuple[str, str]]:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for info in z.infolist():
                if info.filename.endswith(".zip"):
                    yield from members(z.read(info), info.filename)
                elif info.filename.endswith(suffix):
                    yield info.filename, z.read(info).decode("utf-8", "replace")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path_, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for name, text in members(content.as_py(), path_):
                    yield pa.record_batch([pa.array([path_]), pa.array([name]), pa.array([text])], names=["archive", "member", "text"])

    return files.mapInArrow(run, "archive string, member string, text string")
