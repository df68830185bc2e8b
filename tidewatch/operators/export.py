"""Deterministic exports: ordered CSV parts with a checked key, gzip without a time, and a manifest."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import gates
from tidewatch.operators.scratch import cut


def exported(tables: dict[str, tuple[DataFrame, list[str]]], path: str, censored: str, methods: dict[str, str]) -> DataFrame:
    """Write each table (frame, sort key) as gzipped CSV parts under ``path`` and return the manifest.

    All tables are read and their keys checked before any is written. Parts are ranges of the key, each sorted, so the
    files read in the order of their names are in the order of the key. Spark's gzip writer puts no time into a
    file, so equal rows give equal bytes. The manifest has a row per table: rows, columns, a digest that doesn't depend
    on the parts, the censoring date and the method versions; it is written beside them as one JSON file.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    read = {name: (cut(df), key) for name, (df, key) in tables.items()}
    gates.enforce(gates.suite([gates.unique_key(df, f"{name}: key is unique", key) for name, (df, key) in read.items()]))
    rows = []
    for name, (df, key) in sorted(read.items()):
        parts = max(1, -(-df.count() // 1_000_000))
        df.repartitionByRange(parts, *key).sortWithinPartitions(*key).write.option("header", True).option("compression", "gzip").csv(f"{path}/{name}")
        line = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
        # the sum of row digests (32 bits of each of two) needs no order and no single task
        half = lambda k: F.sum(F.conv(F.substring(line, k, 8), 16, 10).cast("decimal(20,0)"))
        n, one, two = df.agg(F.count("*"), half(1), half(9)).first()
        rows.append((name, n, ",".join(df.columns), hashlib.sha256(f"{n}:{one}:{two}".encode()).hexdigest(), censored, json.dumps(methods, sort_keys=True)))
    manifest = spark.createDataFrame(rows, "name string, rows long, columns string, digest string, censored string, methods string")
    manifest.coalesce(1).write.json(f"{path}/manifest")
    return manifest
