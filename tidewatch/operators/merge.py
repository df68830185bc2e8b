"""Write semantics on plain tables: staged upserts, withdrawals, versions, retention.

Tables are files without MERGE, so each operator returns the table's next state. All keys join
null-safely where a key column may be null; one shuffle per side on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in ``order`` (give a total order)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def content_hash(*cols: str) -> Column:
    """A digest in which null and empty differ and field borders are kept."""
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def _matched(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    o = old.select(*keys, F.struct(*[c for c in old.columns if c not in keys]).alias("_o"))
    n = new.select(*keys, F.struct(*[c for c in new.columns if c not in keys]).alias("_n"))
    return o.join(n, keys, "full_outer")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], hash_col: str, stamp: Column,
           owned: list[str] | None = None, fill_empty: tuple[str, ...] = (), least: tuple[str, ...] = (),
           revive: bool = True) -> DataFrame:
    """Next state of ``old`` (with ``last_changed_at``, ``withdrawn_at``) after ``new``.

    ``owned`` columns come from ``new`` (all common ones by default), ``fill_empty`` arrays only
    where the old one is empty, ``least`` keeps the smaller value. ``last_changed_at`` moves
    only if the hash differs; a row seen again is no longer withdrawn if ``revive``.
    """
    values = [c for c in old.columns if c not in keys]
    owned = owned if owned is not None else [c for c in new.columns if c not in keys]
    seen, fresh = F.col("_n").isNotNull(), F.col("_o").isNull()
    out = []
    for c in values:
        was, now = F.col(f"_o.{c}"), F.col(f"_n.{c}") if c in new.columns else None
        if c == "last_changed_at":
            moved = fresh | ~F.col(f"_o.{hash_col}").eqNullSafe(F.col(f"_n.{hash_col}"))
            value = F.when(seen & moved, stamp).otherwise(was)
        elif c == "withdrawn_at":
            value = F.when(seen & F.lit(revive), F.lit(None)).otherwise(was)
        elif c in least:
            value = F.least(was, now)
        elif c in fill_empty:
            value = F.when(seen & (F.coalesce(F.size(was), F.lit(0)) <= 0), now).otherwise(was)
        elif c in owned and now is not None:
            value = F.when(seen, now).otherwise(was)
        else:
            value = was
        out.append(value.cast(old.schema[c].dataType).alias(c))
    return _matched(old, new, keys).select(*keys, *out)


def withdraw_missing(live: DataFrame, snapshot: DataFrame, keys: list[str], stamp: Column, complete: bool) -> DataFrame:
    """Rows absent from a complete snapshot get ``withdrawn_at``; an incremental one withdraws nothing."""
    if not complete:
        return live
    here = snapshot.select(*keys).distinct().withColumn("_here", F.lit(True))
    gone = F.col("_here").isNull() & F.col("withdrawn_at").isNull()
    return (
        live.join(here, keys, "left")
        .withColumn("withdrawn_at", F.when(gone, stamp).otherwise(F.col("withdrawn_at"))).drop("_here")
    )


def append_versions(history: DataFrame, new: DataFrame, keys: list[str], hash_col: str) -> DataFrame:
    """``history`` (with ``version``) and one new version for each row whose hash is not its latest one."""
    latest = last_per_key(history, keys, [F.col("version").desc()]).select(
        *keys, F.col("version").alias("_v"), F.col(hash_col).alias("_h"))
    added = (
        new.join(latest, keys, "left").where(F.col("_v").isNull() | ~F.col(hash_col).eqNullSafe(F.col("_h")))
        .withColumn("version", F.coalesce(F.col("_v"), F.lit(0)) + 1).drop("_v", "_h")
    )
    return history.unionByName(added.select(*history.columns))


def changed_fields(old: DataFrame, new: DataFrame, keys: list[str], ignore: tuple[str, ...] = ()) -> DataFrame:
    """(keys, changed): names of the columns that differ, for rows on both sides that differ."""
    cols = [c for c in old.columns if c in new.columns and c not in keys and c not in ignore]
    both = _matched(old, new, keys).where("_o is not null and _n is not null")
    names = F.array(*[F.when(~F.col(f"_o.{c}").eqNullSafe(F.col(f"_n.{c}")), F.lit(c)) for c in cols])
    return both.select(*keys, F.array_compact(names).alias("changed")).where(F.size("changed") > 0)


def insert_or_earlier(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Only rows of ``new`` that are unknown, or whose ``value`` is strictly earlier than the known one."""
    return new.join(old.select(*keys, F.col(value).alias("_was")), keys, "left").where(
        F.col("_was").isNull() | (F.col(value) < F.col("_was"))).drop("_was")


def replaced(old: DataFrame, new: DataFrame, parts: list[str]) -> DataFrame:
    """``old`` with every partition that ``new`` has taken from ``new`` alone."""
    return old.join(new.select(*parts).distinct(), parts, "left_anti").unionByName(new)


def newest_partitions(rows: DataFrame, part: str, keep: int, referenced: DataFrame) -> DataFrame:
    """Rows of the ``keep`` newest values of ``part`` and of those that ``referenced`` names."""
    newest = rows.select(part).distinct().orderBy(F.col(part).desc()).limit(keep)
    return rows.join(newest.union(referenced.select(part)).distinct(), part, "left_semi")
