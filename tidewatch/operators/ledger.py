"""Book-keeping of runs: watermarks, cursors, decisions, candidates, retention and capped appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.merge import last_per_key


def source_state(runs: DataFrame, source: str, at: str, ok: str) -> DataFrame:
    """(source, last_run, last_success, failures): a failed run moves ``last_run`` only; failures count since the last success."""
    good = runs.groupBy(source).agg(F.max(at).alias("last_run"), F.max(F.when(F.col(ok), F.col(at))).alias("last_success"))
    since = runs.join(good, source).where(F.col("last_success").isNull() | (F.col(at) > F.col("last_success")))
    return good.join(since.groupBy(source).agg(F.count("*").alias("failures")), source, "left").withColumn(
        "failures", F.coalesce("failures", F.lit(0)))


def resume_points(windows: DataFrame, key: str, lo: str, hi: str, ok: str) -> DataFrame:
    """(key, resume_at): the start of the first failed window, else the end of the last one. A failed window is never skipped."""
    failed = F.min(F.when(~F.col(ok), F.col(lo)))
    return windows.groupBy(key).agg(F.coalesce(failed, F.max(hi)).alias("resume_at"))


def withdraw_listed(live: DataFrame, decisions: DataFrame, keys: list[str], stamp: str) -> DataFrame:
    """``live`` with ``withdrawn_at`` set from ``decisions`` (keys, ``stamp``) where it is not set yet; the first decision counts."""
    first = decisions.groupBy(*keys).agg(F.min(stamp).alias("_stamp"))
    return live.join(first, keys, "left").withColumn("withdrawn_at", F.coalesce("withdrawn_at", "_stamp")).drop("_stamp")


def append_capped(latest: DataFrame, batch: DataFrame, key: str, digest: str, cap: int) -> DataFrame:
    """(key, digest, outcome): rows of ``batch`` that are new or changed; the first ``cap`` by key are 'appended', the rest 'deferred'.

    The cap is the feature: a run writes that many versions and leaves the others to the next one.
    """
    known = latest.select(key, F.col(digest).alias("_was"), F.lit(True).alias("_known"))
    moved = batch.join(known, key, "left").where(F.col("_known").isNull() | ~F.col(digest).eqNullSafe(F.col("_was"))).drop("_was", "_known")
    first = moved.select(key).orderBy(key).limit(cap).withColumn("_now", F.lit(True))
    return moved.join(first, key, "left").select(key, digest, F.when(F.col("_now"), "appended").otherwise("deferred").alias("outcome"))


def unseen(candidates: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct candidates that are not known yet."""
    return candidates.select(*keys).distinct().join(known.select(*keys).distinct(), keys, "left_anti")


def replaced_whole(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, outcome) of replacing ``old`` by ``new`` as a whole: added, kept or removed."""
    o, n = (d.select(key).distinct().withColumn(t, F.lit(True)) for d, t in ((old, "_o"), (new, "_n")))
    outcome = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").otherwise("kept")
    return o.join(n, key, "full_outer").select(key, outcome.alias("outcome"))


def without_superseded(deltas: DataFrame, bundles: DataFrame, part: str) -> DataFrame:
    """Deltas whose day has no bundle yet; those of a bundled day are superseded."""
    return deltas.join(bundles.select(part).distinct(), part, "left_anti")


def first_by_origin(parts: list[DataFrame], key: str) -> DataFrame:
    """The union of ``parts`` (same columns); of rows with one key the earliest part's stays, then the smallest row."""
    out = None
    for k, d in enumerate(parts):
        one = d.withColumn("origin", F.lit(k))
        out = one if out is None else out.unionByName(one)
    rest = [c for c in out.columns if c not in (key, "origin")]
    return out.groupBy(key).agg(F.min(F.struct("origin", *rest)).alias("_r")).select(key, "_r.*")


def latest_before(rows: DataFrame, keys: list[str], week: str, usable: Column, days: int) -> DataFrame:
    """``rows`` with ``previous``: the last usable week of the key before its own, at most ``days`` earlier."""
    w = Window.partitionBy(*keys).orderBy(week).rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(usable, F.col(week))).over(w)
    return rows.withColumn("_p", last).withColumn("previous", F.when(F.datediff(week, "_p") <= days, F.col("_p"))).drop("_p")


def latest_texts(rows: DataFrame, key: str, ref: str, order: list[str], text: str) -> DataFrame:
    """(key, text, versions): the latest version of each of a key's references, joined by reference."""
    last = last_per_key(rows, [key, ref], [F.col(c).desc() for c in order])
    return last.groupBy(key).agg(
        F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct(ref, text))), lambda x: x[text].cast("string"))).alias(text),
        F.count("*").alias("versions"))


def due_months(months: DataFrame, month: str, verdict: str) -> DataFrame:
    """``months`` with ``action``: stored in order, up to the first month that has to wait; refused months are stored as such."""
    first = months.where(F.col(verdict) == "wait").agg(F.min(month).alias("_first"))
    stop = F.col("_first").isNotNull() & (F.col(month) >= F.col("_first"))
    action = F.when(stop & (F.col(month) == F.col("_first")), "wait").when(stop, "blocked").when(F.col(verdict) == "refuse", "store refused").otherwise("store")
    return months.crossJoin(F.broadcast(first)).withColumn("action", action).drop("_first")
