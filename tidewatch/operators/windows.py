"""Order-dependent operators over dates: gaps, episodes, life cycles, hysteresis, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing_days(days: DataFrame, keys: list[str], day: str) -> DataFrame:
    """(keys, day) between a key's first and last day that have no row; absence is never a zero."""
    spans = days.groupBy(*keys).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    every = spans.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias(day))
    return every.join(days.select(*keys, day).distinct(), [*keys, day], "left_anti")


def anchored_episodes(rows: DataFrame, keys: list[str], day: str, span: int) -> DataFrame:
    """(keys, episode, first_day, last_day, n): an episode takes what lies within ``span`` days of its first row.

    Anchored, not gap-based: a fold over a key's sorted distinct days (few bytes each), exploded again.
    """
    daily = rows.groupBy(*keys, day).agg(F.count("*").alias("_n"))
    sorted_days = daily.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(day, "_n"))).alias("_days"))
    kind = "array<struct<first_day:date,last_day:date,n:bigint>>"
    last = lambda acc: F.element_at(acc, -1)

    def step(acc: Column, x: Column) -> Column:
        fresh = F.array(F.struct(x[day].alias("first_day"), x[day].alias("last_day"), x["_n"].alias("n")))
        grown = F.array(F.struct(last(acc)["first_day"].alias("first_day"), x[day].alias("last_day"), (last(acc)["n"] + x["_n"]).alias("n")))
        inside = (F.size(acc) > 0) & (F.datediff(x[day], F.try_element_at(acc, F.lit(-1))["first_day"]) <= span)
        return F.when(inside, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), grown)).otherwise(F.concat(acc, fresh))

    folded = sorted_days.withColumn("_e", F.aggregate("_days", F.array().cast(kind), step))
    return folded.select(*keys, F.posexplode("_e").alias("_p", "_x")).select(
        *keys, (F.col("_p") + 1).alias("episode"), "_x.first_day", "_x.last_day", "_x.n")


def score_life_cycle(scores: DataFrame, key: str, day: str, score: str, model: str, high: float = 0.10, low: float = 0.07, hold: int = 7) -> DataFrame:
    """Transitions (key, day, direction, score, previous_score, cause) of a score between high and low.

    High at ``high`` or more, low below ``low``, else no move. A change counts once it held for
    ``hold`` scores and is dated at the first of them; a first score that is high counts at once. The
    cause is ``already_high`` on the first day of all history, ``first_scored`` for later first scores,
    ``model_change`` if the model differs from the score before, else ``organic``.
    """
    w = Window.partitionBy(key).orderBy(day)
    d = (
        scores.withColumn("_seq", F.row_number().over(w)).withColumn("_prev", F.lag(score).over(w))
        .withColumn("_model", F.lag(model).over(w))
        .withColumn("_side", F.when(F.col(score) >= high, 1).when(F.col(score) < low, 0))
    )
    # a score between the limits moves nothing: it carries the side before it
    d = d.withColumn("_run", F.last("_side", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("_turn", F.coalesce(F.lag("_run").over(w), F.lit(-1)) != F.coalesce("_run", F.lit(-1)))
    d = d.withColumn("_island", F.sum(F.col("_turn").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    begin = scores.agg(F.min(day).alias("_begin"))
    runs = d.where("_run is not null").groupBy(key, "_island", "_run").agg(
        F.count("*").alias("_len"), F.min(F.struct("_seq", day, score, "_prev", model, "_model")).alias("_f"))
    kept = runs.where((F.col("_len") >= hold) | ((F.col("_f._seq") == 1) & (F.col("_run") == 1)))
    v = Window.partitionBy(key).orderBy("_island")
    state = F.coalesce(F.lag("_run").over(v), F.lit(0))
    kept = kept.withColumn("_state", state).where("_run <> _state").crossJoin(F.broadcast(begin))
    first = F.col("_f._seq") == 1
    cause = (
        F.when(first & (F.col(f"_f.{day}") == F.col("_begin")), "already_high").when(first, "first_scored")
        .when(F.col("_f._model") != F.col(f"_f.{model}"), "model_change").otherwise("organic"))
    return kept.select(
        key, F.col(f"_f.{day}").alias(day), F.when(F.col("_run") == 1, "rise").otherwise("fall").alias("direction"),
        F.col(f"_f.{score}").alias("score"), F.col("_f._prev").alias("previous_score"), cause.alias("cause"))


def hysteresis(rows: DataFrame, key: str, value: str, before: DataFrame, enter: float = 50, stay: float = 35) -> DataFrame:
    """``rows`` with ``listed``: at least ``enter``, or at least ``stay`` if the key is in ``before``."""
    was = before.select(key).distinct().withColumn("_was", F.lit(True))
    limit = F.when(F.col("_was"), stay).otherwise(enter)
    return rows.join(was, key, "left").withColumn("listed", F.col(value) >= limit).drop("_was")


def runs(rows: DataFrame, at: str, value: str, every: int | None = None) -> DataFrame:
    """(lo, hi, value): maximal runs of consecutive ``at`` with one value, cut at multiples of ``every``."""
    block = F.floor(F.col(at) / every) if every else F.lit(0)
    w = Window.partitionBy("_b").orderBy(at)
    d = rows.withColumn("_b", block)
    turn = (F.col(at) != F.lag(at).over(w) + 1) | ~F.col(value).eqNullSafe(F.lag(value).over(w))
    d = d.withColumn("_i", F.sum(F.coalesce(turn, F.lit(True)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy("_b", "_i").agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.first(value).alias(value)).drop("_b", "_i")


def folded_posts(posts: DataFrame, actor: str, subject: str, at: str, days: int = 14) -> DataFrame:
    """``posts`` with ``episode_start``: the nearest open episode of actor and subject within ``days`` of its first day.

    Posts fold in order of their day; distance is to an episode's first day, so a long series splits. The
    fold runs over a pair's distinct days only and is joined back on the day.
    """
    sorted_days = posts.groupBy(actor, subject).agg(F.array_sort(F.collect_set(at)).alias("_days"))

    def step(acc: Column, d: Column) -> Column:
        near = F.array_max(F.transform(F.filter(acc, lambda s: F.datediff(d, s["start"]) <= days), lambda s: s["start"]))
        return F.concat(acc, F.array(F.struct(d.alias("day"), F.coalesce(near, d).alias("start"))))

    kind = "array<struct<day:date,start:date>>"
    starts = sorted_days.select(actor, subject, F.explode(F.aggregate("_days", F.array().cast(kind), step)).alias("_e"))
    return posts.join(starts.select(actor, subject, F.col("_e.day").alias(at), F.col("_e.start").alias("episode_start")), [actor, subject, at])
