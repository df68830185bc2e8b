"""Runs that commit in parts, versions that are active from a day on, repair plans that are checked before they are applied."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.operators import gates
from tidewatch.operators.scratch import stored

_RUN = "run string, seq long, part string, ok boolean, blocked array<string>, tables array<string>, rows long"


@dataclass
class Part:
    """Tables that become visible together, if none of their gates blocks; ``checks`` gets the staged tables."""

    tables: dict[str, DataFrame]
    checks: Callable[[dict[str, DataFrame]], DataFrame]
    staged: dict[str, DataFrame] = field(default_factory=dict)


class RunStore:
    """Tables written by runs, in a folder that all executors share.

    A run first writes its records (what it fetched), which stay whatever the gates say. Each part is then staged in a folder of the run and checked as
    stored. One small file of rows, written last, is the commit: readers take a table from the last run that it names as sound, so a failed or
    interrupted run leaves what was visible before, and a part that is blocked does not hold back the others. A run that has its rows is never repeated;
    one that was interrupted writes over what it had staged.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def runs(self) -> DataFrame:
        """(run, seq, part, ok, blocked, tables, rows): a row per run and part, and one without a part for the run itself."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/runs")
        there = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
        return self.spark.read.schema(_RUN).json(f"{self.path}/runs/*") if there else self.spark.createDataFrame([], _RUN)

    def _staged(self, name: str, run: str, df: DataFrame) -> DataFrame:
        place = f"{self.path}/tables/{name}/{run}"
        df.write.mode("overwrite").parquet(place)
        return self.spark.read.schema(df.schema).parquet(place)

    def run(self, run: str, records: dict[str, DataFrame], parts: dict[str, Part]) -> bool:
        """Whether all parts of ``run`` are sound; a run that was finished before is only looked up."""
        done = self.runs()
        known = done.where((F.col("run") == run) & F.col("part").isNull()).select("ok").first()
        if known is not None:
            return known["ok"]
        seq = (done.agg(F.max("seq")).first()[0] or 0) + 1
        for name, df in records.items():
            df.write.mode("overwrite").parquet(f"{self.path}/records/{name}/{run}")
        rows = []
        for part, p in parts.items():
            staged = {name: self._staged(name, run, df) for name, df in p.tables.items()}
            # a row per check
            bad = [r["name"] for r in p.checks(staged).where(f"severity = '{gates.ERROR}' and not passed").collect()]
            rows.append((run, seq, part, not bad, sorted(bad), sorted(staged), 0 if bad else sum(d.count() for d in staged.values())))
        ok = all(r[3] for r in rows)
        rows.append((run, seq, None, ok, sorted({b for r in rows for b in r[4]}), [], sum(r[6] for r in rows)))
        self.spark.createDataFrame(rows, _RUN).coalesce(1).write.mode("overwrite").json(f"{self.path}/runs/{seq:08d}-{run}")
        return ok

    def _sound(self, name: str) -> list[str]:
        """Runs whose part with the table is sound, the last one first: one name a run."""
        d = self.runs().where(F.col("ok") & F.col("part").isNotNull() & F.array_contains("tables", name)).orderBy(F.desc("seq")).select("run")
        return [r["run"] for r in d.collect()]

    def visible(self, name: str) -> DataFrame | None:
        """The table as the last sound run wrote it."""
        sound = self._sound(name)
        return self.spark.read.parquet(f"{self.path}/tables/{name}/{sound[0]}") if sound else None

    def history(self, name: str) -> DataFrame | None:
        """The table of all sound runs, with the run."""
        sound = self._sound(name)
        out = None
        for run in sound:
            one = self.spark.read.parquet(f"{self.path}/tables/{name}/{run}").withColumn("run", F.lit(run))
            out = one if out is None else out.unionByName(one)
        return out

    def records(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/records/{name}/*")


# versions

#: Accepted facts and their share of right ones that a field's version needs.
ACCEPTED, RIGHT = 5, 0.95


def activations(scores: DataFrame) -> DataFrame:
    """(field, lang, version, day, accepted, correct, verdict) from score files (field, lang, version, day, file_lang, file_version, accepted, correct).

    A version is activated for a field by the scores of one day together, if each file was scored on its language and with its prompt, at
    least five facts were accepted and 95 per cent of them are right; else the verdict names the first rule that it misses.
    """
    d = scores.groupBy("field", "lang", "version", "day").agg(
        F.sum("accepted").alias("accepted"), F.sum("correct").alias("correct"), F.bool_and(F.col("file_lang").eqNullSafe(F.col("lang"))).alias("own_lang"),
        F.bool_and(F.col("file_version").eqNullSafe(F.col("version"))).alias("own_version"))
    verdict = (
        F.when(~F.col("own_lang"), "other language").when(~F.col("own_version"), "other prompt").when(F.coalesce(F.col("accepted") < ACCEPTED, F.lit(True)), "too few")
        .when(F.col("correct") < RIGHT * F.col("accepted"), "not precise").otherwise("activated"))
    return d.select("field", "lang", "version", "day", "accepted", "correct", verdict.alias("verdict"))


def active_on(facts: DataFrame, activated: DataFrame) -> DataFrame:
    """``facts`` (field, lang, day, ...) with ``version``, the one activated last on or before their day (of one day the greatest).

    A version serves from its day to the day before the next: a fact meets exactly one span. Spans are few for a field and language; the join is
    on these, so facts of a large field are split among tasks where that side is skewed.
    """
    on = activated.where("verdict = 'activated'").groupBy("field", "lang", "day").agg(F.max("version").alias("version"))
    spans = on.withColumn("until", F.lead("day").over(Window.partitionBy("field", "lang").orderBy("day"))).select(
        F.col("field").alias("_f"), F.col("lang").alias("_l"), F.col("day").alias("_from"), "until", "version")
    here = (F.col("field") == F.col("_f")) & (F.col("lang") == F.col("_l")) & (F.col("day") >= F.col("_from")) & (F.col("until").isNull() | (F.col("day") < F.col("until")))
    return facts.join(spans, here, "left").select(*facts.columns, "version")


# repair

#: Fixed values, in days and years: the window of events, the lag of filings, how much older an incident is, how old a year is.
EVENT_DAYS, FILING_DAYS, OLDER_DAYS, OLD_YEARS = 30, 270, 180, 2


def repair_plan(rows: DataFrame, incidents: DataFrame) -> DataFrame:
    """(row, follow_up, old_year, older, action, target, how): exactly one decision for each press-only row.

    ``rows`` (row, org, event, public, follow_up, years: array of stated breach years, dup_of), ``incidents`` (incident, org, event, public, structured, dup_of). The same
    breach, in order of evidence: an event within 30 days or a filing up to 270 days after it; an incident of a stated year, where no event is stated; for a
    follow-up without any date the organisation's only older root. A linked row is only reviewed; so is a follow-up without an incident. Incidents
    that point at the row are no targets. Rows without a flag are kept as they are.
    """
    i = incidents.select("org", "incident", F.col("event").alias("iev"), F.col("public").alias("ipub"), "structured", F.col("dup_of").alias("idup"))
    j = rows.join(i, "org", "left").where("incident is null or (incident <> row and ipub <= public and not (idup <=> row))")
    older = F.col("ipub") <= F.date_sub("public", OLDER_DAYS)
    rank = F.struct((~F.col("structured")).alias("weak"), F.col("idup").isNotNull().alias("copy"), F.col("ipub").alias("at"), "incident")
    best = lambda ok: F.min(F.when(F.coalesce(ok, F.lit(False)), rank))["incident"]
    by_event = F.col("event").isNotNull() & F.when(F.col("iev").isNotNull(), F.abs(F.datediff("iev", "event")) <= EVENT_DAYS).otherwise(F.datediff("ipub", "event").between(0, FILING_DAYS))
    filed = lambda y: F.col("ipub").between(F.make_date(y, F.lit(1), F.lit(1)), F.date_add(F.make_date(y, F.lit(12), F.lit(31)), FILING_DAYS))
    year = F.exists("years", lambda y: F.when(F.col("iev").isNotNull(), F.year("iev") == y).otherwise(filed(y)))
    root = older & F.col("idup").isNull()
    d = j.groupBy("row").agg(best(by_event).alias("by_event"), best(year).alias("by_year"), F.count_if(root).alias("roots"), best(root).alias("root"), F.coalesce(F.bool_or(older), F.lit(False)).alias("older"))
    d = rows.join(d, "row", "left").withColumn("older", F.coalesce("older", F.lit(False)))
    old_year = F.coalesce(F.exists("years", lambda y: y <= F.year("public") - OLD_YEARS), F.lit(False))
    d = d.withColumn("old_year", old_year).withColumn("follow_up", F.coalesce("follow_up", F.lit(False)))
    undated = F.col("event").isNull() & (F.coalesce(F.size("years"), F.lit(0)) <= 0)
    how = (
        F.when(F.col("by_event").isNotNull(), "event_window").when(F.col("by_year").isNotNull() & F.col("event").isNull(), "stated_year")
        .when(F.col("follow_up") & undated & (F.col("roots") == 1), "only_older_incident"))
    flagged = F.col("follow_up") | F.col("old_year") | F.col("older")
    d = d.withColumn("found", F.when(flagged, how)).withColumn(
        "target", F.when(F.col("found") == "event_window", F.col("by_event")).when(F.col("found") == "stated_year", F.col("by_year")).when(F.col("found") == "only_older_incident", F.col("root")))
    action = F.when(F.col("found").isNotNull(), F.when(F.col("dup_of").isNotNull(), "review").otherwise("duplicate")).when(flagged & F.col("follow_up"), "review").otherwise("keep")
    reason = (
        F.when(F.col("found").isNotNull(), F.when(F.col("dup_of").isNotNull(), "already_linked").otherwise(F.col("found"))).when(flagged & F.col("follow_up"), "no_older_incident")
        .when(flagged & F.col("old_year"), "late_notice").when(flagged, "older_row_no_shared_date"))
    return d.select("row", "follow_up", "old_year", "older", action.alias("action"), "target", reason.alias("how"))


def checked_plan(plan: DataFrame, current: DataFrame) -> DataFrame:
    """``plan`` with ``refused``: why a planned link can't be applied to the rows as they are now (row, dup_of); null if it can.

    Refused are rows that are gone or linked by now, targets that are gone, and links that would close a circle: the chain of a target's links, together
    with all links of the plan, must not come back to the row.
    """
    now = current.select(F.col("row").alias("_id"), F.col("dup_of").alias("_dup"))
    d = plan.join(now.withColumn("here", F.lit(True)), plan["row"] == F.col("_id"), "left").drop("_id").join(
        now.select(F.col("_id").alias("_t"), F.lit(True).alias("there")), F.col("target") == F.col("_t"), "left").drop("_t")
    links = d.where("action = 'duplicate' and _dup is null and here and there").select(F.col("row").alias("a"), F.col("target").alias("b"))
    every = stored(links.unionByName(now.where("_dup is not null").select(F.col("_id").alias("a"), F.col("_dup").alias("b"))))
    # each row has one link at most. Pointers are doubled until chains of any length have ended: those that are left lead into circles, and
    # what they point at by then are all the rows of circles
    step = every
    for _ in range(every.count().bit_length() + 1):
        step = stored(step.join(step.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b")))
        if step.isEmpty():
            break
    circle = step.select(F.col("b").alias("a")).distinct()
    d = d.join(circle.select(F.col("a").alias("row"), F.lit(True).alias("round")), "row", "left")
    refused = F.when(F.col("action") == "duplicate", F.when(F.col("here").isNull(), "row is gone").when(F.col("_dup").isNotNull(), "linked meanwhile").when(F.col("there").isNull(), "target is gone")
                     .when(F.col("round"), "would close a circle"))
    return d.select(*plan.columns, refused.alias("refused"))


def applied(current: DataFrame, plan: DataFrame) -> DataFrame:
    """``current`` (row, dup_of) with the links of a checked plan."""
    links = plan.where("action = 'duplicate' and refused is null").select("row", "target")
    return current.join(links, "row", "left").select("row", F.coalesce("dup_of", "target").alias("dup_of"))

