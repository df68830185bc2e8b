"""Sampling, thresholds, phrase joins, schedules and checks of published results."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.operators import stats
from tidewatch.plans.tables import ASSERTIONS, OBSERVATIONS, assertions, observations, table


def phrase_join(spark, sf_dir):
    """Benchmark items whose five-word phrases are found among the word windows of documents, by equality of windows."""
    def wins(name, key):
        d = table(spark, sf_dir, name).select(key, F.filter(F.split(F.lower("text"), r"[^\p{L}0-9]+"), lambda w: w != "").alias("w")).where("size(w) >= 5")
        return d.select(key, F.explode(F.array_distinct(F.transform(
            F.sequence(F.lit(0), F.size("w") - 5), lambda i: F.concat_ws(" ", *[F.get("w", i + k) for k in range(5)])))).alias("phrase"))

    return wins("documents", "doc_id").join(wins("benchmark", "item_id"), "phrase").groupBy("item_id").agg(
        F.count_distinct("doc_id").alias("docs"), F.min("doc_id").alias("first_doc"), F.count("*").alias("hits"))


_WINS = r"""SELECT DISTINCT {k}, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS phrase FROM (
  SELECT {k}, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}0-9]+'), lambda w: w <> '') AS w FROM {t}) WHERE len(w) >= 5"""
_PHRASE = f"""SELECT item_id, count(DISTINCT doc_id) AS docs, min(doc_id) AS first_doc, count(*) AS hits
FROM ({_WINS.format(k='doc_id', t='documents')}) JOIN ({_WINS.format(k='item_id', t='benchmark')}) USING (phrase) GROUP BY item_id"""


def threshold_choice(spark, sf_dir):
    """Lowest score limit at which the lower end of the precision's interval is 0.6 or more, by language."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", F.least(F.floor(F.col("n_chars") / 500), F.lit(20)).alias("score"))
    j = d.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    by = j.groupBy("lang", "score").agg(F.count("*").alias("c"), F.sum("quality").alias("h"))
    w = Window.partitionBy("lang").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    d = by.withColumn("n", F.sum("c").over(w)).withColumn("k", F.sum("h").over(w))
    low, _ = stats.wilson(F.col("k"), F.col("n"))
    return d.withColumn("low", low).groupBy("lang").agg(
        F.min(F.when(F.col("low") >= 0.6, F.col("score"))).alias("threshold"), F.round(F.max("low"), 6).alias("best_low"))


_THRESHOLD = """WITH j AS (SELECT lang, least(floor(n_chars / 500)::BIGINT, 20) AS score, quality FROM documents JOIN labels USING (doc_id)),
b AS (SELECT lang, score, count(*) AS c, sum(quality) AS h FROM j GROUP BY ALL),
d AS (SELECT lang, score, sum(c) OVER w AS n, sum(h) OVER w AS k FROM b WINDOW w AS (PARTITION BY lang ORDER BY score DESC)),
l AS (SELECT lang, score, greatest(0, (k / n + 3.8416 / (2 * n) - 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n)) AS low FROM d)
SELECT lang, min(score) FILTER (WHERE low >= 0.6) AS threshold, round(max(low), 6) AS best_low FROM l GROUP BY lang"""


def weighted_precision(spark, sf_dir):
    """Precision with inverse sampling weights per stratum, and the effective sample size."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").withColumn("stratum", F.concat_ws("|", "lang", F.when(F.col("n_chars") > 1500, "long").otherwise("short")))
    pop = d.groupBy("stratum").agg(F.count("*").alias("population"))
    lab = d.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    drawn = lab.groupBy("stratum").agg(F.count("*").alias("drawn"))
    w = lab.join(F.broadcast(pop), "stratum").join(F.broadcast(drawn), "stratum").withColumn("w", F.col("population") / F.col("drawn"))
    return w.groupBy("lang").agg(
        F.round(F.sum(F.col("w") * F.col("quality")) / F.sum("w"), 6).alias("precision"),
        F.round(F.sum("w") * F.sum("w") / F.sum(F.col("w") * F.col("w")), 4).alias("n_eff"), F.count("*").alias("labelled"))


_WEIGHTED = """WITH d AS (SELECT doc_id, lang, lang || '|' || CASE WHEN n_chars > 1500 THEN 'long' ELSE 'short' END AS stratum FROM documents),
p AS (SELECT stratum, count(*) AS population FROM d GROUP BY 1), l AS (SELECT d.*, quality FROM d JOIN labels USING (doc_id)),
s AS (SELECT stratum, count(*) AS drawn FROM l GROUP BY 1), w AS (SELECT l.*, population / drawn AS w FROM l JOIN p USING (stratum) JOIN s USING (stratum))
SELECT lang, round(sum(w * quality) / sum(w), 6) AS precision, round(sum(w) * sum(w) / sum(w * w), 4) AS n_eff, count(*) AS labelled FROM w GROUP BY lang"""


def sample_allocation(spark, sf_dir):
    """A labelling sample of 200 shared out over strata by size with largest remainders, at least two each."""
    d = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    total = d.agg(F.sum("n").alias("t"), F.count("*").alias("s"))
    d = d.crossJoin(F.broadcast(total)).withColumn("share", (F.lit(200) - 2 * F.col("s")) * F.col("n"))
    d = d.withColumn("whole", F.expr("greatest(share, 0L) div t")).withColumn("rest", F.expr("greatest(share, 0L) % t"))
    used = d.agg(F.greatest(F.lit(0), F.max(F.lit(200) - 2 * F.col("s")) - F.sum("whole")).alias("open"))
    # the strata are few; one ordered window over them decides who gets the rest
    k = F.row_number().over(Window.orderBy(F.col("rest").desc(), "lang", "source"))
    return d.withColumn("k", k).crossJoin(F.broadcast(used)).select(
        "lang", "source", "n", (2 + F.col("whole") + F.when(F.col("k") <= F.col("open"), 1).otherwise(0)).cast("long").alias("allocated"))


_ALLOCATION = """WITH d AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), t AS (SELECT sum(n)::BIGINT AS t, count(*) AS s FROM d),
x AS (SELECT lang, source, n, greatest((200 - 2 * s) * n, 0) // t AS whole, greatest((200 - 2 * s) * n, 0) % t AS rest, s FROM d, t),
o AS (SELECT greatest(0, max(200 - 2 * s) - sum(whole)) AS open FROM x)
SELECT lang, source, n, (2 + whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, lang, source) <= open THEN 1 ELSE 0 END)::BIGINT AS allocated FROM x, o"""


def scan_pressure_mix(spark, sf_dir):
    """Each vulnerability's share of a sensor's week, averaged over the sensors that were able to see it."""
    o = observations(spark, sf_dir).withColumn("week", F.to_date(F.date_trunc("week", "day")))
    n = o.groupBy("source", "week", "vuln").agg(F.sum("n").alias("n"))
    total = n.groupBy("source", "week").agg(F.sum("n").alias("t"))
    able = n.select("source", "vuln").distinct().groupBy("vuln").agg(F.count("*").alias("sensors"))
    s = n.join(total, ["source", "week"]).withColumn("share", F.col("n") / F.col("t")).groupBy("week", "vuln").agg(F.sum("share").alias("s"))
    return s.join(able, "vuln").select("week", "vuln", "sensors", F.round(F.col("s") / F.col("sensors"), 9).alias("mean_share"))


_MIX = f"""WITH {OBSERVATIONS}, n AS (SELECT source, date_trunc('week', day)::DATE AS week, vuln, sum(n) AS n FROM o GROUP BY ALL),
s AS (SELECT week, vuln, n / sum(n) OVER (PARTITION BY source, week) AS share FROM n), a AS (SELECT vuln, count(DISTINCT source) AS sensors FROM n GROUP BY 1)
SELECT week, s.vuln, sensors, round(sum(share) / sensors, 9) AS mean_share FROM s JOIN a USING (vuln) GROUP BY week, s.vuln, sensors"""


def month_gate(spark, sf_dir):
    """Months of the catalogue that may be scored: enough entries and lists, and at most nine days without one."""
    a = assertions(spark, sf_dir)
    m = a.groupBy(F.trunc("added", "month").alias("month")).agg(
        F.count("*").alias("entries"), F.count_distinct("source").alias("lists"), F.count_distinct("added").alias("days"))
    gap = F.dayofmonth(F.last_day("month")) - F.col("days")
    reason = F.when(F.col("entries") < 20, "too few entries").when(F.col("lists") < 5, "a list is missing").when(gap > 9, "too many gaps")
    return m.select("month", "entries", "lists", gap.cast("long").alias("gap_days"), reason.alias("refused_because"))


_MONTHS = f"""WITH {ASSERTIONS}, m AS (SELECT date_trunc('month', added)::DATE AS month, count(*) AS entries, count(DISTINCT source) AS lists,
  day(last_day(date_trunc('month', added)::DATE)) - count(DISTINCT added) AS gap_days FROM a GROUP BY date_trunc('month', added))
SELECT month, entries, lists, gap_days::BIGINT AS gap_days, CASE WHEN entries < 20 THEN 'too few entries' WHEN lists < 5 THEN 'a list is missing' WHEN gap_days > 9 THEN 'too many gaps' END AS refused_because FROM m"""


def watchdog_states(spark, sf_dir):
    """Each feed's state on a day: registered feeds that never ran, are overdue or fine, and unknown ones."""
    seen = observations(spark, sf_dir).groupBy(F.col("source").alias("feed")).agg(F.max("day").alias("last_day"))
    plan = spark.createDataFrame([("view", 1, True), ("click", 1, True), ("error", 0, True), ("purchase", 1, False), ("canary", 7, True)], "feed string, every_days int, enabled boolean")
    late = F.datediff(F.lit("2024-01-31").cast("date"), "last_day")
    state = (
        F.when(F.col("every_days").isNull(), "UNREGISTERED").when(~F.col("enabled"), "DISABLED").when(F.col("last_day").isNull(), "NEVER RAN")
        .when(late > F.col("every_days"), "OVERDUE").otherwise("OK"))
    return plan.join(seen, "feed", "full_outer").select("feed", "last_day", state.alias("state"))


_WATCHDOG = f"""WITH {OBSERVATIONS}, s AS (SELECT source AS feed, max(day) AS last_day FROM o GROUP BY 1),
p(feed, every_days, enabled) AS (VALUES ('view', 1, true), ('click', 1, true), ('error', 0, true), ('purchase', 1, false), ('canary', 7, true))
SELECT feed, last_day, CASE WHEN every_days IS NULL THEN 'UNREGISTERED' WHEN NOT enabled THEN 'DISABLED' WHEN last_day IS NULL THEN 'NEVER RAN'
  WHEN DATE '2024-01-31' - last_day > every_days THEN 'OVERDUE' ELSE 'OK' END AS state FROM p FULL JOIN s USING (feed)"""


def silent_rescore(spark, sf_dir):
    """Board checks: results that moved by over three standard errors between snapshots, and whether the overall is the mean of tracks."""
    l = table(spark, sf_dir, "lineitem").withColumn("snap", F.when(F.to_date("l_shipdate") < F.lit("1998-01-01").cast("date"), "old").otherwise("new"))
    s = l.groupBy("l_suppkey", "l_returnflag", "snap").agg(F.avg("l_quantity").alias("m"), F.var_samp("l_quantity").alias("v"), F.count("*").alias("n"))
    old, new = s.where("snap = 'old' and n > 1"), s.where("snap = 'new' and n > 1")
    j = old.select("l_suppkey", "l_returnflag", F.col("m").alias("m1"), (F.col("v") / F.col("n")).alias("e1")).join(
        new.select("l_suppkey", "l_returnflag", F.col("m").alias("m2"), (F.col("v") / F.col("n")).alias("e2")), ["l_suppkey", "l_returnflag"])
    return j.groupBy("l_suppkey").agg(
        F.count("*").alias("tracks"), F.count_if(F.abs(F.col("m2") - F.col("m1")) > 3 * F.sqrt(F.col("e1") + F.col("e2"))).alias("moved"),
        F.round(F.avg("m2"), 6).alias("overall"))


_RESCORE = """WITH s AS (SELECT l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) < DATE '1998-01-01' AS old, avg(l_quantity) AS m, var_samp(l_quantity) / count(*) AS e FROM lineitem GROUP BY ALL HAVING count(*) > 1)
SELECT a.l_suppkey, count(*) AS tracks, count(*) FILTER (WHERE abs(b.m - a.m) > 3 * sqrt(a.e + b.e)) AS moved, round(avg(b.m), 6) AS overall
FROM s a JOIN s b ON a.l_suppkey = b.l_suppkey AND a.l_returnflag = b.l_returnflag AND a.old AND NOT b.old GROUP BY a.l_suppkey"""


def event_reported(spark, sf_dir):
    """Earliest plausible member of each order as its reported day; ties by flag precedence, then line."""
    l = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("opened")), "l_orderkey")
    day = F.to_date("l_shipdate")
    rank = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    best = F.min(F.when(day >= F.date_sub("opened", 365), F.struct(day.alias("day"), rank.alias("rank"), F.col("l_partkey").alias("part"))))
    return l.groupBy("l_orderkey").agg(best.alias("b"), F.count("*").alias("members")).select("l_orderkey", F.col("b.day").alias("reported"), F.col("b.rank").alias("basis"), "members")


_REPORTED = """WITH l AS (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS day, CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS rank, l_partkey AS part,
  CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE) - 365 AS ok FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, arg_min(day, (day, rank, part)) FILTER (WHERE ok) AS reported, (arg_min(rank, (day, rank, part)) FILTER (WHERE ok))::INT AS basis, count(*) AS members FROM l GROUP BY l_orderkey"""


def top_categories(spark, sf_dir):
    """Per network the five most frequent parts and the five largest by quantity, ranked within their class."""
    l = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("q"))
    both = l.select("l_suppkey", "l_partkey", F.explode(F.array(
        F.struct(F.lit("rows").alias("class"), F.col("n").alias("v")), F.struct(F.lit("quantity").alias("class"), F.col("q").alias("v")))).alias("x")).select("l_suppkey", "l_partkey", "x.*")
    w = Window.partitionBy("l_suppkey", "class").orderBy(F.col("v").desc(), "l_partkey")
    return both.withColumn("k", F.row_number().over(w)).where("k <= 5").drop("v")


_TOP = """WITH l AS (SELECT l_suppkey, l_partkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY ALL),
b AS (SELECT l_suppkey, l_partkey, 'rows' AS class, n AS v FROM l UNION ALL SELECT l_suppkey, l_partkey, 'quantity', q FROM l)
SELECT l_suppkey, l_partkey, class, row_number() OVER (PARTITION BY l_suppkey, class ORDER BY v DESC, l_partkey) AS k FROM b QUALIFY k <= 5"""

QUERIES = {f.__name__: f for f in (
    phrase_join, threshold_choice, weighted_precision, sample_allocation, scan_pressure_mix, month_gate, watchdog_states, silent_rescore,
    event_reported, top_categories)}
ORACLE_SQL = dict(zip(QUERIES, (_PHRASE, _THRESHOLD, _WEIGHTED, _ALLOCATION, _MIX, _MONTHS, _WATCHDOG, _RESCORE, _REPORTED, _TOP)))
