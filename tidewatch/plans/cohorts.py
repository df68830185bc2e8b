"""Right-censored cohorts, lags, maturity, weekly and monthly tables, scan offsets, age mixes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.operators import windows
from tidewatch.plans.tables import ASSERTIONS, CENSORED, OBSERVATIONS, assertions, observations, table

def _censored():
    return F.lit(CENSORED).cast("date")


def _months(a, day: str):
    return F.year(day).alias("cohort_year"), F.month(day).alias("month_index")


def corpus_cohorts(spark, sf_dir):
    """Cumulative count by year and month of two metrics, up to the last complete month; zero months present."""
    a = assertions(spark, sf_dir)
    first = a.where("not withdrawn").groupBy("vuln").agg(F.min("added").alias("d"))
    both = first.select(F.lit("kev_entered").alias("metric"), "d").unionByName(
        a.select(F.lit("cves_published").alias("metric"), F.col("added").alias("d")))
    end = F.add_months(F.trunc(F.date_add(_censored(), 1), "month"), -1)
    counts = both.where(F.col("d") < F.add_months(end, 1)).groupBy("metric", F.trunc("d", "month").alias("m")).agg(F.count("*").alias("n"))
    grid = counts.groupBy("metric").agg(F.min("m").alias("lo")).select(
        "metric", F.explode(F.sequence(F.trunc("lo", "year"), end, F.expr("interval 1 month"))).alias("m"))
    w = Window.partitionBy("metric", "cohort_year").orderBy("month_index").rowsBetween(Window.unboundedPreceding, 0)
    d = grid.join(counts, ["metric", "m"], "left").select("metric", *_months(grid, "m"), F.coalesce("n", F.lit(0)).alias("n"))
    return d.select("metric", "cohort_year", "month_index", F.sum("n").over(w).alias("cumulative_count"))


_COHORTS = f"""WITH {ASSERTIONS}, b AS (
  SELECT 'kev_entered' AS metric, min(added) AS d FROM a WHERE NOT withdrawn GROUP BY vuln
  UNION ALL SELECT 'cves_published', added FROM a),
c AS (SELECT metric, date_trunc('month', d)::DATE AS m, count(*) AS n FROM b WHERE d < DATE '2001-01-01' GROUP BY ALL),
g AS (SELECT metric, unnest(generate_series(date_trunc('year', lo), DATE '2000-12-01', INTERVAL 1 MONTH))::DATE AS m
  FROM (SELECT metric, min(m) AS lo FROM c GROUP BY metric))
SELECT metric, year(m)::INT AS cohort_year, month(m)::INT AS month_index,
  (sum(coalesce(n, 0)) OVER (PARTITION BY metric, year(m) ORDER BY m))::BIGINT AS cumulative_count
FROM g LEFT JOIN c USING (metric, m)"""


def corpus_weekly(spark, sf_dir):
    """Two rows for each ISO week up to the last complete one before the censoring date, zero weeks too."""
    a = assertions(spark, sf_dir)
    last = F.date_sub(F.trunc(F.date_add(_censored(), 1), "week"), 7)
    weeks = spark.range(1).select(F.explode(F.sequence(F.lit("1997-01-06").cast("date"), last, F.expr("interval 7 days"))).alias("week"))
    metrics = F.array(F.lit("listed"), F.lit("withdrawn"))
    grid = weeks.select("week", F.explode(metrics).alias("metric"))
    counts = a.groupBy(F.to_date(F.date_trunc("week", "added")).alias("week"), F.when(F.col("withdrawn"), "withdrawn").otherwise("listed").alias("metric")).agg(
        F.count("*").alias("n"))
    return grid.join(counts, ["week", "metric"], "left").select("week", "metric", F.coalesce("n", F.lit(0)).alias("n"))


_WEEKLY = f"""WITH {ASSERTIONS}, g AS (SELECT unnest(generate_series(DATE '1997-01-06', DATE '2000-12-25', INTERVAL 7 DAY))::DATE AS week),
m AS (SELECT unnest(['listed', 'withdrawn']) AS metric),
c AS (SELECT date_trunc('week', added)::DATE AS week, CASE WHEN withdrawn THEN 'withdrawn' ELSE 'listed' END AS metric, count(*) AS n FROM a GROUP BY ALL)
SELECT week, metric, coalesce(n, 0) AS n FROM g CROSS JOIN m LEFT JOIN c USING (week, metric)"""


def _fixes(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(F.to_date("l_shipdate")).alias("published"))
    a = assertions(spark, sf_dir)
    return a.join(l.withColumnRenamed("l_orderkey", "entry"), "entry")


_FIX = f"""{ASSERTIONS}, l AS (SELECT l_orderkey AS entry, min(CAST(l_shipdate AS DATE)) AS published FROM lineitem GROUP BY 1),
f AS (SELECT * FROM a JOIN l USING (entry))"""


def lag_points(spark, sf_dir):
    """Per vulnerability: earliest publication, earliest live listing by the censoring date, lag and half years."""
    d = _fixes(spark, sf_dir).where(~F.col("withdrawn") & (F.col("added") <= _censored())).groupBy("vuln").agg(
        F.min("published").alias("published"), F.min("added").alias("listed"))
    half = lambda c: F.concat(F.year(c).cast("string"), F.when(F.month(c) <= 6, "H1").otherwise("H2"))
    return d.select("vuln", "published", "listed", F.datediff("listed", "published").alias("lag_days"),
                    half("published").alias("publication_half"), half("listed").alias("report_half"))


_LAG = f"""WITH {_FIX}, d AS (SELECT vuln, min(published) AS published, min(added) AS listed FROM f
  WHERE NOT withdrawn AND added <= DATE '{CENSORED}' GROUP BY vuln)
SELECT *, listed - published AS lag_days, year(published) || CASE WHEN month(published) <= 6 THEN 'H1' ELSE 'H2' END AS publication_half,
  year(listed) || CASE WHEN month(listed) <= 6 THEN 'H1' ELSE 'H2' END AS report_half FROM d"""


def severity_windows(spark, sf_dir):
    """Attacked within 90 and 180 days by price band and year; only cohorts with the whole window count as mature."""
    band = F.when(F.col("price") >= 300000, "critical").when(F.col("price") >= 200000, "high").when(F.col("price") >= 100000, "medium").otherwise("low")
    d = _fixes(spark, sf_dir).withColumn("band", band).withColumn("win", F.explode(F.array(F.lit(90), F.lit(180))))
    mature = F.datediff(_censored(), "published") >= F.col("win")
    hit = mature & (F.datediff("added", "published").between(0, F.col("win")))
    return d.groupBy("win", F.year("published").alias("cohort_year"), "band").agg(
        F.count("*").alias("published_all"), F.count_if(mature).alias("published_mature"), F.count_if(hit).alias("attacked")
    ).withColumn("per_10k", F.when(F.col("published_mature") > 0, F.round(F.col("attacked") * 10000 / F.col("published_mature"), 4)))


_SEVERITY = f"""WITH {_FIX}, d AS (SELECT *, CASE WHEN price >= 300000 THEN 'critical' WHEN price >= 200000 THEN 'high'
  WHEN price >= 100000 THEN 'medium' ELSE 'low' END AS band, unnest([90, 180]) AS win FROM f),
e AS (SELECT *, DATE '{CENSORED}' - published >= win AS mature, added - published BETWEEN 0 AND win AS hit FROM d)
SELECT win, year(published)::INT AS cohort_year, band, count(*) AS published_all, count(*) FILTER (WHERE mature) AS published_mature,
  count(*) FILTER (WHERE mature AND hit) AS attacked,
  CASE WHEN count(*) FILTER (WHERE mature) > 0 THEN round(count(*) FILTER (WHERE mature AND hit) * 10000 / count(*) FILTER (WHERE mature), 4) END AS per_10k
FROM e GROUP BY ALL"""


def patch_window_bands(spark, sf_dir):
    """emergency + out_of_band + scheduled make up all attacked within 90 days; maturity at 0, 29 and 90 days."""
    d = _fixes(spark, sf_dir).withColumn("lag", F.datediff("added", "published")).withColumn("age", F.datediff(_censored(), "published"))
    m = lambda n: F.round(F.count_if(F.col("age") >= n) / F.count("*"), 9).alias(f"maturity_{n}d")
    return d.groupBy(F.year("published").alias("cohort_year")).agg(
        F.count_if(F.col("lag") <= 0).alias("emergency"), F.count_if(F.col("lag").between(1, 29)).alias("out_of_band"),
        F.count_if(F.col("lag").between(30, 90)).alias("scheduled"), F.count_if(F.col("lag") <= 90).alias("attacked_within_90d"),
        m(0), m(29), m(90), F.bool_and(F.col("age") >= 90).alias("is_complete"))


_BANDS = f"""WITH {_FIX}, d AS (SELECT *, added - published AS lag, DATE '{CENSORED}' - published AS age FROM f)
SELECT year(published)::INT AS cohort_year, count(*) FILTER (WHERE lag <= 0) AS emergency, count(*) FILTER (WHERE lag BETWEEN 1 AND 29) AS out_of_band,
  count(*) FILTER (WHERE lag BETWEEN 30 AND 90) AS scheduled, count(*) FILTER (WHERE lag <= 90) AS attacked_within_90d,
  round(count(*) FILTER (WHERE age >= 0) / count(*), 9) AS maturity_0d, round(count(*) FILTER (WHERE age >= 29) / count(*), 9) AS maturity_29d,
  round(count(*) FILTER (WHERE age >= 90) / count(*), 9) AS maturity_90d, bool_and(age >= 90) AS is_complete
FROM d GROUP BY 1"""


def scan_offsets(spark, sf_dir):
    """Seven-day windows counted back from each sensor's own last day, not from the censoring date."""
    o = observations(spark, sf_dir)
    last = o.groupBy("source").agg(F.max("day").alias("anchor"))
    d = o.join(F.broadcast(last), "source").withColumn("window_offset", F.floor(F.datediff("anchor", "day") / 7).cast("int"))
    return d.where("window_offset < 8").groupBy("source", "window_offset").agg(
        F.sum("n").alias("attempts"), F.count_distinct("vuln").alias("vulns"), F.count_distinct("day").alias("days_covered"))


_OFFSETS = f"""WITH {OBSERVATIONS}, l AS (SELECT source, max(day) AS anchor FROM o GROUP BY source)
SELECT source, ((anchor - day) // 7)::INT AS window_offset, sum(n)::BIGINT AS attempts, count(DISTINCT vuln) AS vulns, count(DISTINCT day) AS days_covered
FROM o JOIN l USING (source) WHERE (anchor - day) // 7 < 8 GROUP BY ALL"""


def age_mix_topn(spark, sf_dir):
    """Attempts of each month's hundred busiest vulnerabilities by age of their listing."""
    o = table(spark, sf_dir, "orders").groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("month"), F.col("o_custkey").alias("vuln")).agg(
        F.count("*").alias("n"))
    first = assertions(spark, sf_dir).groupBy("vuln").agg(F.min("added").alias("d"))
    w = Window.partitionBy("month").orderBy(F.col("n").desc(), "vuln")
    top = o.withColumn("k", F.row_number().over(w)).where("k <= 100").join(first, "vuln")
    age = F.months_between("month", F.trunc("d", "month"))
    band = F.when(age < 12, "y0_1").when(age < 36, "y1_3").when(age < 60, "y3_5").otherwise("over_5y")
    allm = Window.partitionBy("month")
    return top.withColumn("band", band).groupBy("month", "band").agg(F.sum("n").alias("attempts"), F.count("*").alias("cve_count")).withColumn(
        "population_attempts", F.sum("attempts").over(allm))


_AGE = f"""WITH {ASSERTIONS}, o AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, o_custkey AS vuln, count(*) AS n FROM orders GROUP BY ALL),
f AS (SELECT vuln, min(added) AS d FROM a GROUP BY vuln),
t AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY month ORDER BY n DESC, vuln) <= 100),
b AS (SELECT month, n, (year(month) - year(d)) * 12 + month(month) - month(d) AS age FROM t JOIN f USING (vuln)),
g AS (SELECT month, CASE WHEN age < 12 THEN 'y0_1' WHEN age < 36 THEN 'y1_3' WHEN age < 60 THEN 'y3_5' ELSE 'over_5y' END AS band,
  sum(n)::BIGINT AS attempts, count(*) AS cve_count FROM b GROUP BY ALL)
SELECT *, (sum(attempts) OVER (PARTITION BY month))::BIGINT AS population_attempts FROM g"""


def activity_trailing(spark, sf_dir):
    """Daily counts of the trailing 14 days of the feed, anchored at its own last day."""
    o = observations(spark, sf_dir)
    last = o.agg(F.max("day").alias("anchor"))
    return o.crossJoin(F.broadcast(last)).where(F.datediff("anchor", "day") < 14).groupBy("vuln", "day").agg(F.sum("n").alias("n"))


_TRAILING = f"""WITH {OBSERVATIONS} SELECT vuln, day, sum(n)::BIGINT AS n FROM o WHERE (SELECT max(day) FROM o) - day < 14 GROUP BY ALL"""


def pressure_ratio(spark, sf_dir):
    """Three months' volume against the same months a year before, by list."""
    a = assertions(spark, sf_dir)
    m = a.groupBy("source", F.trunc("added", "month").alias("month")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("source").orderBy("month").rowsBetween(-2, 0)
    d = m.withColumn("q", F.sum("n").over(w))
    before = d.select("source", F.add_months("month", 12).alias("month"), F.col("q").alias("prior"))
    return d.join(before, ["source", "month"]).select("source", "month", F.col("q").alias("observed"), "prior", F.round(F.col("q") / F.col("prior"), 9).alias("ratio"))


_PRESSURE = f"""WITH {ASSERTIONS}, m AS (SELECT source, date_trunc('month', added)::DATE AS month, count(*) AS n FROM a GROUP BY ALL),
d AS (SELECT source, month, (sum(n) OVER (PARTITION BY source ORDER BY month ROWS 2 PRECEDING))::BIGINT AS q FROM m)
SELECT d.source, d.month, d.q AS observed, b.q AS prior, round(d.q / b.q, 9) AS ratio FROM d JOIN d b
  ON d.source = b.source AND d.month = (b.month + INTERVAL 12 MONTH)::DATE"""


def yoy_chart_check(spark, sf_dir):
    """Running total by year, and each month against the median of the twelve before it."""
    m = assertions(spark, sf_dir).groupBy(F.trunc("added", "month").alias("month")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(F.year("month")).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    past = m.select(F.col("month").alias("pm"), F.col("n").alias("pn"))
    med = (
        m.withColumn("pm", F.explode(F.sequence(F.add_months("month", -12), F.add_months("month", -1), F.expr("interval 1 month"))))
        .join(past, "pm").groupBy("month").agg(F.percentile("pn", 0.5).alias("median_12m")))
    return m.withColumn("running_total", F.sum("n").over(w)).join(med, "month", "left")


_YOY = f"""WITH {ASSERTIONS}, m AS (SELECT date_trunc('month', added)::DATE AS month, count(*) AS n FROM a GROUP BY ALL)
SELECT month, n, (sum(n) OVER (PARTITION BY year(month) ORDER BY month))::BIGINT AS running_total,
  (SELECT quantile_cont(p.n, 0.5) FROM m p WHERE p.month >= m.month - INTERVAL 12 MONTH AND p.month < m.month) AS median_12m FROM m"""


def settle_late_share(spark, sf_dir):
    """Share of a day's rows that arrive later than each delay: how long a window must wait."""
    l = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    late = F.datediff("l_shipdate", "o_orderdate")
    d = l.where(late >= 0).withColumn("late", late)
    rows = F.explode(F.array(*[F.lit(n) for n in (1, 3, 7, 14, 30, 365)])).alias("delay")
    return d.select("late", rows).groupBy("delay").agg(
        F.count("*").alias("n_rows"), F.round(F.count_if(F.col("late") > F.col("delay")) / F.count("*"), 9).alias("late_share"))


_SETTLE = """WITH d AS (SELECT CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS late FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
e AS (SELECT late, unnest([1, 3, 7, 14, 30, 365]) AS delay FROM d WHERE late >= 0)
SELECT delay, count(*) AS n_rows, round(count(*) FILTER (WHERE late > delay) / count(*), 9) AS late_share FROM e GROUP BY delay"""


def gap_days(spark, sf_dir):
    return windows.missing_days(observations(spark, sf_dir).select("source", "vuln", "day"), ["source", "vuln"], "day")


_GAPS = f"""WITH {OBSERVATIONS}, s AS (SELECT source, vuln, min(day) AS lo, max(day) AS hi FROM o GROUP BY ALL),
e AS (SELECT source, vuln, unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS day FROM s)
SELECT * FROM e ANTI JOIN o USING (source, vuln, day)"""


def anchored_episodes(spark, sf_dir):
    a = assertions(spark, sf_dir)
    return windows.anchored_episodes(a, ["vuln"], "added", 90)


_EPISODES = f"""WITH RECURSIVE {ASSERTIONS}, f AS (
  SELECT vuln, 1 AS episode, min(added) AS first_day FROM a GROUP BY vuln
  UNION ALL SELECT f.vuln, f.episode + 1, (SELECT min(added) FROM a WHERE a.vuln = f.vuln AND a.added > f.first_day + 90) FROM f
  WHERE EXISTS (SELECT 1 FROM a WHERE a.vuln = f.vuln AND a.added > f.first_day + 90))
SELECT f.vuln, episode, first_day, max(added) AS last_day, count(*) AS n FROM f JOIN a ON a.vuln = f.vuln AND a.added BETWEEN first_day AND first_day + 90
GROUP BY ALL"""


def epss_lifecycle(spark, sf_dir):
    """Daily share of errors among a user's events as the score; the model changes mid-month."""
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("cve"), F.to_date("ts").alias("day")).agg(
        F.round(F.count_if(F.col("event_type") == "error") / F.count("*"), 9).alias("score"))
    e = e.withColumn("model", F.when(F.col("day") < F.lit("2024-01-16").cast("date"), "v1").otherwise("v2"))
    return windows.score_life_cycle(e, "cve", "day", "score", "model", hold=3)


_LIFECYCLE = """WITH e AS (SELECT user_id AS cve, CAST(ts AS DATE) AS day, round(count(*) FILTER (WHERE event_type = 'error') / count(*), 9) AS score FROM events GROUP BY ALL),
m AS (SELECT *, CASE WHEN day < DATE '2024-01-16' THEN 'v1' ELSE 'v2' END AS model, CASE WHEN score >= 0.1 THEN 1 WHEN score < 0.07 THEN 0 END AS side FROM e),
d AS (SELECT *, row_number() OVER w AS seq, lag(score) OVER w AS prev, lag(model) OVER w AS pmodel,
  last_value(side IGNORE NULLS) OVER (PARTITION BY cve ORDER BY day ROWS UNBOUNDED PRECEDING) AS run FROM m WINDOW w AS (PARTITION BY cve ORDER BY day)),
t AS (SELECT *, CASE WHEN coalesce(lag(run) OVER (PARTITION BY cve ORDER BY day), -1) <> coalesce(run, -1) THEN 1 ELSE 0 END AS turn FROM d),
i AS (SELECT *, sum(turn) OVER (PARTITION BY cve ORDER BY day ROWS UNBOUNDED PRECEDING) AS island FROM t),
g AS (SELECT cve, island, run, count(*) AS len, min(seq) AS seq, arg_min(day, seq) AS day, arg_min(score, seq) AS score,
  arg_min(struct_pack(p := prev), seq).p AS prev, arg_min(model, seq) AS model, arg_min(struct_pack(p := pmodel), seq).p AS pmodel
  FROM i WHERE run IS NOT NULL GROUP BY ALL),
k AS (SELECT *, coalesce(lag(run) OVER (PARTITION BY cve ORDER BY island), 0) AS state FROM g WHERE len >= 3 OR (seq = 1 AND run = 1))
SELECT cve, day, CASE WHEN run = 1 THEN 'rise' ELSE 'fall' END AS direction, score, prev AS previous_score,
  CASE WHEN seq = 1 AND day = (SELECT min(day) FROM e) THEN 'already_high' WHEN seq = 1 THEN 'first_scored'
       WHEN pmodel <> model THEN 'model_change' ELSE 'organic' END AS cause FROM k WHERE run <> state"""


def head_retention(spark, sf_dir):
    """How much of each day's top twenty is in the next day's, and how long the lists are."""
    o = observations(spark, sf_dir).groupBy("day", "vuln").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("day").orderBy(F.col("n").desc(), "vuln")
    top = o.withColumn("k", F.row_number().over(w)).where("k <= 20").select("day", "vuln")
    nxt = top.select(F.date_sub("day", 1).alias("day"), "vuln", F.lit(1).alias("kept"))
    size = o.groupBy("day").agg(F.count("*").alias("list_length"))
    return top.join(nxt, ["day", "vuln"], "left").groupBy("day").agg(F.count("*").alias("head"), F.count("kept").alias("retained")).join(size, "day")


_HEAD = f"""WITH {OBSERVATIONS}, d AS (SELECT day, vuln, sum(n) AS n FROM o GROUP BY ALL),
t AS (SELECT day, vuln FROM d QUALIFY row_number() OVER (PARTITION BY day ORDER BY n DESC, vuln) <= 20)
SELECT t.day, count(*) AS head, count(x.vuln) AS retained, any_value(list_length) AS list_length
FROM t LEFT JOIN t x ON x.day = t.day + 1 AND x.vuln = t.vuln JOIN (SELECT day, count(*) AS list_length FROM d GROUP BY day) s ON s.day = t.day GROUP BY t.day"""


def list_volatility(spark, sf_dir):
    """Changes of a list between consecutive days: symmetric difference over union."""
    o = observations(spark, sf_dir).where("source = 'error'").select("day", "vuln").distinct()
    n = o.groupBy("day").agg(F.count("*").alias("n"))
    both = o.join(o.select(F.date_sub("day", 1).alias("day"), "vuln"), ["day", "vuln"]).groupBy("day").agg(F.count("*").alias("m"))
    nxt = n.select(F.date_sub("day", 1).alias("day"), F.col("n").alias("n2"))
    d = n.join(nxt, "day").join(both, "day", "left").withColumn("m", F.coalesce("m", F.lit(0)))
    union = F.col("n") + F.col("n2") - F.col("m")
    return d.select("day", "n", "n2", F.round((union - F.col("m")) / union, 9).alias("volatility"))


_VOLATILITY = f"""WITH {OBSERVATIONS}, l AS (SELECT DISTINCT day, vuln FROM o WHERE source = 'error'), n AS (SELECT day, count(*) AS n FROM l GROUP BY day),
b AS (SELECT l.day, count(*) AS m FROM l JOIN l x ON x.day = l.day + 1 AND x.vuln = l.vuln GROUP BY l.day)
SELECT n.day, n.n, y.n AS n2, round((n.n + y.n - 2 * coalesce(m, 0)) / (n.n + y.n - coalesce(m, 0)), 9) AS volatility
FROM n JOIN n y ON y.day = n.day + 1 LEFT JOIN b ON b.day = n.day"""

QUERIES = {f.__name__: f for f in (
    corpus_cohorts, corpus_weekly, lag_points, severity_windows, patch_window_bands, scan_offsets, age_mix_topn, activity_trailing,
    pressure_ratio, yoy_chart_check, settle_late_share, gap_days, anchored_episodes, epss_lifecycle, head_retention, list_volatility)}
ORACLE_SQL = dict(zip(QUERIES, (
    _COHORTS, _WEEKLY, _LAG, _SEVERITY, _BANDS, _OFFSETS, _AGE, _TRAILING, _PRESSURE, _YOY, _SETTLE, _GAPS, _EPISODES, _LIFECYCLE,
    _HEAD, _VOLATILITY)))
