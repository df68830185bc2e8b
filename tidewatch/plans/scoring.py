"""The twelve-rule scorecard, technology and evidence tables, combined scan tables, score summaries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.operators import windows
from tidewatch.plans import cohorts
from tidewatch.plans.tables import ASSERTIONS, CENSORED, OBSERVATIONS, assertions, observations, table

DAY = lambda s: F.lit(s).cast("date")
MONTH, NEXT = "1998-01-01", "1998-02-01"

#: (rule, kind, condition over score, severity and the list columns); fixed values of the method, in its order.
RULES = [
    ("all", "reference", "true"), ("cvss7", "single", "cvss >= 7"), ("cvss9", "single", "cvss >= 9"), ("epss1", "single", "epss >= 0.01"),
    ("epss3", "single", "epss >= 0.03"), ("epss10", "single", "epss >= 0.10"), ("cisa", "single", "cisa"), ("kev", "single", "kev"),
    ("lane", "lane", "kev OR epss >= 0.10"), ("pick", "pick", "kev OR epss >= 0.03"),
    ("extra", "extra", "kev OR epss >= 0.03 OR (epss >= 0.02 AND cvss >= 9)"), ("epss2", "hidden", "epss >= 0.02"),
]


def _population(spark, sf_dir):
    """One wide row per vulnerability: scores on both days, severity, lists on both days, attacks.

    A score of the first day exists for customers known by an order before it; cvss comes from the balance.
    """
    a = assertions(spark, sf_dir)
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("vuln"), F.round((F.col("c_acctbal") + 1000) / 1100, 1).alias("cvss"))
    cut = lambda d: [F.count_if(F.col("added") < DAY(d)).alias("n"), F.bool_or((F.col("added") < DAY(d)) & (F.col("source") == "1-URGENT")).alias("cisa"),
                     F.bool_or((F.col("added") < DAY(d)) & F.col("source").isin("1-URGENT", "2-HIGH")).alias("kev"),
                     F.bool_or((F.col("added") < DAY(d)) & F.col("source").isin("1-URGENT", "2-HIGH") & ~F.col("withdrawn")).alias("clean")]
    s0 = a.groupBy("vuln").agg(*[x.alias(f"{n}0") for x, n in zip(cut(MONTH), ("n", "cisa", "kev", "clean"))])
    s1 = a.groupBy("vuln").agg(*[x.alias(f"{n}1") for x, n in zip(cut(NEXT), ("n", "cisa", "kev", "clean"))])
    o = observations(spark, sf_dir).groupBy("vuln").agg(
        F.bool_or(F.col("day") >= DAY("2024-01-15")).alias("attacked"), F.bool_or(F.col("day") < DAY("2024-01-15")).alias("before"))
    d = c.join(s0, "vuln", "left").join(s1, "vuln", "left").join(o, "vuln", "left")
    no = F.lit(False)
    score = lambda n: F.when(F.col(n) > 0, F.col(n) / (F.col(n) + 60))
    return d.select(
        "vuln", "cvss", score("n0").alias("epss0"), score("n1").alias("epss1"),
        *[F.coalesce(f"{n}{k}", no).alias(f"{n}{k}") for n in ("cisa", "kev", "clean") for k in (0, 1)],
        (F.coalesce("attacked", no) & (F.coalesce("n0", F.lit(0)) > 0)).alias("attacked"), F.coalesce("before", no).alias("before"))


_POPULATION = f"""{ASSERTIONS}, {OBSERVATIONS},
l AS (SELECT vuln, """ + ", ".join(
    f"count(*) FILTER (WHERE added < DATE '{d}') AS n{k}, bool_or(added < DATE '{d}' AND source = '1-URGENT') AS cisa{k}, "
    f"bool_or(added < DATE '{d}' AND source IN ('1-URGENT', '2-HIGH')) AS kev{k}, "
    f"bool_or(added < DATE '{d}' AND source IN ('1-URGENT', '2-HIGH') AND NOT withdrawn) AS clean{k}" for k, d in enumerate((MONTH, NEXT))) + """ FROM a GROUP BY vuln),
s AS (SELECT vuln, bool_or(day >= DATE '2024-01-15') AS attacked, bool_or(day < DATE '2024-01-15') AS before FROM o GROUP BY vuln),
w AS (SELECT c_custkey AS vuln, round((c_acctbal + 1000) / 1100, 1) AS cvss, CASE WHEN n0 > 0 THEN n0 / (n0 + 60) END AS epss0, CASE WHEN n1 > 0 THEN n1 / (n1 + 60) END AS epss1, """ + ", ".join(
    f"coalesce({n}{k}, false) AS {n}{k}" for n in ("cisa", "kev", "clean") for k in (0, 1)) + """,
  coalesce(attacked, false) AND coalesce(n0, 0) > 0 AS attacked, coalesce(before, false) AS before
  FROM customer LEFT JOIN l ON l.vuln = c_custkey LEFT JOIN s ON s.vuln = c_custkey)"""


def _on(condition: str, k: int, clean: bool = False) -> str:
    """The rule's condition on day ``k``, cut to the vulnerabilities that have a score that day."""
    lists = condition.replace("kev", f"clean{k}" if clean else f"kev{k}").replace("cisa", f"cisa{k}")
    return f"(epss{k} IS NOT NULL AND ({lists.replace('epss >=', f'epss{k} >=')}))"


def rule_scorecard(spark, sf_dir):
    """All twelve rules of a month: what they list, add, hit of all and of newly attacked ones, and hit with clean lists only."""
    w = _population(spark, sf_dir)
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(kind).alias("kind"), F.expr(_on(c, 0)).alias("s0"), F.expr(_on(c, 1)).alias("s1"),
                               F.expr(_on(c, 0, True)).alias("clean")) for n, kind, c in RULES])
    new = F.col("attacked") & ~F.col("before")
    return w.select("attacked", "before", F.explode(rules).alias("r")).select("attacked", "before", "r.*").groupBy("rule", "kind").agg(
        F.count_if(F.col("s1") & ~F.col("s0")).alias("added"), F.count_if("s0").alias("backlog"), F.count_if(F.col("s0") & F.col("attacked")).alias("hit_all"),
        F.count_if(F.col("s0") & new).alias("hit_new"), F.count_if(F.col("clean") & new).alias("hit_new_clean"))


_SCORECARD = f"WITH {_POPULATION}, x AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS rule, '{kind}' AS kind, {_on(c, 0)} AS s0, {_on(c, 1)} AS s1, {_on(c, 0, True)} AS clean, attacked, before FROM w" for n, kind, c in RULES) + """)
SELECT rule, kind, count(*) FILTER (WHERE s1 AND NOT s0) AS added, count(*) FILTER (WHERE s0) AS backlog, count(*) FILTER (WHERE s0 AND attacked) AS hit_all,
  count(*) FILTER (WHERE s0 AND attacked AND NOT before) AS hit_new, count(*) FILTER (WHERE clean AND attacked AND NOT before) AS hit_new_clean FROM x GROUP BY rule, kind"""

_COND = {n: c for n, _, c in RULES}
_LANES = {k: _on(_COND[n], d) for k, n, d in (("p0", "pick", 0), ("p1", "pick", 1), ("l0", "lane", 0), ("l1", "lane", 1))}


def rule_lanes(spark, sf_dir):
    """Of what the recommended rule adds in a month: urgent and regular ones; and listed ones that turned urgent."""
    w = _population(spark, sf_dir).select("attacked", "before", *[F.expr(c).alias(k) for k, c in _LANES.items()])
    p0, p1, l0, l1 = (F.col(k) for k in ("p0", "p1", "l0", "l1"))
    return w.agg(F.count_if(p1 & ~p0 & l1).alias("urgent"), F.count_if(p1 & ~p0 & ~l1).alias("regular"), F.count_if(p0 & p1 & l1 & ~l0).alias("turned"),
                 F.count_if("attacked").alias("attacked_all"), F.count_if(F.col("attacked") & ~F.col("before")).alias("attacked_new"))


_LANES_SQL = f"WITH {_POPULATION}, x AS (SELECT attacked, before, " + ", ".join(f"{c} AS {k}" for k, c in _LANES.items()) + """ FROM w)
SELECT count(*) FILTER (WHERE p1 AND NOT p0 AND l1) AS urgent, count(*) FILTER (WHERE p1 AND NOT p0 AND NOT l1) AS regular, count(*) FILTER (WHERE p0 AND p1 AND l1 AND NOT l0) AS turned,
  count(*) FILTER (WHERE attacked) AS attacked_all, count(*) FILTER (WHERE attacked AND NOT before) AS attacked_new FROM x"""

#: (tier, category, condition on part, the lower tier decides); fixed order.
TIERS = [("registry", "p_type = 'STANDARD'", "standard"), ("catalogue", "p_size >= 40", "large"), ("sensor", "p_retailprice >= 1500", "dear"),
         ("inferred", "p_name LIKE '%ring%'", "rings")]


def technology_of(spark, sf_dir):
    """One category per part: the strongest evidence decides, ties by category; what no rule names is assumed 'other'."""
    rules = F.array(*[F.when(F.expr(c), F.struct(F.lit(k).alias("tier"), F.lit(name).alias("category"), F.lit(t).alias("evidence"))) for k, (t, c, name) in enumerate(TIERS)])
    best = F.array_min(F.array_compact(rules))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.coalesce(best["category"], F.lit("other")).alias("category"), F.coalesce(best["evidence"], F.lit("assumed")).alias("evidence"))


_CASE = lambda pick: "CASE " + " ".join(f"WHEN {c} THEN '{pick(t, n)}'" for t, c, n in TIERS)
_TECH = f"t AS (SELECT p_partkey, {_CASE(lambda t, n: n)} ELSE 'other' END AS category, {_CASE(lambda t, n: t)} ELSE 'assumed' END AS evidence FROM part)"


def technology_cohorts(spark, sf_dir):
    """Lines shipped per year and category over the six years up to the last complete month; the last year may be partial."""
    l = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.to_date("l_shipdate").alias("day"))
    edge = l.agg(F.trunc(F.max("day"), "month").alias("edge"))
    d = l.crossJoin(F.broadcast(edge)).where((F.col("day") < F.col("edge")) & (F.year("day") > F.year("edge") - 6))
    return d.join(technology_of(spark, sf_dir), "p_partkey").groupBy(F.year("day").alias("year"), "category").agg(
        F.count("*").alias("lines"), F.count_if(F.col("evidence").isin("registry", "catalogue")).alias("stated"),
        F.max(F.month("day")).alias("last_month"))


_COHORTS = f"""WITH {_TECH}, l AS (SELECT l_partkey AS p_partkey, CAST(l_shipdate AS DATE) AS day FROM lineitem), e AS (SELECT date_trunc('month', max(day))::DATE AS edge FROM l)
SELECT year(day)::INT AS year, category, count(*) AS lines, count(*) FILTER (WHERE evidence IN ('registry', 'catalogue')) AS stated, max(month(day))::INT AS last_month
FROM l JOIN t USING (p_partkey), e WHERE day < edge AND year(day) > year(edge) - 6 GROUP BY year(day), category"""


def evidence_coverage(spark, sf_dir):
    """Share of each evidence tier among parts and among shipped lines."""
    t = technology_of(spark, sf_dir)
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("lines"))
    g = t.join(n, "p_partkey", "left").groupBy("evidence").agg(F.count("*").alias("parts"), F.sum(F.coalesce("lines", F.lit(0))).alias("lines"))
    total = g.agg(F.sum("parts").alias("tp"), F.sum("lines").alias("tl"))
    return g.crossJoin(F.broadcast(total)).select(
        "evidence", "parts", "lines", F.round(100 * F.col("parts") / F.col("tp"), 6).alias("part_share"), F.round(100 * F.col("lines") / F.col("tl"), 6).alias("line_share"))


_COVERAGE = f"""WITH {_TECH}, n AS (SELECT l_partkey AS p_partkey, count(*) AS lines FROM lineitem GROUP BY 1),
g AS (SELECT evidence, count(*) AS parts, sum(coalesce(lines, 0))::BIGINT AS lines FROM t LEFT JOIN n USING (p_partkey) GROUP BY evidence)
SELECT evidence, parts, lines, round(100 * parts / sum(parts) OVER (), 6) AS part_share, round(100 * lines / sum(lines) OVER (), 6) AS line_share FROM g"""


def listed_technology(spark, sf_dir):
    """Per year the listed parts by category in two scopes, all and emergency (urgent orders), with shares and whether emergency is within all."""
    a = assertions(spark, sf_dir).select(F.col("entry").alias("l_orderkey"), F.year("added").alias("year"), "source")
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    d = a.join(l, "l_orderkey").join(technology_of(spark, sf_dir), "p_partkey")
    scopes = F.when(F.col("source") == "1-URGENT", F.array(F.lit("all"), F.lit("emergency"))).otherwise(F.array(F.lit("all")))
    n = d.select("year", "category", "p_partkey", F.explode(scopes).alias("scope")).groupBy("scope", "year", "category").agg(F.count_distinct("p_partkey").alias("n"))
    total = n.groupBy("scope", "year").agg(F.sum("n").alias("t"))
    upper = n.where("scope = 'all'").select("year", "category", F.col("n").alias("n_all"))
    return n.join(total, ["scope", "year"]).join(upper, ["year", "category"], "left").select(
        "scope", "year", "category", "n", F.round(100 * F.col("n") / F.col("t"), 6).alias("share"), (F.col("n") <= F.col("n_all")).alias("within_all"))


_LISTED = f"""WITH {_TECH}, d AS (SELECT year(o_orderdate)::INT AS year, category, p_partkey, o_orderpriority = '1-URGENT' AS e FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN t ON p_partkey = l_partkey),
n AS (SELECT 'all' AS scope, year, category, count(DISTINCT p_partkey) AS n FROM d GROUP BY ALL UNION ALL SELECT 'emergency', year, category, count(DISTINCT p_partkey) FROM d WHERE e GROUP BY ALL)
SELECT scope, year, category, n, round(100 * n / sum(n) OVER (PARTITION BY scope, year), 6) AS share,
  n <= max(CASE WHEN scope = 'all' THEN n END) OVER (PARTITION BY year, category) AS within_all FROM n"""


def scan_pressure_combined(spark, sf_dir):
    """Eight weeks back from the last day that two sensors both cover; a vulnerability counts where both networks are complete.

    The second network (clicks) stands in a week only for vulnerabilities that it saw in it.
    """
    o = observations(spark, sf_dir).where("source in ('view', 'click')")
    anchor = o.groupBy("source").agg(F.max("day").alias("last")).agg(F.min("last").alias("anchor"))
    w = o.crossJoin(F.broadcast(anchor)).withColumn("offset", F.floor(F.datediff("anchor", "day") / 7)).where("offset between 0 and 7")
    both = w.groupBy("offset").agg(F.count_distinct("source").alias("networks")).where("networks = 2").select("offset")
    return w.join(both, "offset").groupBy("offset", "vuln").agg(
        F.sum(F.when(F.col("source") == "view", F.col("n")).otherwise(0)).alias("first_network"), F.sum(F.when(F.col("source") == "click", F.col("n"))).alias("second_network"))


_COMBINED = f"""WITH {OBSERVATIONS}, x AS (SELECT * FROM o WHERE source IN ('view', 'click')), a AS (SELECT min(l) AS anchor FROM (SELECT max(day) AS l FROM x GROUP BY source)),
w AS (SELECT *, ((anchor - day) // 7)::BIGINT AS "offset" FROM x, a WHERE day <= anchor AND anchor - day < 56),
b AS (SELECT "offset" FROM w GROUP BY 1 HAVING count(DISTINCT source) = 2)
SELECT "offset", vuln, coalesce(sum(n) FILTER (WHERE source = 'view'), 0)::BIGINT AS first_network, (sum(n) FILTER (WHERE source = 'click'))::BIGINT AS second_network
FROM w SEMI JOIN b USING ("offset") GROUP BY "offset", vuln"""


def scan_age_combined(spark, sf_dir):
    """Attempts per month, network and age of the vulnerability in four bands, over the month's hundred most tried ones in both networks together."""
    l = table(spark, sf_dir, "lineitem").where("l_returnflag in ('A', 'N')").select(
        F.trunc("l_shipdate", "month").alias("month"), F.col("l_returnflag").alias("network"), F.col("l_partkey").alias("vuln"), "l_linenumber")
    n = l.groupBy("month", "network", "vuln").agg(F.count("*").alias("n"), F.min("l_linenumber").alias("age"))
    total = n.groupBy("month", "vuln").agg(F.sum("n").alias("t"))
    rank = F.row_number().over(Window.partitionBy("month").orderBy(F.desc("t"), "vuln"))
    top = total.withColumn("k", rank).where("k <= 100").select("month", "vuln")
    band = F.when(F.col("age") <= 1, "y0_1").when(F.col("age") <= 3, "y1_3").when(F.col("age") <= 5, "y3_5").otherwise("over_5y")
    return n.join(top, ["month", "vuln"]).groupBy("month", "network", band.alias("band")).agg(F.sum("n").alias("attempts"), F.count("*").alias("vulns"))


_AGE = """WITH n AS (SELECT date_trunc('month', l_shipdate)::DATE AS month, l_returnflag AS network, l_partkey AS vuln, count(*) AS n, min(l_linenumber) AS age FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY ALL),
t AS (SELECT month, vuln FROM n GROUP BY month, vuln QUALIFY row_number() OVER (PARTITION BY month ORDER BY sum(n) DESC, vuln) <= 100)
SELECT month, network, CASE WHEN age <= 1 THEN 'y0_1' WHEN age <= 3 THEN 'y1_3' WHEN age <= 5 THEN 'y3_5' ELSE 'over_5y' END AS band, sum(n)::BIGINT AS attempts, count(*) AS vulns
FROM n JOIN t USING (month, vuln) GROUP BY ALL"""


def activity_ninety(spark, sf_dir):
    """Daily sightings of the ninety days up to each sensor's own last day; zero and older rows are refused."""
    o = observations(spark, sf_dir)
    last = o.groupBy("source").agg(F.max("day").alias("last"))
    return o.join(F.broadcast(last), "source").where((F.datediff("last", "day") < 90) & (F.col("n") > 0)).groupBy("source", "day").agg(
        F.sum("n").alias("attempts"), F.count_distinct("vuln").alias("vulns"))


_ACTIVITY = f"""WITH {OBSERVATIONS}, l AS (SELECT source, max(day) AS last FROM o GROUP BY 1)
SELECT source, day, sum(n)::BIGINT AS attempts, count(DISTINCT vuln) AS vulns FROM o JOIN l USING (source) WHERE last - day < 90 AND n > 0 GROUP BY ALL"""


def explorer_list(spark, sf_dir):
    """Vulnerabilities that are listed or were sighted, with their listing sources and sensors apart from each other."""
    a = assertions(spark, sf_dir).where(~F.col("withdrawn") & (F.col("added") <= DAY(CENSORED))).groupBy("vuln").agg(
        F.min("added").alias("first_listed"), F.concat_ws(",", F.array_sort(F.collect_set("source"))).alias("listed_by"))
    o = observations(spark, sf_dir).groupBy("vuln").agg(F.sum("n").alias("sightings"), F.concat_ws(",", F.array_sort(F.collect_set("source"))).alias("sensors"))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("vuln"), F.col("c_mktsegment").alias("segment")).join(a, "vuln", "left").join(
        o, "vuln", "left").where("first_listed is not null or sightings > 0")


_EXPLORER = f"""WITH {ASSERTIONS}, {OBSERVATIONS},
l AS (SELECT vuln, min(added) AS first_listed, string_agg(DISTINCT source, ',' ORDER BY source) AS listed_by FROM a WHERE NOT withdrawn AND added <= DATE '{CENSORED}' GROUP BY vuln),
s AS (SELECT vuln, sum(n)::BIGINT AS sightings, string_agg(DISTINCT source, ',' ORDER BY source) AS sensors FROM o GROUP BY vuln)
SELECT c_custkey AS vuln, c_mktsegment AS segment, first_listed, listed_by, sightings, sensors FROM customer LEFT JOIN l ON l.vuln = c_custkey LEFT JOIN s ON s.vuln = c_custkey
WHERE first_listed IS NOT NULL OR sightings > 0"""


def _daily_scores(spark, sf_dir):
    """Daily share of errors among a user's events as the score; the model changes mid-month."""
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("cve"), F.to_date("ts").alias("day")).agg(
        F.round(F.count_if(F.col("event_type") == "error") / F.count("*"), 9).alias("score"))
    return e.withColumn("model", F.when(F.col("day") < DAY("2024-01-16"), "v1").otherwise("v2"))


def score_transitions(spark, sf_dir):
    """Turns of a score that held for seven scores, as the contract says (epss_lifecycle takes three)."""
    return windows.score_life_cycle(_daily_scores(spark, sf_dir), "cve", "day", "score", "model")


_TRANSITIONS = cohorts.ORACLE_SQL["epss_lifecycle"].replace("len >= 3", "len >= 7")


def score_summary(spark, sf_dir):
    """Per vulnerability: first, last and highest score, and whether it is confirmed high by its last turn."""
    s = _daily_scores(spark, sf_dir)
    t = score_transitions(spark, sf_dir).groupBy("cve").agg(F.max_by("direction", "day").alias("last_turn"), F.count("*").alias("turns"))
    g = s.groupBy("cve").agg(F.count("*").alias("scores"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.max("score").alias("highest"))
    return g.join(t, "cve", "left").select("*", F.coalesce(F.col("last_turn") == "rise", F.lit(False)).alias("confirmed_high"))


_SUMMARY = f"""WITH x AS ({_TRANSITIONS}), t AS (SELECT cve, arg_max(direction, day) AS last_turn, count(*) AS turns FROM x GROUP BY cve),
s AS (SELECT user_id AS cve, CAST(ts AS DATE) AS day, round(count(*) FILTER (WHERE event_type = 'error') / count(*), 9) AS score FROM events GROUP BY ALL),
g AS (SELECT cve, count(*) AS scores, min(day) AS first_day, max(day) AS last_day, max(score) AS highest FROM s GROUP BY cve)
SELECT g.*, last_turn, turns, coalesce(last_turn = 'rise', false) AS confirmed_high FROM g LEFT JOIN t USING (cve)"""


def hysteresis_contract(spark, sf_dir):
    """Networks listed at fifty or more, or at thirty-five if the half-year before listed them: the contract's limits."""
    l = table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("day"))
    half = lambda lo, hi: l.where((F.col("day") >= DAY(lo)) & (F.col("day") < DAY(hi))).groupBy("l_suppkey").agg(F.count("*").alias("n"))
    before = half("1997-01-01", "1997-07-01").where("n >= 50")
    return windows.hysteresis(half("1997-07-01", "1998-01-01"), "l_suppkey", "n", before)


_HYSTERESIS = """WITH n AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) < DATE '1997-07-01' AS early, count(*) AS n FROM lineitem
  WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1998-01-01' GROUP BY ALL), b AS (SELECT l_suppkey, true AS was FROM n WHERE early AND n >= 50)
SELECT l_suppkey, n, n >= CASE WHEN was THEN 35 ELSE 50 END AS listed FROM n LEFT JOIN b USING (l_suppkey) WHERE NOT early"""

QUERIES = {f.__name__: f for f in (
    rule_scorecard, rule_lanes, technology_of, technology_cohorts, evidence_coverage, listed_technology, scan_pressure_combined, scan_age_combined,
    activity_ninety, explorer_list, score_transitions, score_summary, hysteresis_contract)}
ORACLE_SQL = dict(zip(QUERIES, (
    _SCORECARD, _LANES_SQL, f"WITH {_TECH} SELECT * FROM t", _COHORTS, _COVERAGE, _LISTED, _COMBINED, _AGE, _ACTIVITY, _EXPLORER,
    _TRANSITIONS, _SUMMARY, _HYSTERESIS)))
