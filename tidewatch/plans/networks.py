"""Networks: hits per source, weekly scores, quorums, floors, shares with bounds, kinds, and the gates over them.

lineitem rows are hits: supplier = network, part = address, flag = feed, ship date = day.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.operators import gates, stats
from tidewatch.plans.tables import OBSERVATIONS, observations, table

DAY = lambda s: F.lit(s).cast("date")
FEEDS = ("A", "N", "R")
#: Fixed value: share of hits that several feeds see twice, where it can't be measured.
RHO = 0.63


def address_hits(spark, sf_dir):
    """Hits per network and feed: each address once a feed, research scanners (one brand) left out, addresses without a network counted apart."""
    l = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("feed"), F.col("l_partkey").alias("p_partkey")).distinct()
    p = table(spark, sf_dir, "part").where("p_brand <> 'Brand#1'").select("p_partkey", F.when(F.col("p_size") <= 45, F.col("p_size")).alias("asn"))
    return l.join(p, "p_partkey").groupBy("feed", "asn").agg(
        F.count("*").alias("addresses"), F.count_distinct(F.floor(F.col("p_partkey") / 256)).alias("blocks"))


_HITS = """SELECT feed, asn, count(*) AS addresses, count(DISTINCT p_partkey // 256) AS blocks FROM (SELECT DISTINCT l_returnflag AS feed, l_partkey AS p_partkey FROM lineitem)
JOIN (SELECT p_partkey, CASE WHEN p_size <= 45 THEN p_size END AS asn FROM part WHERE p_brand <> 'Brand#1') USING (p_partkey) GROUP BY feed, asn"""


def facet_totals(spark, sf_dir):
    """Facet counts per network; a facet at its cap of sixty is replaced by the sum over line numbers it was split by."""
    l = table(spark, sf_dir, "lineitem")
    whole = l.groupBy("l_suppkey", "l_returnflag").agg(F.least(F.count("*"), F.lit(60)).alias("facet"))
    split = l.groupBy("l_suppkey", "l_returnflag", "l_linenumber").agg(F.count("*").alias("n")).groupBy("l_suppkey", "l_returnflag").agg(F.sum("n").alias("parts"))
    d = whole.join(split, ["l_suppkey", "l_returnflag"])
    return d.select("l_suppkey", "l_returnflag", (F.col("facet") == 60).alias("capped"), F.when(F.col("facet") == 60, F.col("parts")).otherwise(F.col("facet")).alias("total"))


_FACETS = """SELECT l_suppkey, l_returnflag, count(*) >= 60 AS capped, count(*) AS total FROM lineitem GROUP BY ALL"""


def day_ratios(spark, sf_dir):
    """Each sensor's daily mean of January's second half over its first, and over the world's ratio."""
    o = observations(spark, sf_dir).groupBy("source", "day").agg(F.sum("n").alias("n"))
    late = F.col("day") >= DAY("2024-01-16")
    d = o.groupBy("source").agg(F.avg(F.when(late, F.col("n"))).alias("after"), F.avg(F.when(~late, F.col("n"))).alias("before"))
    w = o.groupBy("day").agg(F.sum("n").alias("n")).agg((F.avg(F.when(late, F.col("n"))) / F.avg(F.when(~late, F.col("n")))).alias("world"))
    return d.crossJoin(F.broadcast(w)).select("source", *[F.round(c, 6).alias(n) for c, n in (
        (F.col("before"), "before"), (F.col("after"), "after"), (F.col("after") / F.col("before"), "ratio"), (F.col("after") / F.col("before") / F.col("world"), "against_world"))])


_RATIOS = f"""WITH {OBSERVATIONS}, n AS (SELECT source, day, sum(n) AS n FROM o GROUP BY ALL), w AS (SELECT day, sum(n) AS n FROM n GROUP BY day),
x AS (SELECT avg(n) FILTER (WHERE day >= DATE '2024-01-16') / avg(n) FILTER (WHERE day < DATE '2024-01-16') AS world FROM w),
d AS (SELECT source, avg(n) FILTER (WHERE day >= DATE '2024-01-16') AS after, avg(n) FILTER (WHERE day < DATE '2024-01-16') AS before FROM n GROUP BY source)
SELECT source, round(before, 6) AS before, round(after, 6) AS after, round(after / before, 6) AS ratio, round(after / before / world, 6) AS against_world FROM d, x"""


def _weekly(spark, sf_dir):
    """Hits per network, feed and month, with the network's size."""
    l = table(spark, sf_dir, "lineitem")
    size = l.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("size"))
    n = l.groupBy("l_suppkey", F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")).agg(*[F.count_if(F.col("l_returnflag") == f).alias(f) for f in FEEDS])
    return n.join(size, "l_suppkey")


_WEEKLY = """m AS (SELECT l_suppkey, date_trunc('month', l_shipdate)::DATE AS month, count(*) FILTER (WHERE l_returnflag = 'A') AS A, count(*) FILTER (WHERE l_returnflag = 'N') AS N,
  count(*) FILTER (WHERE l_returnflag = 'R') AS R, any_value(size) AS size FROM lineitem JOIN (SELECT l_suppkey, count(DISTINCT l_partkey) AS size FROM lineitem GROUP BY 1) USING (l_suppkey) GROUP BY ALL)"""


def network_months(spark, sf_dir):
    """A network's monthly score: feeds over their expectation by size, with floors, quorum, de-duplication and a band.

    A feed that has nothing in a month is absent: it counts half its smallest positive share instead of zero. A network needs two feeds over
    twice the expectation (the quorum) to be scored. What several feeds see twice is taken off by the measured share, or RHO.
    """
    m = _weekly(spark, sf_dir)
    totals = m.groupBy("month").agg(*[F.sum(f).alias(f"t{f}") for f in FEEDS], F.sum("size").alias("ts"))
    d = m.join(totals, "month")
    share = {f: F.col(f) / F.col(f"t{f}") for f in FEEDS}
    d = d.select("l_suppkey", "month", "size", "ts", *FEEDS, *[share[f].alias(f"s{f}") for f in FEEDS])
    floors = d.groupBy("month").agg(*[(F.min(F.when(F.col(f"s{f}") > 0, F.col(f"s{f}"))) / 2).alias(f"f{f}") for f in FEEDS])
    d = d.join(floors, "month")
    ratio = {f: F.coalesce(F.when(F.col(f"s{f}") > 0, F.col(f"s{f}")), F.col(f"f{f}"), F.lit(0.0)) / (F.col("size") / F.col("ts")) for f in FEEDS}
    d = d.select("l_suppkey", "month", *[F.round(ratio[f], 6).alias(f"ratio_{f.lower()}") for f in FEEDS], sum(F.col(f) for f in FEEDS).alias("hits"))
    seen = _overlap(spark, sf_dir)
    d = d.join(seen, ["l_suppkey", "month"], "left")
    over = sum((F.col(f"ratio_{f.lower()}") >= 2).cast("int") for f in FEEDS)
    best = F.greatest(*[F.col(f"ratio_{f.lower()}") for f in FEEDS])
    distinct = F.round(F.col("hits") * F.coalesce(F.col("kept"), F.lit(RHO)), 6)
    band = F.when(best >= 5, "high").when(best >= 2, "raised").otherwise("usual")
    return d.select("l_suppkey", "month", *[f"ratio_{f.lower()}" for f in FEEDS], over.alias("feeds_over"), (over >= 2).alias("quorum"), distinct.alias("distinct_hits"), band.alias("band"))


def _overlap(spark, sf_dir):
    """Share of hits left when an address counts once a month; known where at least two feeds saw the network."""
    l = table(spark, sf_dir, "lineitem")
    return l.groupBy("l_suppkey", F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")).agg(
        (F.count_distinct("l_partkey") / F.count("*")).alias("kept"), F.count_distinct("l_returnflag").alias("feeds")).where("feeds >= 2").drop("feeds")


_NETWORK_MONTHS = f"""WITH {_WEEKLY}, d AS (SELECT *, A / sum(A) OVER w AS sA, N / sum(N) OVER w AS sN, R / sum(R) OVER w AS sR, sum(size) OVER w AS ts FROM m WINDOW w AS (PARTITION BY month)),
f AS (SELECT *, """ + ", ".join(f"min(s{x}) FILTER (WHERE s{x} > 0) OVER (PARTITION BY month) / 2 AS f{x}" for x in FEEDS) + """ FROM d),
r AS (SELECT l_suppkey, month, A + N + R AS hits, """ + ", ".join(
    f"round(coalesce(CASE WHEN s{x} > 0 THEN s{x} END, f{x}, 0) / (size / ts), 6) AS ratio_{x.lower()}" for x in FEEDS) + f""" FROM f),
k AS (SELECT l_suppkey, date_trunc('month', l_shipdate)::DATE AS month, count(DISTINCT l_partkey) / count(*) AS kept FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_returnflag) >= 2),
x AS (SELECT *, (ratio_a >= 2)::INT + (ratio_n >= 2)::INT + (ratio_r >= 2)::INT AS feeds_over, greatest(ratio_a, ratio_n, ratio_r) AS best FROM r LEFT JOIN k USING (l_suppkey, month))
SELECT l_suppkey, month, ratio_a, ratio_n, ratio_r, feeds_over, feeds_over >= 2 AS quorum, round(hits * coalesce(kept, {RHO}), 6) AS distinct_hits,
  CASE WHEN best >= 5 THEN 'high' WHEN best >= 2 THEN 'raised' ELSE 'usual' END AS band FROM x"""


def share_ratios(spark, sf_dir):
    """Share of each nation's orders this year over last year's, with the bound that a list of only ten names leaves.

    A nation outside the first ten has at most the share of the tenth: its ratio is then a bound, and marked as one.
    """
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")).where("year in (1996, 1997)")
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    n = o.join(c, "c_custkey").groupBy("year", "nation").agg(F.count("*").alias("n"))
    t = n.groupBy("year").agg(F.sum("n").alias("t"))
    rank = F.row_number().over(Window.partitionBy("year").orderBy(F.desc("n"), "nation"))
    s = n.join(t, "year").withColumn("share", F.col("n") / F.col("t")).withColumn("k", rank)
    last = s.where("k = 10").select("year", F.col("share").alias("tenth"))
    s = s.join(last, "year").select("nation", "year", F.when(F.col("k") <= 10, F.col("share")).otherwise(F.col("tenth")).alias("share"), (F.col("k") > 10).alias("bound"))
    now, old = (s.where(F.col("year") == y).select("nation", F.col("share").alias(f"s{y}"), F.col("bound").alias(f"b{y}")) for y in (1997, 1996))
    mark = F.when(F.col("b1997") & F.col("b1996"), "unknown").when(F.col("b1997"), "at most").when(F.col("b1996"), "at least").otherwise("exact")
    return now.join(old, "nation").select("nation", F.round(F.col("s1997") / F.col("s1996"), 6).alias("ratio"), mark.alias("bound"))


_SHARES = """WITH n AS (SELECT year(o_orderdate) AS year, c_nationkey AS nation, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE year(o_orderdate) IN (1996, 1997) GROUP BY ALL),
s AS (SELECT *, n / sum(n) OVER (PARTITION BY year) AS share, row_number() OVER (PARTITION BY year ORDER BY n DESC, nation) AS k FROM n),
b AS (SELECT nation, year, CASE WHEN k <= 10 THEN share ELSE max(CASE WHEN k = 10 THEN share END) OVER (PARTITION BY year) END AS share, k > 10 AS bound FROM s)
SELECT x.nation, round(x.share / y.share, 6) AS ratio, CASE WHEN x.bound AND y.bound THEN 'unknown' WHEN x.bound THEN 'at most' WHEN y.bound THEN 'at least' ELSE 'exact' END AS bound
FROM b x JOIN b y ON x.nation = y.nation AND x.year = 1997 AND y.year = 1996"""

#: kind, pattern over the lower-case name; the first that matches decides.
KINDS = [("hosting", "bolt|gear"), ("access", "ring|widget"), ("research", "blue"), ("enterprise", "small|red|hot")]


def network_kinds(spark, sf_dir):
    """Kind and organisation of each network by ordered rules over its most frequent part name; what no rule names is 'other'."""
    l = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_partkey").alias("p_partkey"))
    n = l.join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey").groupBy("l_suppkey", "p_name").agg(F.count("*").alias("n"))
    top = n.groupBy("l_suppkey").agg(F.min(F.struct((-F.col("n")).alias("m"), "p_name"))["p_name"].alias("name"))
    kind = F
    for k, pattern in KINDS:
        kind = kind.when(F.lower("name").rlike(pattern), k)
    return top.select("l_suppkey", "name", kind.otherwise("other").alias("kind"))


_KINDS = "WITH t AS (SELECT l_suppkey, p_name AS name FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_suppkey, p_name QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, p_name) = 1) SELECT l_suppkey, name, CASE " + " ".join(
    f"WHEN regexp_matches(lower(name), '{p}') THEN '{k}'" for k, p in KINDS) + " ELSE 'other' END AS kind FROM t"


def network_stability(spark, sf_dir):
    """Month against the month before: rank correlation of hits, share of the first hundred that left, networks in both."""
    m = _weekly(spark, sf_dir).select("l_suppkey", "month", (F.col("A") + F.col("N") + F.col("R")).alias("hits"))
    before = m.select("l_suppkey", F.add_months("month", 1).alias("month"), F.col("hits").alias("was"))
    both = m.join(before, ["l_suppkey", "month"])
    s = stats.spearman(both, "hits", "was", ["month"]).join(both.groupBy("month").agg(F.count("*").alias("networks")), "month")
    w = Window.partitionBy("month").orderBy(F.desc("hits"), "l_suppkey")
    top = m.withColumn("k", F.row_number().over(w)).where("k <= 100").select("month", "l_suppkey")
    had = top.select(F.add_months("month", 1).alias("month"), "l_suppkey")
    left = had.join(top.withColumn("still", F.lit(1)), ["month", "l_suppkey"], "left").groupBy("month").agg(((F.count("*") - F.count("still")) / F.count("*")).alias("left"))
    return s.join(left, "month").select("month", "networks", F.round("spearman", 6).alias("spearman"), F.round("left", 6).alias("left"))


_STABILITY = f"""WITH {_WEEKLY}, h AS (SELECT l_suppkey, month, A + N + R AS hits FROM m), b AS (SELECT h.month, h.l_suppkey, h.hits, p.hits AS was FROM h JOIN h p ON p.l_suppkey = h.l_suppkey AND p.month = (h.month - INTERVAL 1 MONTH)::DATE),
k AS (SELECT month, rank() OVER (PARTITION BY month ORDER BY hits) + (count(*) OVER (PARTITION BY month, hits) - 1) / 2 AS x, rank() OVER (PARTITION BY month ORDER BY was) + (count(*) OVER (PARTITION BY month, was) - 1) / 2 AS y FROM b),
t AS (SELECT month, l_suppkey FROM h QUALIFY row_number() OVER (PARTITION BY month ORDER BY hits DESC, l_suppkey) <= 100),
l AS (SELECT (a.month + INTERVAL 1 MONTH)::DATE AS month, 1 - count(t.month) / count(*) AS "left" FROM t a LEFT JOIN t ON t.l_suppkey = a.l_suppkey AND t.month = (a.month + INTERVAL 1 MONTH)::DATE GROUP BY 1)
SELECT month, count(*) AS networks, round(CASE WHEN isfinite(corr(x, y)) THEN corr(x, y) END, 6) AS spearman, round(any_value("left"), 6) AS "left" FROM k JOIN l USING (month) GROUP BY month"""


def network_gates(spark, sf_dir):
    """The network suite: floors of feeds and networks, mapping, duplicates, bands, stability, exodus, lag, unchanged feeds."""
    l = table(spark, sf_dir, "lineitem")
    h, m, s = address_hits(spark, sf_dir), network_months(spark, sf_dir), network_stability(spark, sf_dir)
    mapped = l.select("l_suppkey").join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey", "left_anti")
    months = l.groupBy("l_returnflag", F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")).agg(F.count("*").alias("n"))
    again = months.withColumn("was", F.lag("n").over(Window.partitionBy("l_returnflag").orderBy("month")))
    world = table(spark, sf_dir, "part").agg(F.count("*")).first()[0]
    return gates.suite([
        gates.check(l, "all_feeds_collected", F.count_distinct("l_returnflag"), "measured = 3"),
        gates.check(l, "networks_floor", F.count_distinct("l_suppkey"), "measured >= 50"),
        gates.check(h, "unmapped_share", F.sum(F.when(F.col("asn").isNull(), F.col("addresses")).otherwise(0)) / F.sum("addresses"), "measured <= 0.2", gates.WARN),
        gates.check(mapped, "networks_are_known", F.count("*"), "measured = 0"),
        gates.none_of(l, "hits_are_positive", F.col("l_quantity") <= 0),
        gates.unique_key(m, "one_row_a_network_and_month", ["l_suppkey", "month"]),
        gates.check(m, "high_band_share", F.avg((F.col("band") == "high").cast("int")), "measured <= 0.25", gates.WARN),
        gates.none_of(m, "quorum_has_two_feeds", F.col("quorum") & (F.col("feeds_over") < 2)),
        gates.check(s, "rank_stability", F.percentile("spearman", 0.5), "measured >= 0.85", gates.WARN),
        gates.check(s, "exodus", F.max("left"), "measured <= 0.3", gates.WARN),
        gates.fresh(l.select(F.to_date("l_shipdate").alias("day")), "day", "2002-01-01", 60, "lag_days"),
        gates.check(again, "unchanged_feeds", F.count_if(F.col("n") == F.col("was")), "measured <= 2", gates.WARN),
        gates.check(h.where("asn is not null").groupBy("feed").agg(F.sum("addresses").alias("n")), "no_feed_above_the_world", F.max("n") / F.lit(world), "measured <= 1"),
    ]).withColumn("measured", F.round("measured", 6))


def _one(name, measured, passes, frm, severity="ERROR"):
    return f"SELECT '{name}' AS name, '{severity}' AS severity, ({measured})::DOUBLE AS v, '{passes}' AS rule FROM {frm}"


_GATE_ROWS = " UNION ALL ".join([
    _one("all_feeds_collected", "count(DISTINCT l_returnflag)", "= 3", "lineitem"), _one("networks_floor", "count(DISTINCT l_suppkey)", ">= 50", "lineitem"),
    _one("unmapped_share", "coalesce(sum(addresses) FILTER (WHERE asn IS NULL), 0) / sum(addresses)", "<= 0.2", "h", "WARN"),
    _one("networks_are_known", "count(*)", "= 0", "lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)"),
    _one("hits_are_positive", "count(*) FILTER (WHERE l_quantity <= 0)", "= 0", "lineitem"),
    _one("one_row_a_network_and_month", "count(*)", "= 0", "(SELECT l_suppkey, month FROM nm GROUP BY ALL HAVING count(*) > 1)"),
    _one("high_band_share", "avg((band = ''high'')::INT)".replace("''", "'"), "<= 0.25", "nm", "WARN"),
    _one("quorum_has_two_feeds", "count(*) FILTER (WHERE quorum AND feeds_over < 2)", "= 0", "nm"),
    _one("rank_stability", "median(spearman)", ">= 0.85", "ns", "WARN"), _one("exodus", 'max("left")', "<= 0.3", "ns", "WARN"),
    _one("lag_days", "DATE '2002-01-01' - max(CAST(l_shipdate AS DATE))", "between 0 and 60", "lineitem", "WARN"),
    _one("unchanged_feeds", "count(*) FILTER (WHERE n = was)", "<= 2", "(SELECT n, lag(n) OVER (PARTITION BY l_returnflag ORDER BY month) AS was FROM (SELECT l_returnflag, date_trunc('month', l_shipdate) AS month, count(*) AS n FROM lineitem GROUP BY ALL))", "WARN"),
    _one("no_feed_above_the_world", "max(n) / (SELECT count(*) FROM part)", "<= 1", "(SELECT feed, sum(addresses) AS n FROM h WHERE asn IS NOT NULL GROUP BY feed)"),
])
_RULES = {"= 3": "v = 3", ">= 50": "v >= 50", "<= 0.2": "v <= 0.2", "= 0": "v = 0", "<= 0.25": "v <= 0.25", ">= 0.85": "v >= 0.85", "<= 0.3": "v <= 0.3", "between 0 and 60": "v BETWEEN 0 AND 60",
          "<= 2": "v <= 2", "<= 1": "v <= 1"}
_GATES = f"WITH h AS ({_HITS}), nm AS ({_NETWORK_MONTHS}), ns AS ({_STABILITY}), g AS ({_GATE_ROWS}) SELECT name, severity, coalesce(CASE rule " + " ".join(
    f"WHEN '{k}' THEN {c}" for k, c in _RULES.items()) + " END, false) AS passed, round(v, 6) AS measured FROM g"

QUERIES = {f.__name__: f for f in (address_hits, facet_totals, day_ratios, network_months, share_ratios, network_kinds, network_stability, network_gates)}
ORACLE_SQL = dict(zip(QUERIES, (_HITS, _FACETS, _RATIOS, _NETWORK_MONTHS, _SHARES, _KINDS, _STABILITY, _GATES)))
