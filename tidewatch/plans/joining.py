"""Interval, as-of, range and disjunctive joins, set operations, rankings within joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.operators import joins
from tidewatch.plans.tables import ASSERTIONS, OBSERVATIONS, assertions, observations, table


def asof_rate(spark, sf_dir):
    """Orders at the last daily rate of their list within nine days before, from all entries; USD-like list 5-LOW is one."""
    a = assertions(spark, sf_dir)
    rates = a.groupBy("source", "added").agg(F.max("price").alias("rate"))
    out = joins.asof_backward(a.select("entry", "source", "added"), rates, ["source"], "added", "rate", 9)
    return out.select("entry", "source", "added", F.when(F.col("source") == "5-LOW", 1.0).otherwise(F.col("rate")).alias("rate"))


_ASOF = f"""WITH {ASSERTIONS}, x AS (SELECT source, added AS d, max(price) AS rate FROM a GROUP BY ALL)
SELECT entry, a.source, a.added, CASE WHEN a.source = '5-LOW' THEN 1.0 WHEN a.added - x.d <= 9 THEN x.rate END AS rate
FROM a ASOF LEFT JOIN x ON a.source = x.source AND a.added >= x.d"""


def interval_claim_link(spark, sf_dir):
    """Claims of one list and incidents of another on the same subject at most 60 days apart, nearest first."""
    a = assertions(spark, sf_dir)
    claims = a.where("source = '1-URGENT'").select("vuln", F.col("entry").alias("claim"), F.col("added").alias("seen"))
    facts = a.where("source = '2-HIGH'").select("vuln", F.col("entry").alias("incident"), F.col("added").alias("public"))
    j = claims.join(facts, "vuln").withColumn("days", F.abs(F.datediff("seen", "public"))).where("days <= 60")
    w = Window.partitionBy("claim").orderBy("days", "incident")
    return j.withColumn("k", F.row_number().over(w)).where("k = 1").select("claim", "incident", "days")


_INTERVAL = f"""WITH {ASSERTIONS} SELECT x.entry AS claim, y.entry AS incident, abs(x.added - y.added) AS days
FROM a x JOIN a y ON x.vuln = y.vuln AND x.source = '1-URGENT' AND y.source = '2-HIGH' AND abs(x.added - y.added) <= 60
QUALIFY row_number() OVER (PARTITION BY x.entry ORDER BY abs(x.added - y.added), y.entry) = 1"""


def asymmetric_corroboration(spark, sf_dir):
    """Share of each list's entries that another list bears out from 60 days before to 180 after."""
    a = assertions(spark, sf_dir)
    other = a.select("vuln", F.col("source").alias("by"), F.col("added").alias("public"))
    hit = (
        a.join(other, "vuln").where("by <> source and public between date_sub(added, 60) and date_add(added, 180)")
        .select("entry").distinct().withColumn("hit", F.lit(1)))
    d = a.join(hit, "entry", "left").groupBy("source").agg(F.count("*").alias("n"), F.count("hit").alias("k"))
    p, z = F.col("k") / F.col("n"), 1.96
    mid, half = p + z * z / (2 * F.col("n")), z * F.sqrt(p * (1 - p) / F.col("n") + z * z / (4 * F.col("n") * F.col("n")))
    scale = 1 + z * z / F.col("n")
    return d.select("source", "n", "k", F.round(p, 6).alias("rate"), F.round(F.greatest(F.lit(0.0), (mid - half) / scale), 6).alias("low"),
                    F.round(F.least(F.lit(1.0), (mid + half) / scale), 6).alias("high"))


_CORROBORATION = f"""WITH {ASSERTIONS}, h AS (SELECT DISTINCT x.entry FROM a x JOIN a y ON x.vuln = y.vuln AND x.source <> y.source
  AND y.added BETWEEN x.added - 60 AND x.added + 180),
d AS (SELECT source, count(*) AS n, count(h.entry) AS k FROM a LEFT JOIN h USING (entry) GROUP BY source)
SELECT source, n, k, round(k / n, 6) AS rate,
  round(greatest(0, (k / n + 1.96 * 1.96 / (2 * n) - 1.96 * sqrt(k / n * (1 - k / n) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n)), 6) AS low,
  round(least(1, (k / n + 1.96 * 1.96 / (2 * n) + 1.96 * sqrt(k / n * (1 - k / n) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n)), 6) AS high FROM d"""


def coarse_window_match(spark, sf_dir):
    """Entries dated by month only: a window of the month and one month around, against exact dates."""
    a = assertions(spark, sf_dir)
    coarse = a.where("source = '4-NOT SPECIFIED'").select("vuln", F.trunc("added", "month").alias("m")).distinct().select(
        "vuln", "m", F.add_months("m", -1).alias("lo"), F.date_sub(F.add_months("m", 2), 1).alias("hi"))
    exact = a.where("source <> '4-NOT SPECIFIED'").select("vuln", "added")
    j = coarse.join(exact, "vuln", "left").withColumn("hit", F.coalesce(F.col("added").between(F.col("lo"), F.col("hi")), F.lit(False)))
    return j.groupBy("vuln", "m").agg(F.count_if("hit").alias("matches"))


_COARSE = f"""WITH {ASSERTIONS}, c AS (SELECT DISTINCT vuln, date_trunc('month', added)::DATE AS m FROM a WHERE source = '4-NOT SPECIFIED')
SELECT c.vuln, m, count(e.added) FILTER (WHERE e.added >= m - INTERVAL 1 MONTH AND e.added < m + INTERVAL 2 MONTH) AS matches
FROM c LEFT JOIN a e ON e.vuln = c.vuln AND e.source <> '4-NOT SPECIFIED' GROUP BY ALL"""


def _prefixes(spark, sf_dir):
    """Routing-like ranges: from each part's number, longer prefixes are shorter ranges; size is the origin."""
    p = table(spark, sf_dir, "part")
    plen = F.col("p_partkey") % 5
    size = F.expr("shiftleft(1L, cast(6 - p_partkey % 5 as int))")
    lo = F.floor((F.col("p_partkey") * 37) % 20000 / size) * size
    return p.select(lo.alias("lo"), (lo + size - 1).alias("hi"), plen.alias("plen"), F.col("p_size").alias("asn"), F.col("p_partkey").alias("id"))


_PREFIXES = """g AS (SELECT p_partkey AS id, p_partkey % 5 AS plen, (1 << (6 - (p_partkey % 5))::INT)::BIGINT AS size, p_size AS asn FROM part),
ranges AS (SELECT id, plen, asn, (id * 37) % 20000 // size * size AS lo, (id * 37) % 20000 // size * size + size - 1 AS hi FROM g)"""


def range_lookup(spark, sf_dir):
    """Each point's longest prefix that holds it; ties by id."""
    points = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("entry"), (F.col("o_orderkey") * 13 % 20000).alias("ip"))
    out = joins.prefix_lookup(points, _prefixes(spark, sf_dir), "ip", "lo", "hi", [-F.col("plen"), F.col("id")])
    return out.select("entry", "ip", "asn", "plen")


_RANGE = f"""WITH {_PREFIXES}, p AS (SELECT o_orderkey AS entry, o_orderkey * 13 % 20000 AS ip FROM orders)
SELECT entry, ip, asn, plen FROM p LEFT JOIN ranges ON ip BETWEEN lo AND hi QUALIFY row_number() OVER (PARTITION BY entry ORDER BY plen DESC NULLS LAST, id) = 1"""


def routed_sizes(spark, sf_dir):
    """Size of each origin after the longest prefix has overwritten the shorter ones, from expanded slots."""
    r = _prefixes(spark, sf_dir).select("*", F.explode(F.sequence("lo", "hi")).alias("slot"))
    best = r.groupBy("slot").agg(F.min_by("asn", F.struct((-F.col("plen")).alias("p"), "id")).alias("asn"))
    return best.groupBy("asn").agg(F.count("*").alias("slots"))


_ROUTED = f"""WITH {_PREFIXES}, s AS (SELECT unnest(range(lo, hi + 1)) AS slot, asn, plen, id FROM ranges),
b AS (SELECT slot, asn FROM s QUALIFY row_number() OVER (PARTITION BY slot ORDER BY plen DESC, id) = 1)
SELECT asn, count(*) AS slots FROM b GROUP BY asn"""


def moas_any_listed(spark, sf_dir):
    """Blocks with several origins are listed if any origin is."""
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("block")).agg(F.collect_set("l_suppkey").alias("origins"))
    listed = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("asn"), F.lit(True).alias("listed"))
    j = l.select("block", F.size("origins").cast("long").alias("origins"), F.explode("origins").alias("asn")).join(listed, "asn", "left")
    return j.groupBy("block", "origins").agg(F.bool_or(F.coalesce("listed", F.lit(False))).alias("any_listed"))


_MOAS = """SELECT l_partkey AS block, count(DISTINCT l_suppkey) AS origins, bool_or(s_acctbal < 0) AS any_listed
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey"""


def dominant_per_bucket(spark, sf_dir):
    """Largest network of each country by rows, ties to the smaller number; and its share of the total."""
    l = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    j = l.join(s, "l_suppkey")
    out = j.groupBy("nation").agg(F.min_by("l_suppkey", F.struct((-F.col("n")).alias("m"), "l_suppkey")).alias("asn"), F.max("n").alias("n"), F.sum("n").alias("total"))
    return out.select("nation", "asn", "n", F.round(F.col("n") / F.col("total"), 9).alias("share"))


_DOMINANT = """WITH d AS (SELECT s_nationkey AS nation, l_suppkey AS asn, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
SELECT nation, asn, n, round(n / sum(n) OVER (PARTITION BY nation), 9) AS share FROM d
QUALIFY row_number() OVER (PARTITION BY nation ORDER BY n DESC, asn) = 1"""


def or_join_lookup(spark, sf_dir):
    """Customers and suppliers that share a name number or a balance rounded to tens, as equi-joins."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c"), F.regexp_extract("c_name", "([0-9]+)$", 1).cast("long").alias("num"), F.floor(F.col("c_acctbal") / 10).alias("bal"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"), F.regexp_extract("s_name", "([0-9]+)$", 1).cast("long").alias("snum"), F.floor(F.col("s_acctbal") / 10).alias("sbal"))
    return joins.any_key_join(c, s, [(F.col("num"), F.col("snum")), (F.col("bal"), F.col("sbal"))], "c", "s")


_OR = """SELECT DISTINCT c_custkey AS c, s_suppkey AS s FROM customer JOIN supplier ON regexp_extract(c_name, '([0-9]+)$', 1)::BIGINT = regexp_extract(s_name, '([0-9]+)$', 1)::BIGINT
UNION SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON floor(c_acctbal / 10) = floor(s_acctbal / 10)"""


def one_to_one_join(spark, sf_dir):
    a = assertions(spark, sf_dir)
    l = a.where("source = '1-URGENT'").select("entry", "vuln", F.trunc("added", "quarter").alias("q"))
    r = a.where("source = '3-MEDIUM'").select(F.col("entry").alias("other"), "vuln", F.trunc("added", "quarter").alias("q"))
    return joins.one_to_one(l, r, ["vuln", "q"], "entry", "other")


_ONE = f"""WITH {ASSERTIONS}, l AS (SELECT entry, vuln, date_trunc('quarter', added) AS q, count(*) OVER (PARTITION BY vuln, date_trunc('quarter', added)) AS nl
  FROM a WHERE source = '1-URGENT'),
r AS (SELECT vuln, date_trunc('quarter', added) AS q, count(*) AS nr, min(entry) AS other FROM a WHERE source = '3-MEDIUM' GROUP BY ALL)
SELECT entry, CASE WHEN nl = 1 AND nr = 1 THEN other END AS other, CASE WHEN nr IS NULL THEN 'missing' WHEN nl > 1 OR nr > 1 THEN 'ambiguous' ELSE 'joined' END AS outcome
FROM l LEFT JOIN r USING (vuln, q)"""


def set_differences(spark, sf_dir):
    """Symmetric difference and intersection of what two sensors saw, by vulnerability."""
    o = observations(spark, sf_dir)
    x, y = (o.where(F.col("source") == s).select("vuln").distinct() for s in ("error", "purchase"))
    tag = lambda d, t: d.select("vuln", F.lit(t).alias("side"))
    return tag(x.subtract(y), "only_error").unionByName(tag(y.subtract(x), "only_purchase")).unionByName(tag(x.intersect(y), "both"))


_SETS = f"""WITH {OBSERVATIONS}, x AS (SELECT DISTINCT vuln FROM o WHERE source = 'error'), y AS (SELECT DISTINCT vuln FROM o WHERE source = 'purchase')
SELECT vuln, 'only_error' AS side FROM (SELECT * FROM x EXCEPT SELECT * FROM y) UNION ALL SELECT vuln, 'only_purchase' FROM (SELECT * FROM y EXCEPT SELECT * FROM x)
UNION ALL SELECT vuln, 'both' FROM (SELECT * FROM x INTERSECT SELECT * FROM y)"""


def orphans(spark, sf_dir):
    """Anti and semi joins: registered without an assertion, sighted without one, and sighted with one."""
    r = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("vuln"))
    a = assertions(spark, sf_dir).where("added < date '1995-03-01'").select("vuln").distinct()
    o = observations(spark, sf_dir).select("vuln").distinct()
    tag = lambda d, t: d.agg(F.count("*").alias("n")).select(F.lit(t).alias("kind"), "n")
    return tag(r.join(a, "vuln", "left_anti"), "registry_only").unionByName(tag(o.join(a, "vuln", "left_anti"), "sighted_only")).unionByName(
        tag(o.join(a, "vuln", "left_semi"), "sighted_listed"))


_ORPHANS = f"""WITH {ASSERTIONS}, {OBSERVATIONS}, l AS (SELECT DISTINCT vuln FROM a WHERE added < DATE '1995-03-01'), s AS (SELECT DISTINCT vuln FROM o)
SELECT 'registry_only' AS kind, count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT vuln FROM l)
UNION ALL SELECT 'sighted_only', count(*) FROM s ANTI JOIN l USING (vuln) UNION ALL SELECT 'sighted_listed', count(*) FROM s SEMI JOIN l USING (vuln)"""


def work_queue(spark, sf_dir):
    """The next hundred to look up: never looked up first, then the oldest, then by id (the limit is the feature)."""
    r = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("vuln"))
    last = assertions(spark, sf_dir).where("source = '1-URGENT'").groupBy("vuln").agg(F.max("added").alias("looked_up"))
    return r.join(last, "vuln", "left").orderBy(F.col("looked_up").asc_nulls_first(), "vuln").limit(100)


_QUEUE = f"""WITH {ASSERTIONS}, l AS (SELECT vuln, max(added) AS looked_up FROM a WHERE source = '1-URGENT' GROUP BY vuln)
SELECT c_custkey AS vuln, looked_up FROM customer LEFT JOIN l ON vuln = c_custkey ORDER BY looked_up ASC NULLS FIRST, c_custkey LIMIT 100"""


def monotonic_self_join(spark, sf_dir):
    """Months whose cumulative count is below the month before (none), and the step, by an offset self-join."""
    m = assertions(spark, sf_dir).groupBy(F.trunc("added", "month").alias("month")).agg(F.count("*").alias("n"))
    w = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    c = m.withColumn("total", F.sum("n").over(w))
    nxt = c.select(F.add_months("month", -1).alias("month"), F.col("total").alias("next_total"))
    return c.join(nxt, "month").select("month", "total", "next_total", (F.col("next_total") < F.col("total")).alias("falls"))


_MONOTONIC = f"""WITH {ASSERTIONS}, m AS (SELECT date_trunc('month', added)::DATE AS month, count(*) AS n FROM a GROUP BY ALL),
c AS (SELECT month, (sum(n) OVER (ORDER BY month))::BIGINT AS total FROM m)
SELECT c.month, c.total, x.total AS next_total, x.total < c.total AS falls FROM c JOIN c x ON x.month = (c.month + INTERVAL 1 MONTH)::DATE"""

QUERIES = {f.__name__: f for f in (
    asof_rate, interval_claim_link, asymmetric_corroboration, coarse_window_match, range_lookup, routed_sizes, moas_any_listed,
    dominant_per_bucket, or_join_lookup, one_to_one_join, set_differences, orphans, work_queue, monotonic_self_join)}
ORACLE_SQL = dict(zip(QUERIES, (
    _ASOF, _INTERVAL, _CORROBORATION, _COARSE, _RANGE, _ROUTED, _MOAS, _DOMINANT, _OR, _ONE, _SETS, _ORPHANS, _QUEUE, _MONOTONIC)))
