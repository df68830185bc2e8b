"""Network scoring and evaluation statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import special
from tidewatch.operators import stats, windows
from tidewatch.plans.tables import assertions, observations, table

FEEDS = {"A": "l_returnflag = 'A'", "N": "l_returnflag = 'N'", "R": "l_returnflag = 'R'"}


def _networks(spark, sf_dir):
    """One row per network: rows per feed, and its size (distinct parts)."""
    l = table(spark, sf_dir, "lineitem")
    return l.groupBy(F.col("l_suppkey").alias("asn")).agg(
        *[F.count_if(F.expr(c)).alias(f"feed_{k.lower()}") for k, c in FEEDS.items()], F.count_distinct("l_partkey").alias("size"))


_NET = "n AS (SELECT l_suppkey AS asn, " + ", ".join(
    f"count(*) FILTER (WHERE {c}) AS feed_{k.lower()}" for k, c in FEEDS.items()) + ", count(DISTINCT l_partkey) AS size FROM lineitem GROUP BY 1)"


def feed_excess(spark, sf_dir):
    """Observed against expected by size, with the posterior of the rate ratio (no SQL for the quantiles)."""
    n = _networks(spark, sf_dir)
    total = n.agg(F.sum("feed_a").alias("t"), F.sum("size").alias("s"))
    d = n.crossJoin(F.broadcast(total)).withColumn("expected", F.col("size") * F.col("t") / F.col("s"))
    return d.withColumn("x", special.excess_udf(1.2)(F.col("feed_a"), F.col("expected"))).select(
        "asn", F.col("feed_a").alias("observed"), "expected", "x.mean", "x.low", "x.high", "x.p")


def feed_expected(spark, sf_dir):
    n = _networks(spark, sf_dir)
    total = n.agg(F.sum("feed_a").alias("t"), F.sum("size").alias("s"))
    d = n.crossJoin(F.broadcast(total))
    e = F.col("size") * F.col("t") / F.col("s")
    return d.select("asn", "feed_a", "size", F.round(e, 6).alias("expected"), F.round(F.col("feed_a") / e, 6).alias("ratio"),
                    F.round(F.col("size") * (1 - F.exp(-F.col("feed_a") / F.col("size"))), 6).alias("occupied"))


_EXPECTED = f"""WITH {_NET}, t AS (SELECT sum(feed_a) AS t, sum(size) AS s FROM n)
SELECT asn, feed_a, size, round(size * t / s, 6) AS expected, round(feed_a / (size * t / s), 6) AS ratio,
  round(size * (1 - exp(-feed_a / size)), 6) AS occupied FROM n, t"""


def fdr_select(spark, sf_dir):
    """Customers by balance as a probability, longest prefix with a mean false share of 20 per cent, per segment."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"),
                                                F.round((F.col("c_acctbal") + 1000) / 11000, 9).alias("p"))
    return stats.fdr_prefix(c, "p", ["segment"], "id", 0.2)


_FDR = """WITH c AS (SELECT c_custkey AS id, c_mktsegment AS segment, round((c_acctbal + 1000) / 11000, 9) AS p FROM customer),
k AS (SELECT *, row_number() OVER w AS k, sum(1 - p) OVER (PARTITION BY segment ORDER BY p DESC, id ROWS UNBOUNDED PRECEDING) AS s FROM c WINDOW w AS (PARTITION BY segment ORDER BY p DESC, id))
SELECT id, segment, p, coalesce(k <= max(k) FILTER (WHERE s / k <= 0.2) OVER (PARTITION BY segment), false) AS selected FROM k"""


def rank_auc(spark, sf_dir):
    """How well a text's length tells its quality label, by language."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return stats.auc(d, "n_chars", "quality", ["lang"]).withColumn("auc", F.round("auc", 9))


_RANKED = """(SELECT *, {x} AS v, rank() OVER (PARTITION BY {by} ORDER BY {x}) + (count(*) OVER (PARTITION BY {by}, {x}) - 1) / 2 AS r FROM {t})"""
_AUC = "SELECT lang, sum(quality)::BIGINT AS positives, (count(*) - sum(quality))::BIGINT AS negatives, round((sum(r) FILTER (WHERE quality = 1) - sum(quality) * (sum(quality) + 1) / 2) / nullif(sum(quality) * (count(*) - sum(quality)), 0), 9) AS auc FROM " + _RANKED.format(
    x="n_chars", by="lang", t="(SELECT d.doc_id, lang, n_chars, quality FROM documents d JOIN labels USING (doc_id))") + " GROUP BY lang"


def spearman_sides(spark, sf_dir):
    return stats.spearman(_networks(spark, sf_dir).withColumn("side", F.lit("all")), "feed_a", "feed_r", ["side"]).withColumn("spearman", F.round("spearman", 9))


_SPEARMAN = f"""WITH {_NET}, r AS (SELECT rank() OVER (ORDER BY feed_a) + (count(*) OVER (PARTITION BY feed_a) - 1) / 2 AS x,
  rank() OVER (ORDER BY feed_r) + (count(*) OVER (PARTITION BY feed_r) - 1) / 2 AS y FROM n) SELECT 'all' AS side, round(corr(x, y), 9) AS spearman FROM r"""


def gini_mass(spark, sf_dir):
    o = observations(spark, sf_dir).groupBy("source", "vuln").agg(F.sum("n").alias("n"))
    return stats.gini(o, "n", ["source"]).withColumn("gini", F.round("gini", 9))


_GINI = """WITH o AS (SELECT event_type AS source, user_id AS vuln, count(*) AS n FROM events GROUP BY ALL),
r AS (SELECT source, n, rank() OVER (PARTITION BY source ORDER BY n) + (count(*) OVER (PARTITION BY source, n) - 1) / 2 AS k FROM o)
SELECT source, round(2 * sum(k * n) / (count(*) * sum(n)) - (count(*) + 1) / count(*), 9) AS gini FROM r GROUP BY source"""


def size_histogram(spark, sf_dir):
    """Power-of-two histogram of rows per customer."""
    n = assertions(spark, sf_dir).groupBy("vuln").agg(F.count("*").alias("n"))
    return n.groupBy(F.pow(2, F.floor(F.log2("n") + 1e-9)).cast("long").alias("bucket")).agg(F.count("*").alias("networks"))


_SIZES = "SELECT (1 << floor(log2(n) + 1e-9)::INT)::BIGINT AS bucket, count(*) AS networks FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey) GROUP BY 1"


def wilson_confidence(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_if(F.col("l_discount") > 0.05).alias("k"))
    lo, hi = stats.wilson(F.col("k"), F.col("n"))
    return d.select("l_returnflag", "n", "k", F.round(lo, 6).alias("low"), F.round(hi, 6).alias("high"))


_WILSON = """WITH d AS (SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE l_discount > 0.05) AS k FROM lineitem GROUP BY 1)
SELECT l_returnflag, n, k, round((k / n + 3.8416 / (2 * n) - 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS low,
  round((k / n + 3.8416 / (2 * n) + 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS high FROM d"""


def hysteresis_list(spark, sf_dir):
    """Listed at 50 or more, kept at 35 or more if listed the quarter before."""
    a = assertions(spark, sf_dir).withColumn("q", F.trunc("added", "quarter"))
    n = a.groupBy("source", "q").agg(F.count("*").alias("n"))
    now = n.where("q = date '1999-04-01'").withColumn("score", F.col("n") / 3)
    before = n.where("q = date '1999-01-01' and n / 3 >= 36").select("source")
    return windows.hysteresis(now, "source", "score", before, 37, 35).select("source", "n", F.round("score", 6).alias("score"), "listed")


_HYSTERESIS = """WITH n AS (SELECT o_orderpriority AS source, date_trunc('quarter', o_orderdate)::DATE AS q, count(*) AS n FROM orders GROUP BY ALL),
b AS (SELECT source FROM n WHERE q = DATE '1999-01-01' AND n / 3 >= 36)
SELECT source, n, round(n / 3, 6) AS score, n / 3 >= CASE WHEN source IN (SELECT source FROM b) THEN 35 ELSE 37 END AS listed FROM n WHERE q = DATE '1999-04-01'"""


def country_shares(spark, sf_dir):
    """Share of each country's total and of the world's, and the ratio of the two by feed."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("asn"), F.col("s_nationkey").alias("nation"))
    d = _networks(spark, sf_dir).join(s, "asn").groupBy("nation").agg(F.sum("feed_a").alias("a"), F.sum("size").alias("size"))
    total = d.agg(F.sum("a").alias("ta"), F.sum("size").alias("ts"))
    return d.crossJoin(F.broadcast(total)).select("nation", "a", "size", F.round(F.col("a") / F.col("ta"), 9).alias("share"),
                                                  F.round((F.col("a") / F.col("ta")) / (F.col("size") / F.col("ts")), 9).alias("ratio"))


_SHARES = f"""WITH {_NET}, d AS (SELECT s_nationkey AS nation, sum(feed_a)::BIGINT AS a, sum(size)::BIGINT AS size FROM n JOIN supplier ON s_suppkey = asn GROUP BY 1),
t AS (SELECT sum(a) AS ta, sum(size) AS ts FROM d) SELECT nation, a, size, round(a / ta, 9) AS share, round((a / ta) / (size / ts), 9) AS ratio FROM d, t"""


def union_counts(spark, sf_dir):
    """Distinct items across feeds per network and the sum over feeds: the overlap between feeds."""
    l = table(spark, sf_dir, "lineitem")
    per = l.groupBy("l_suppkey", "l_returnflag").agg(F.count_distinct("l_partkey").alias("n"))
    u = l.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("distinct_items"))
    return per.groupBy("l_suppkey").agg(F.sum("n").alias("sum_over_feeds"), F.max("n").alias("largest_feed")).join(u, "l_suppkey")


_UNION = """WITH p AS (SELECT l_suppkey, l_returnflag, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY ALL)
SELECT l_suppkey, sum(n)::BIGINT AS sum_over_feeds, max(n) AS largest_feed, any_value(u.d) AS distinct_items
FROM p JOIN (SELECT l_suppkey, count(DISTINCT l_partkey) AS d FROM lineitem GROUP BY 1) u USING (l_suppkey) GROUP BY l_suppkey"""


def latent_class_groups(spark, sf_dir):
    """Posterior of 'bad' by pattern of three feeds above their mean (fitted, no SQL)."""
    n = _networks(spark, sf_dir)
    mean = n.agg(*[F.avg(f"feed_{k.lower()}").alias(f"m_{k.lower()}") for k in FEEDS])
    d = n.crossJoin(F.broadcast(mean))
    flags = [f"x_{k.lower()}" for k in FEEDS]
    for k in FEEDS:
        d = d.withColumn(f"x_{k.lower()}", F.col(f"feed_{k.lower()}") > F.col(f"m_{k.lower()}"))
    return stats.latent_classes(d, flags)


def intensity_scores(spark, sf_dir):
    """Latent intensity by side from three feeds (fitted, no SQL)."""
    n = _networks(spark, sf_dir).withColumn("side", F.when(F.col("asn") % 2 == 0, "attack").otherwise("host"))
    return stats.intensity_fit(n, "side", ["feed_a", "feed_n", "feed_r"], "size")


def scorecard_interval(spark, sf_dir):
    """Rate of late lines by flag with a cluster bootstrap (random draws, no SQL)."""
    l = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_suppkey", (F.col("l_discount") > 0.05).alias("hit"))
    return stats.bootstrap_rate(l, ["l_returnflag"], "hit", "l_suppkey")


QUERIES = {f.__name__: f for f in (
    feed_expected, fdr_select, rank_auc, spearman_sides, gini_mass, size_histogram, wilson_confidence, hysteresis_list,
    country_shares, union_counts, feed_excess, latent_class_groups, intensity_scores, scorecard_interval)}
ORACLE_SQL = dict(zip(QUERIES, (_EXPECTED, _FDR, _AUC, _SPEARMAN, _GINI, _SIZES, _WILSON, _HYSTERESIS, _SHARES, _UNION)))
