"""Catalogue consolidation, source agreement and independence, prioritisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import merge
from tidewatch.plans.tables import ASSERTIONS, CENSORED, OBSERVATIONS, REGISTRY, assertions, observations, registry

#: (name, condition on one wide row per vulnerability)
RULES = [
    ("all", "true"), ("score_7000", "score >= 7000"), ("score_9000", "score >= 9000"), ("any_list", "listed"),
    ("urgent_list", "urgent"), ("list_or_9000", "listed or score >= 9000"), ("urgent_or_7000", "urgent or score >= 7000"),
    ("list_and_7000", "listed and score >= 7000"), ("urgent_not_seen", "urgent and not seen"),
]
MONTH = "1998-01-01"


def prio_scorecard(spark, sf_dir):
    a = assertions(spark, sf_dir).where(f"added < date '{MONTH}'").groupBy("vuln").agg(
        F.lit(True).alias("listed"), F.bool_or(F.col("source") == "1-URGENT").alias("urgent"))
    o = observations(spark, sf_dir).groupBy("vuln").agg(
        F.bool_or(F.col("day") >= F.lit("2024-01-15").cast("date")).alias("attacked"),
        F.bool_or(F.col("day") < F.lit("2024-01-15").cast("date")).alias("seen"))
    no = F.lit(False)
    wide = registry(spark, sf_dir).join(a, "vuln", "left").join(o, "vuln", "left").select(
        "vuln", "score", *[F.coalesce(c, no).alias(c) for c in ("listed", "urgent", "attacked", "seen")])
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.expr(c).alias("in_rule")) for n, c in RULES])
    new = F.col("attacked") & ~F.col("seen")
    return (
        wide.select("*", F.explode(rules).alias("x")).select("*", "x.rule", "x.in_rule").groupBy("rule").agg(
            F.count_if("in_rule").alias("listed"), F.count_if(F.col("in_rule") & F.col("attacked")).alias("hit_all"),
            F.count_if(F.col("in_rule") & new).alias("hit_new"), F.count_if("attacked").alias("attacked"),
            F.count_if(new).alias("attacked_new"))
        .withColumn("precision", F.when(F.col("listed") > 0, F.round(F.col("hit_all") / F.col("listed"), 6)))
    )


_RULE_ROWS = " UNION ALL ".join(f"SELECT '{n}' AS rule, ({c}) AS in_rule, attacked, seen FROM wide" for n, c in RULES)
_PRIO = f"""WITH {ASSERTIONS}, {OBSERVATIONS}, {REGISTRY},
l AS (SELECT vuln, true AS listed, bool_or(source = '1-URGENT') AS urgent FROM a WHERE added < DATE '{MONTH}' GROUP BY vuln),
s AS (SELECT vuln, bool_or(day >= DATE '2024-01-15') AS attacked, bool_or(day < DATE '2024-01-15') AS seen FROM o GROUP BY vuln),
wide AS (SELECT vuln, score, coalesce(listed, false) AS listed, coalesce(urgent, false) AS urgent,
  coalesce(attacked, false) AS attacked, coalesce(seen, false) AS seen FROM r LEFT JOIN l USING (vuln) LEFT JOIN s USING (vuln)),
x AS ({_RULE_ROWS})
SELECT rule, count(*) FILTER (WHERE in_rule) AS listed, count(*) FILTER (WHERE in_rule AND attacked) AS hit_all,
  count(*) FILTER (WHERE in_rule AND attacked AND NOT seen) AS hit_new, count(*) FILTER (WHERE attacked) AS attacked,
  count(*) FILTER (WHERE attacked AND NOT seen) AS attacked_new,
  CASE WHEN count(*) FILTER (WHERE in_rule) > 0 THEN round(count(*) FILTER (WHERE in_rule AND attacked)
    / count(*) FILTER (WHERE in_rule), 6) END AS precision
FROM x GROUP BY rule"""


def kev_consolidated(spark, sf_dir):
    """One row per vulnerability; live assertions at or before the censoring date date it."""
    a = assertions(spark, sf_dir)
    live = ~F.col("withdrawn") & (F.col("added") <= F.lit(CENSORED).cast("date"))
    return a.groupBy("vuln").agg(
        F.min(F.when(live, F.col("added"))).alias("first_date"), F.count("*").alias("entry_count"),
        F.count_distinct("source").alias("source_count"), F.bool_and("withdrawn").alias("all_withdrawn"),
        F.concat_ws(",", F.array_sort(F.collect_set("source"))).alias("canonical_sources"),
        F.min_by("source", F.when(live, F.struct("added", "source", "entry"))).alias("first_source"))


_CONSOLIDATED = f"""WITH {ASSERTIONS}, b AS (SELECT *, NOT withdrawn AND added <= DATE '{CENSORED}' AS live FROM a)
SELECT vuln, min(added) FILTER (WHERE live) AS first_date, count(*) AS entry_count, count(DISTINCT source) AS source_count,
  bool_and(withdrawn) AS all_withdrawn, string_agg(DISTINCT source, ',' ORDER BY source) AS canonical_sources,
  arg_min(source, (added, source, entry)) FILTER (WHERE live) AS first_source
FROM b GROUP BY vuln"""

#: dependent observer -> the one it repeats
DEPENDS = {"2-HIGH": "1-URGENT", "5-LOW": "4-NOT SPECIFIED"}


def independence_discount(spark, sf_dir):
    """Independent sources: a dependent one doesn't count where its dominant one is present."""
    a = assertions(spark, sf_dir).where(f"not withdrawn and added <= date '{CENSORED}'")
    sets = a.groupBy("vuln").agg(F.collect_set("source").alias("s"))
    off = F.array_compact(F.array(*[
        F.when(F.array_contains("s", d) & F.array_contains("s", top), F.lit(d)) for d, top in DEPENDS.items()]))
    return sets.withColumn("d", off).select(
        "vuln", F.size("s").cast("long").alias("sources"), F.size(F.array_except("s", "d")).cast("long").alias("independent_sources"),
        F.concat_ws(",", F.array_sort("d")).alias("discounted"))


_DEP = " UNION ALL ".join(f"SELECT '{d}' AS dep, '{t}' AS top" for d, t in DEPENDS.items())
_INDEPENDENCE = f"""WITH {ASSERTIONS}, d AS ({_DEP}),
s AS (SELECT DISTINCT vuln, source FROM a WHERE NOT withdrawn AND added <= DATE '{CENSORED}'),
f AS (SELECT s.vuln, s.source, t.vuln IS NOT NULL AS off FROM s LEFT JOIN d ON s.source = d.dep
  LEFT JOIN s t ON t.vuln = s.vuln AND t.source = d.top)
SELECT vuln, count(*) AS sources, count(*) FILTER (WHERE NOT off) AS independent_sources,
  coalesce(string_agg(source, ',' ORDER BY source) FILTER (WHERE off), '') AS discounted FROM f GROUP BY vuln"""


def source_agreement_jaccard(spark, sf_dir):
    """Each pair of observers: overlap of their sets, and how far apart their first dates are."""
    a = assertions(spark, sf_dir).where("not withdrawn").groupBy("source", "vuln").agg(F.min("added").alias("d"))
    sizes = a.groupBy("source").agg(F.count("*").alias("n"))
    l, r = a.toDF("source_a", "vuln", "da"), a.toDF("source_b", "vuln", "db")
    gap = F.abs(F.datediff("da", "db"))
    pairs = l.join(r, "vuln").where("source_a < source_b").groupBy("source_a", "source_b").agg(
        F.count("*").alias("shared_count"), F.count_if(gap == 0).alias("same_day"), F.count_if(gap <= 7).alias("within_7d"),
        F.percentile(gap, 0.5).alias("median_abs_date_diff"))
    n = pairs.join(F.broadcast(sizes.toDF("source_a", "na")), "source_a").join(F.broadcast(sizes.toDF("source_b", "nb")), "source_b")
    return n.select(
        "source_a", "source_b", "shared_count", (F.col("na") - F.col("shared_count")).alias("only_a"),
        (F.col("nb") - F.col("shared_count")).alias("only_b"),
        F.round(F.col("shared_count") / (F.col("na") + F.col("nb") - F.col("shared_count")), 9).alias("jaccard"),
        "same_day", "within_7d", "median_abs_date_diff")


_AGREEMENT = f"""WITH {ASSERTIONS}, m AS (SELECT source, vuln, min(added) AS d FROM a WHERE NOT withdrawn GROUP BY ALL),
n AS (SELECT source, count(*) AS n FROM m GROUP BY source),
p AS (SELECT x.source AS source_a, y.source AS source_b, count(*) AS shared_count, count(*) FILTER (WHERE x.d = y.d) AS same_day,
  count(*) FILTER (WHERE abs(x.d - y.d) <= 7) AS within_7d, quantile_cont(abs(x.d - y.d), 0.5) AS median_abs_date_diff
  FROM m x JOIN m y ON x.vuln = y.vuln AND x.source < y.source GROUP BY ALL)
SELECT source_a, source_b, shared_count, na.n - shared_count AS only_a, nb.n - shared_count AS only_b,
  round(shared_count / (na.n + nb.n - shared_count), 9) AS jaccard, same_day, within_7d, median_abs_date_diff
FROM p JOIN n na ON na.source = source_a JOIN n nb ON nb.source = source_b"""


def chapman_overlap(spark, sf_dir):
    """Capture-recapture estimate of the whole from two lists."""
    a = assertions(spark, sf_dir).where("added < date '1996-06-30'")
    one = a.where("source = '1-URGENT'").select("vuln").distinct()
    two = a.where("source = '3-MEDIUM'").select("vuln").distinct()
    counts = (
        one.agg(F.count("*").alias("n1")).crossJoin(two.agg(F.count("*").alias("n2")))
        .crossJoin(one.intersect(two).agg(F.count("*").alias("m"))))
    est = (F.col("n1") + 1) * (F.col("n2") + 1) / (F.col("m") + 1) - 1
    return counts.select("n1", "n2", "m", F.round(est, 6).alias("chapman"))


_CHAPMAN = f"""WITH {ASSERTIONS}, b AS (SELECT * FROM a WHERE added < DATE '1996-06-30'),
x AS (SELECT DISTINCT vuln FROM b WHERE source = '1-URGENT'), y AS (SELECT DISTINCT vuln FROM b WHERE source = '3-MEDIUM'),
c AS (SELECT (SELECT count(*) FROM x) AS n1, (SELECT count(*) FROM y) AS n2, (SELECT count(*) FROM (SELECT * FROM x INTERSECT SELECT * FROM y)) AS m)
SELECT n1, n2, m, round((n1 + 1) * (n2 + 1) / (m + 1) - 1, 6) AS chapman FROM c"""


def agreement_histogram(spark, sf_dir):
    a = assertions(spark, sf_dir).where("not withdrawn").groupBy("vuln").agg(F.count_distinct("source").alias("sources"))
    return a.groupBy("sources").agg(F.count("*").alias("vulns"))


_HISTOGRAM = f"""WITH {ASSERTIONS} SELECT sources, count(*) AS vulns FROM
  (SELECT vuln, count(DISTINCT source) AS sources FROM a WHERE NOT withdrawn GROUP BY vuln) GROUP BY sources"""


def latest_per_key(spark, sf_dir):
    a = assertions(spark, sf_dir)
    out = merge.last_per_key(a, ["source", "vuln"], [F.col("added").desc_nulls_last(), F.col("entry").desc()])
    return out.select("source", "vuln", "entry", "added", "withdrawn")


_LATEST = f"""WITH {ASSERTIONS} SELECT source, vuln, entry, added, withdrawn FROM a
QUALIFY row_number() OVER (PARTITION BY source, vuln ORDER BY added DESC NULLS LAST, entry DESC) = 1"""


def as_known_on(spark, sf_dir):
    """Vulnerabilities that a list had before a day, by source, and those first listed after it."""
    a = assertions(spark, sf_dir)
    known = F.col("added") < F.lit(MONTH).cast("date")
    return a.groupBy("source").agg(
        F.count_distinct(F.when(known, F.col("vuln"))).alias("known"),
        F.count_distinct("vuln").alias("ever"), F.count_if(F.col("added").isNull()).alias("undated"))


_KNOWN = f"""WITH {ASSERTIONS} SELECT source, count(DISTINCT vuln) FILTER (WHERE added < DATE '{MONTH}') AS known,
  count(DISTINCT vuln) AS ever, count(*) FILTER (WHERE added IS NULL) AS undated FROM a GROUP BY source"""


def observation_rollup(spark, sf_dir):
    o = observations(spark, sf_dir)
    return o.groupBy("vuln").agg(
        F.min("day").alias("first_observation"), F.max("day").alias("last_observation"), F.sum("n").alias("observation_count"),
        F.count_distinct("day").alias("days"), F.concat_ws(",", F.array_sort(F.collect_set("source"))).alias("sources"))


_ROLLUP = f"""WITH {OBSERVATIONS} SELECT vuln, min(day) AS first_observation, max(day) AS last_observation,
  sum(n)::BIGINT AS observation_count, count(DISTINCT day) AS days, string_agg(DISTINCT source, ',' ORDER BY source) AS sources
FROM o GROUP BY vuln"""


def cve_detail(spark, sf_dir):
    """One row per vulnerability of any table; each side is summed up before it is joined."""
    c = F.lit(CENSORED).cast("date")
    k = assertions(spark, sf_dir).where(F.col("added") <= c).groupBy("vuln").agg(
        F.min(F.when(~F.col("withdrawn"), F.col("added"))).alias("first_kev"), F.count("*").alias("entries"))
    o = observations(spark, sf_dir).groupBy("vuln").agg(F.sum("n").alias("observation_count_total"))
    p = spark.read.parquet(f"{sf_dir}/lineitem.parquet").join(
        spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey"
    ).groupBy(F.col("o_custkey").alias("vuln")).agg(F.min(F.to_date("l_shipdate")).alias("patch_date"))
    r = registry(spark, sf_dir).withColumn("in_registry", F.lit(True))
    d = r.join(k, "vuln", "full_outer").join(o, "vuln", "full_outer").join(p, "vuln", "full_outer")
    lag = F.datediff("first_kev", "patch_date")
    return d.select(
        "vuln", "score", F.coalesce("in_registry", F.lit(False)).alias("in_registry"), "first_kev",
        F.coalesce("entries", F.lit(0)).alias("entries"), F.coalesce("observation_count_total", F.lit(0)).alias("observation_count_total"),
        "patch_date", lag.alias("days_kev_after_patch"), F.coalesce(lag <= 0, F.lit(False)).alias("zero_day"))


_DETAIL = f"""WITH {ASSERTIONS}, {OBSERVATIONS}, {REGISTRY},
k AS (SELECT vuln, min(added) FILTER (WHERE NOT withdrawn) AS first_kev, count(*) AS entries FROM a WHERE added <= DATE '{CENSORED}' GROUP BY vuln),
s AS (SELECT vuln, sum(n)::BIGINT AS t FROM o GROUP BY vuln),
p AS (SELECT o_custkey AS vuln, min(CAST(l_shipdate AS DATE)) AS patch_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT vuln, score, r.segment IS NOT NULL AS in_registry, first_kev, coalesce(entries, 0) AS entries,
  coalesce(t, 0) AS observation_count_total, patch_date, first_kev - patch_date AS days_kev_after_patch,
  coalesce(first_kev - patch_date <= 0, false) AS zero_day
FROM r FULL JOIN k USING (vuln) FULL JOIN s USING (vuln) FULL JOIN p USING (vuln)"""


def explorer_strata(spark, sf_dir):
    d = cve_detail(spark, sf_dir)
    return d.agg(
        F.count_if("in_registry").alias("published"), F.count_if(F.col("first_kev").isNotNull()).alias("catalogued"),
        F.count_if(F.col("observation_count_total") > 0).alias("scanned"),
        F.count_if(F.col("first_kev").isNotNull() | (F.col("observation_count_total") > 0)).alias("listed"))


_STRATA = f"""SELECT count(*) FILTER (WHERE in_registry) AS published, count(*) FILTER (WHERE first_kev IS NOT NULL) AS catalogued,
  count(*) FILTER (WHERE observation_count_total > 0) AS scanned,
  count(*) FILTER (WHERE first_kev IS NOT NULL OR observation_count_total > 0) AS listed FROM ({_DETAIL})"""

QUERIES = {f.__name__: f for f in (
    prio_scorecard, kev_consolidated, independence_discount, source_agreement_jaccard, chapman_overlap, agreement_histogram,
    latest_per_key, as_known_on, observation_rollup, cve_detail, explorer_strata)}
ORACLE_SQL = dict(zip(QUERIES, (
    _PRIO, _CONSOLIDATED, _INDEPENDENCE, _AGREEMENT, _CHAPMAN, _HISTOGRAM, _LATEST, _KNOWN, _ROLLUP, _DETAIL, _STRATA)))
