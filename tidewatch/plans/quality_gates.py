"""Gate suites over the tables in their roles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import gates
from tidewatch.plans import catalogue
from tidewatch.plans.catalogue import cve_detail, kev_consolidated
from tidewatch.plans.cohorts import patch_window_bands
from tidewatch.plans.tables import CENSORED, assertions, observations, table


def results(spark, sf_dir):
    a, o = assertions(spark, sf_dir), observations(spark, sf_dir)
    k = kev_consolidated(spark, sf_dir)
    d = cve_detail(spark, sf_dir)
    bands = patch_window_bands(spark, sf_dir)
    reg = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("vuln"))
    return gates.suite([
        gates.check(a, "not_silently_empty", F.count("*"), "measured > 0"),
        gates.check(a, "all_sources_reported", F.count_distinct("source"), "measured = 5"),
        gates.none_of(a, "dates_present", F.col("added").isNull()),
        gates.none_of(a, "no_future_dates", F.col("added") > F.lit("2002-01-01").cast("date")),
        gates.unique_key(a, "entry_is_unique", ["entry"]),
        gates.no_orphans(a.select("vuln"), reg, ["vuln"], "assertions_registered"),
        gates.no_orphans(k.select("vuln"), a.select("vuln"), ["vuln"], "consolidated_has_no_orphans"),
        gates.unique_key(d, "detail_one_row_per_vuln", ["vuln"]),
        gates.none_of(d, "no_epoch_sentinels", F.col("first_kev") <= F.lit("1971-01-01").cast("date")),
        gates.check(a, "withdrawal_spike", F.avg(F.col("withdrawn").cast("int")), "measured <= 0.05", gates.WARN),
        gates.fresh(a, "added", "2001-08-15", 21, "source_not_frozen"),
        gates.none_of(bands, "bands_sum", F.col("emergency") + F.col("out_of_band") + F.col("scheduled") != F.col("attacked_within_90d")),
        gates.none_of(bands, "maturity_ordered", (F.col("maturity_0d") < F.col("maturity_29d")) | (F.col("maturity_29d") < F.col("maturity_90d"))),
        gates.none_of(o, "counts_positive", F.col("n") <= 0),
        gates.check(o, "observation_overlap", F.count_distinct("vuln"), "measured >= 0", gates.INFO),
    ])


CONSOLIDATED, DETAIL = catalogue.ORACLE_SQL["kev_consolidated"], catalogue.ORACLE_SQL["cve_detail"]
_RESULTS = f"""WITH a AS (SELECT o_orderpriority AS source, o_orderkey AS entry, o_custkey AS vuln, CAST(o_orderdate AS DATE) AS added, o_orderstatus = 'P' AS withdrawn FROM orders),
o AS (SELECT event_type AS source, user_id AS vuln, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL),
l AS (SELECT l_orderkey AS entry, min(CAST(l_shipdate AS DATE)) AS published FROM lineitem GROUP BY 1),
b AS (SELECT year(published) AS y, count(*) FILTER (WHERE added - published <= 0) + count(*) FILTER (WHERE added - published BETWEEN 1 AND 29)
  + count(*) FILTER (WHERE added - published BETWEEN 30 AND 90) AS s, count(*) FILTER (WHERE added - published <= 90) AS t,
  avg((DATE '{CENSORED}' - published >= 0)::INT) AS m0, avg((DATE '{CENSORED}' - published >= 29)::INT) AS m29, avg((DATE '{CENSORED}' - published >= 90)::INT) AS m90
  FROM a JOIN l USING (entry) GROUP BY 1),
m AS (SELECT 'not_silently_empty' AS name, 'ERROR' AS severity, count(*)::DOUBLE AS v, count(*) > 0 AS p FROM a
UNION ALL SELECT 'all_sources_reported', 'ERROR', count(DISTINCT source), count(DISTINCT source) = 5 FROM a
UNION ALL SELECT 'dates_present', 'ERROR', count(*) FILTER (WHERE added IS NULL), count(*) FILTER (WHERE added IS NULL) = 0 FROM a
UNION ALL SELECT 'no_future_dates', 'ERROR', count(*) FILTER (WHERE added > DATE '2002-01-01'), count(*) FILTER (WHERE added > DATE '2002-01-01') = 0 FROM a
UNION ALL SELECT 'entry_is_unique', 'ERROR', count(*), count(*) = 0 FROM (SELECT entry FROM a GROUP BY entry HAVING count(*) > 1)
UNION ALL SELECT 'assertions_registered', 'ERROR', count(*), count(*) = 0 FROM (SELECT vuln FROM a WHERE vuln NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'consolidated_has_no_orphans', 'ERROR', count(*), count(*) = 0 FROM ({CONSOLIDATED}) WHERE vuln NOT IN (SELECT vuln FROM a)
UNION ALL SELECT 'detail_one_row_per_vuln', 'ERROR', count(*), count(*) = 0 FROM (SELECT vuln FROM ({DETAIL}) GROUP BY vuln HAVING count(*) > 1)
UNION ALL SELECT 'no_epoch_sentinels', 'ERROR', count(*), count(*) = 0 FROM a WHERE added <= DATE '1971-01-01'
UNION ALL SELECT 'withdrawal_spike', 'WARN', avg(withdrawn::INT), avg(withdrawn::INT) <= 0.05 FROM a
UNION ALL SELECT 'source_not_frozen', 'WARN', DATE '2001-08-15' - max(added), DATE '2001-08-15' - max(added) BETWEEN 0 AND 21 FROM a
UNION ALL SELECT 'bands_sum', 'ERROR', count(*) FILTER (WHERE s <> t), count(*) FILTER (WHERE s <> t) = 0 FROM b
UNION ALL SELECT 'maturity_ordered', 'ERROR', count(*) FILTER (WHERE m0 < m29 OR m29 < m90), count(*) FILTER (WHERE m0 < m29 OR m29 < m90) = 0 FROM b
UNION ALL SELECT 'counts_positive', 'ERROR', count(*) FILTER (WHERE n <= 0), count(*) FILTER (WHERE n <= 0) = 0 FROM o
UNION ALL SELECT 'observation_overlap', 'INFO', count(DISTINCT vuln), true FROM o)"""


def gate_results(spark, sf_dir):
    return results(spark, sf_dir).withColumn("measured", F.round("measured", 9))


def gate_summary(spark, sf_dir):
    return gates.summary(results(spark, sf_dir))


QUERIES = {"gate_results": gate_results, "gate_summary": gate_summary}
ORACLE_SQL = {
    "gate_results": _RESULTS + " SELECT name, severity, p AS passed, round(v, 9) AS measured FROM m",
    "gate_summary": _RESULTS + " SELECT severity, count(*) AS checks, count(*) FILTER (WHERE NOT p) AS failed, bool_or(NOT p AND severity = 'ERROR') AS blocking FROM m GROUP BY severity",
}
