"""Readers as queries: files are written from the tables in a feed's own format and read back by its reader, rejects counted."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import sources
from tidewatch.operators import export
from tidewatch.operators.scratch import new_path
from tidewatch.plans import catalogue
from tidewatch.plans.tables import ASSERTIONS, OBSERVATIONS, assertions, observations, table
from tidewatch.sources import networks

CVE = lambda n: F.concat(F.lit("CVE-2020-"), F.lpad(n.cast("string"), 6, "0"))
_CVE = "'CVE-2020-' || lpad({0}::VARCHAR, 6, '0')"


def _lines(df, spark, name):
    path = new_path(spark, name)
    df.write.text(path)
    return path


def read_catalogue(spark, sf_dir):
    """Catalogue documents, one a year, each with its declared count; entries of one list have no CVE and are rejected."""
    a = assertions(spark, sf_dir).where("source in ('1-URGENT', '5-LOW') and not withdrawn")
    cve = F.when(F.col("source") == "5-LOW", F.concat(F.lit("X-"), F.col("entry").cast("string"))).otherwise(CVE(F.col("entry")))
    v = F.struct(cve.alias("cveID"), F.col("source").alias("vendorProject"), F.date_format("added", "yyyy-MM-dd").alias("dateAdded"),
                 F.concat(F.lit("https://a.example/"), F.col("vuln").cast("string"), F.lit(", text; https://b.example/")).alias("notes"))
    # a document is a month of one list: bounded, as in the feed
    docs = a.groupBy(F.year("added").alias("year"), F.month("added").alias("month")).agg(F.collect_list(v).alias("vulnerabilities")).withColumn("count", F.size("vulnerabilities"))
    path = new_path(spark, "catalogue")
    docs.repartition("year", "month").write.partitionBy("year", "month").json(path)
    good, bad = sources.reader("cisa_kev")(spark, path)
    return good.groupBy("date_added").agg(F.count("*").alias("entries"), F.min("cve_id").alias("first_cve"), F.sum(F.size("urls")).alias("urls")).crossJoin(
        F.broadcast(bad.agg(F.count("*").alias("rejected"))))


_CATALOGUE = f"""WITH {ASSERTIONS}, x AS (SELECT * FROM a WHERE source IN ('1-URGENT', '5-LOW') AND NOT withdrawn)
SELECT added AS date_added, count(*) AS entries, min({_CVE.format('entry')}) AS first_cve, count(*) * 2 AS urls, (SELECT count(*) FROM x WHERE source = '5-LOW') AS rejected
FROM x WHERE source = '1-URGENT' GROUP BY added"""


def read_timeline(spark, sf_dir):
    """Timelines as lines of JSON, summed per UTC day up to a running day; lines of one type are no JSON."""
    e = table(spark, sf_dir, "events").select("event_type", F.to_json(F.struct(CVE(F.col("user_id")).alias("cve"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
                                                                                F.lit(2).alias("count"))).alias("j"))
    path = _lines(e.select(F.when(F.col("event_type") == "purchase", F.concat(F.lit("#"), "j")).otherwise(F.col("j")).alias("value")), spark, "timeline")
    from tidewatch.sources import sensors

    good, bad = sensors.crowdsec_timeline(spark, path, upto="2024-01-30")
    return good.crossJoin(F.broadcast(bad.agg(F.count("*").alias("rejected"))))


_TIMELINE = f"""SELECT {_CVE.format('user_id')} AS cve_id, CAST(ts AS DATE) AS day, (2 * count(*))::BIGINT AS n, (SELECT count(*) FROM events WHERE event_type = 'purchase') AS rejected
FROM events WHERE event_type <> 'purchase' AND CAST(ts AS DATE) < DATE '2024-01-30' GROUP BY ALL"""


def read_downloads(spark, sf_dir):
    """Registry answers as lines of JSON: found, not found and errors by status."""
    p = table(spark, sf_dir, "part").select(F.to_json(F.struct(
        F.concat_ws("-", "p_name", "p_partkey").alias("package"), F.when(F.col("p_size") < 40, 200).when(F.col("p_size") < 45, 404).otherwise(503).alias("status"),
        F.col("p_size").cast("long").alias("downloads"))).alias("value"))
    good, _ = sources.reader("download_counts")(spark, _lines(p, spark, "downloads"))
    return good


_DOWNLOADS = """SELECT p_name || '-' || p_partkey AS package, CASE WHEN p_size < 40 THEN 'ok' WHEN p_size < 45 THEN 'not_found' ELSE 'error' END AS outcome,
  CASE WHEN p_size < 40 THEN p_size::BIGINT END AS downloads FROM part"""


def read_blocklist(spark, sf_dir):
    """A block list of addresses (private ones are rejected) against a routing table of prefixes with their origins: addresses and /24s per network."""
    l = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.concat_ws(
        ".", F.when(F.col("l_linenumber") == 1, 10).otherwise(20), F.col("l_suppkey") % 200, F.floor(F.col("l_partkey") / 250) % 250, F.col("l_partkey") % 250).alias("value"))
    hits, bad = sources.reader("blocklist")(spark, _lines(l, spark, "blocklist"))
    s = table(spark, sf_dir, "supplier").where("s_acctbal >= 0").select(F.concat(
        F.lit("20."), (F.col("s_suppkey") % 200).cast("string"), F.lit(".0.0\t16\t"), F.col("s_suppkey").cast("string"), F.lit("_"), (F.col("s_suppkey") + 7).cast("string")).alias("value"), "s_suppkey")
    one = s.groupBy(F.col("s_suppkey") % 200).agg(F.min_by("value", "s_suppkey").alias("value")).select("value")
    routes, _ = sources.reader("pfx2as")(spark, _lines(one, spark, "routes"))
    lookup = routes.select(F.explode(F.sequence("lo24", "hi24")).alias("slash24"), "asn")
    return networks.per_network(hits, lookup, lookup.select("slash24").limit(0)).crossJoin(F.broadcast(bad.agg(F.count("*").alias("rejected"))))


_BLOCKLIST = """WITH l AS (SELECT l_linenumber = 1 AS private, l_suppkey % 200 AS b, l_partkey // 250 % 250 AS c, l_partkey % 250 AS d FROM lineitem WHERE l_returnflag = 'R'),
s AS (SELECT s_suppkey % 200 AS b, min(s_suppkey) AS asn FROM supplier WHERE s_acctbal >= 0 GROUP BY 1)
SELECT 'blocklist' AS source, asn, count(DISTINCT (b, c, d)) AS ips, count(DISTINCT (b, c)) AS slash24s, (SELECT count(*) FROM l WHERE private) AS rejected FROM l LEFT JOIN s USING (b) WHERE NOT private GROUP BY asn"""


def read_scores(spark, sf_dir):
    """Score files of two days, each with its own header; malformed, repeated and out-of-range rows are rejected."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.round((F.col("c_acctbal") + 1000) / 10999, 6).alias("s"), "c_nationkey")
    path = new_path(spark, "scores")
    for day, model in (("2024-03-01", "v1"), ("2024-03-02", "v2")):
        cve = F.when(F.col("c_nationkey") == 3, F.lit("bad")).otherwise(CVE(F.col("c_custkey")))
        row = F.concat_ws(",", cve, F.when(F.col("c_nationkey") == 4, F.lit("x")).otherwise(F.format_string("%.6f", F.col("s"))), F.lit("0.5"))
        head = spark.createDataFrame([(f"#model_version:{model},score_date:{day}T00:00:00+0000",), ("cve,epss,percentile",)], "value string")
        # a feed's file is one file: the header has to come first
        head.coalesce(1).unionByName(c.select(row.alias("value"))).coalesce(1).write.mode("append").text(path)
    good, bad = sources.reader("epss_csv")(spark, path)
    return good.select("cve_id", F.col("score").cast("double").alias("score"), "score_date", "model_version").crossJoin(F.broadcast(bad.agg(F.count("*").alias("rejected"))))


_SCORES = f"""WITH c AS (SELECT c_custkey, round((c_acctbal + 1000) / 10999, 6) AS s, c_nationkey AS n FROM customer), d(score_date, model_version) AS (VALUES (DATE '2024-03-01', 'v1'), (DATE '2024-03-02', 'v2'))
SELECT {_CVE.format('c_custkey')} AS cve_id, s AS score, score_date, model_version, (SELECT 2 * count(*) FILTER (WHERE n IN (3, 4) OR NOT (s BETWEEN 0 AND 1)) FROM c) AS rejected
FROM c, d WHERE n NOT IN (3, 4) AND s BETWEEN 0 AND 1"""


def read_evidence(spark, sf_dir):
    """Evidence lines of several pieces each; telemetry is left out, confidence is clamped, lines without a CVE are rejected."""
    a = assertions(spark, sf_dir).where("source <> '3-MEDIUM'")
    kind = F.when(F.col("withdrawn"), "Honeypot").otherwise("report")
    piece = lambda k, c: F.struct(k.alias("type"), F.col("source").alias("source"), F.lit("seen").alias("signal"), c.alias("confidence"))
    cve = F.when(F.col("source") == "5-LOW", F.lit("none")).otherwise(CVE(F.col("vuln")))
    j = F.to_json(F.struct(F.concat(F.lit("u"), F.col("entry").cast("string")).alias("uuid"), F.struct(cve.alias("vulnId")).alias("vulnerability"),
                           F.struct(F.date_format("added", "yyyy-MM-dd").alias("asserted_at")).alias("timestamps"),
                           F.array(piece(F.lit("report"), F.col("price") / 400_000), piece(kind, F.lit(-1.0))).alias("evidence")))
    good, bad = sources.reader("circl_kev")(spark, _lines(a.select(j.alias("value")), spark, "evidence"))
    return good.groupBy("cve_id").agg(F.count("*").alias("pieces"), F.min("date_added").alias("first"), F.round(F.sum("confidence"), 6).alias("confidence")).crossJoin(
        F.broadcast(bad.agg(F.count("*").alias("rejected"))))


_EVIDENCE = f"""WITH {ASSERTIONS}, x AS (SELECT * FROM a WHERE source <> '3-MEDIUM'), e AS (SELECT *, least(1.0, price / 400000) AS c FROM x UNION ALL SELECT *, 0.0 FROM x WHERE NOT withdrawn)
SELECT {_CVE.format('vuln')} AS cve_id, count(*) AS pieces, min(added) AS first, round(sum(c), 6) AS confidence, (SELECT count(*) FROM e WHERE source = '5-LOW') AS rejected FROM e WHERE source <> '5-LOW' GROUP BY vuln"""


def export_manifest(spark, sf_dir):
    """The consolidated catalogue and the rollup written as ordered, gzipped CSV, read back: rows and sums from the files themselves."""
    path = new_path(spark, "export")
    k = catalogue.kev_consolidated(spark, sf_dir).select("vuln", "first_date", "entry_count", "source_count")
    o = observations(spark, sf_dir)
    m = export.exported({"catalogue": (k, ["vuln"]), "sightings": (o, ["source", "vuln", "day"])}, path, "2000-12-31", {"catalogue": "1"})
    back = spark.read.csv(f"{path}/catalogue", header=True, inferSchema=True).agg(F.count("*").alias("r"), F.sum("entry_count").cast("long").alias("total")).select(
        F.lit("catalogue").alias("name"), "r", "total").unionByName(spark.read.csv(f"{path}/sightings", header=True, inferSchema=True).agg(
            F.count("*").alias("r"), F.sum("n").cast("long").alias("total")).select(F.lit("sightings").alias("name"), "r", "total"))
    return m.join(back, "name").select("name", "rows", "columns", "total", "censored", (F.col("r") == F.col("rows")).alias("complete"))


_EXPORT = f"""WITH {ASSERTIONS}, {OBSERVATIONS} SELECT 'catalogue' AS name, count(DISTINCT vuln) AS rows, 'vuln,first_date,entry_count,source_count' AS columns, count(*) AS total, '2000-12-31' AS censored, true AS complete FROM a
UNION ALL SELECT 'sightings', count(*), 'source,vuln,day,n', sum(n)::BIGINT, '2000-12-31', true FROM o"""

QUERIES = {f.__name__: f for f in (read_catalogue, read_timeline, read_downloads, read_blocklist, read_scores, read_evidence, export_manifest)}
ORACLE_SQL = dict(zip(QUERIES, (_CATALOGUE, _TIMELINE, _DOWNLOADS, _BLOCKLIST, _SCORES, _EVIDENCE, _EXPORT)))
