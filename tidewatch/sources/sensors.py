"""Sensor series and vendor statements: sightings, never catalogue assertions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.functions import dates
from tidewatch.functions import text as T
from tidewatch.sources import SourceError, register
from tidewatch.sources.common import documents, lines, split

SERIES_LIMIT = 1000


@register("shadowserver_dashboard")
def shadowserver_dashboard(spark, path, limit: int = SERIES_LIMIT):
    """Column-oriented series: the first holds the dates; zeros say nothing; a full list may be cut and is refused."""
    doc = documents(spark, path, "data struct<x:string,columns:array<array<string>>>")
    cols = doc.select(F.posexplode("data.columns").alias("k", "c"), F.col("data.columns")[0].alias("d"))
    if not cols.groupBy().agg(F.max("k").alias("n")).where(F.col("n") >= limit).isEmpty():
        raise SourceError("as many series as the dashboard shows: the list may be cut")
    s = cols.where("k > 0").select(F.col("c")[0].alias("vuln"), F.explode(F.arrays_zip(
        F.slice("d", F.lit(2), F.size("d") - 1).alias("day"), F.slice("c", F.lit(2), F.size("c") - 1).alias("n"))).alias("x"))
    rows = s.select("vuln", T.first_cve(F.col("vuln")).alias("cve_id"), dates.any_date(F.col("x.day")).alias("day"), F.expr("try_cast(x.n as bigint)").alias("n"))
    return split(rows.where("n is null or n <> 0"), (F.col("day").isNull(), "no date"), (F.col("n").isNull(), "not a count"))


def merged_series(connections, unique_ips):
    """Two datasets of one dashboard by (vuln, day); what one lacks stays null."""
    return connections.select("vuln", "day", F.col("n").alias("connections")).join(
        unique_ips.select("vuln", "day", F.col("n").alias("unique_ips")), ["vuln", "day"], "full_outer")


@register("honeypot_ndjson")
def honeypot_ndjson(spark, path):
    """One line per vulnerability and product; the yesterday count comes as a text; yes, no and empty are three values."""
    good, bad = lines(spark, path, "vulnerability string, vendor string, product string, class string, type string, iot string, cisa_kev string,"
                      "vulnerability_score double, first_seen string, connections bigint, `1d` string, `7d_avg` double, `30d_avg` double, `90d_avg` double")
    yes = lambda c: F.when(F.lower(c).isin("yes", "y", "true"), True).when(F.lower(c).isin("no", "n", "false"), False)
    key = F.lower(F.concat_ws("|", F.coalesce("vendor", F.lit("")), F.coalesce("product", F.lit("")), F.coalesce("class", F.lit(""))))
    rows = good.select(
        F.trim("vulnerability").alias("vuln"), T.id_namespace(F.col("vulnerability")).alias("namespace"), key.alias("product_key"),
        yes(F.col("iot")).alias("iot"), yes(F.col("cisa_kev")).alias("in_kev"), F.when(F.col("vulnerability_score").between(0, 10), F.col("vulnerability_score")).alias("score"),
        dates.any_date(F.col("first_seen")).alias("first_seen"), "connections", F.expr("try_cast(`1d` as bigint)").alias("yesterday"))
    ok, refused = split(rows, (F.coalesce(F.col("vuln") == "", F.lit(True)), "no identifier"), (F.col("connections") < 0, "negative count"))
    return ok, bad.unionByName(refused)


@register("crowdsec_timeline")
def crowdsec_timeline(spark, path, upto: str | None = None):
    """Counts per UTC day; the running day is left out with ``upto``; a zero is a measured zero and stays."""
    good, bad = lines(spark, path, "cve string, timestamp timestamp, count bigint")
    d = good.groupBy(F.upper("cve").alias("cve_id"), F.to_date("timestamp").alias("day")).agg(F.sum("count").alias("n"))
    if upto:
        d = d.where(F.col("day") < F.lit(upto).cast("date"))
    ok, refused = split(d, (F.coalesce(T.id_namespace(F.col("cve_id")) != "cve", F.lit(True)), "identifier is not a CVE"))
    return ok, bad.unionByName(refused)


_CVRF = ("DocumentTracking struct<InitialReleaseDate:string,CurrentReleaseDate:string,ID:struct<Value:string>>, Vulnerability array<struct<CVE:string,"
         "Threats:array<struct<Type:int,Description:struct<Value:string>>>,RevisionHistory:array<struct<Date:string>>,Remediations:array<struct<URL:string>>>>")


def _first_revision():
    return F.array_min(F.transform("v.RevisionHistory", lambda r: dates.any_date(r["Date"])))


@register("msrc_exploited")
def msrc_exploited(spark, path):
    """Vulnerabilities whose exploit-status threat says Exploited:Yes, asserted at the first revision."""
    d = documents(spark, path, _CVRF).select("DocumentTracking", F.explode("Vulnerability").alias("v"))
    yes = F.exists("v.Threats", lambda t: (t["Type"] == 1) & t["Description"]["Value"].rlike(r"(?i)(^|;)\s*exploited\s*:\s*yes"))
    rows = d.where(yes).select(T.first_cve(F.col("v.CVE")).alias("cve_id"), F.coalesce(_first_revision(), dates.any_date(F.col("DocumentTracking.InitialReleaseDate"))).alias("asserted_at"))
    return split(rows, (F.col("cve_id").isNull(), "no CVE"))


@register("msrc_fixes")
def msrc_fixes(spark, path, days: int = 3):
    """The document's date is a fix date only for what was first documented within ``days`` of it; one row per CVE and document."""
    d = documents(spark, path, _CVRF).select("DocumentTracking", F.explode("Vulnerability").alias("v"))
    release = dates.any_date(F.col("DocumentTracking.InitialReleaseDate"))
    url = F.get(F.filter(F.transform("v.Remediations", lambda r: r["URL"]), lambda u: u.isNotNull()), F.lit(0))
    rows = d.select(T.first_cve(F.col("v.CVE")).alias("cve_id"), F.col("DocumentTracking.ID.Value").alias("document"), release.alias("patch_date"),
                    F.datediff(_first_revision(), release).alias("lag"), url.alias("url")).where(f"lag <= {days} or lag is null")
    w = Window.partitionBy("cve_id", "document").orderBy(F.col("url").isNull(), "url")
    one = rows.withColumn("k", F.row_number().over(w)).where("k = 1").drop("k", "lag")
    return split(one, (F.col("cve_id").isNull(), "no CVE"), (F.col("patch_date").isNull(), "no date"))


@register("vulncheck_canary")
def vulncheck_canary(spark, path):
    """Records that canaries flagged; the count is unknown, not zero."""
    doc = documents(spark, path, "data array<struct<cve:array<string>,reported_exploited_by_vulncheck_canaries:boolean,date_added:string,vulncheck_reported_exploitation:array<struct<date_added:string>>>>")
    r = doc.select(F.explode("data").alias("d")).select("d.*").where("reported_exploited_by_vulncheck_canaries").select("*", F.explode("cve").alias("c"))
    seen = F.array_min(F.transform("vulncheck_reported_exploitation", lambda x: dates.any_date(x["date_added"])))
    rows = r.select(T.first_cve(F.col("c")).alias("cve_id"), F.coalesce(seen, dates.any_date(F.col("date_added"))).alias("day"), F.lit(None).cast("bigint").alias("n"))
    return split(rows, (F.col("cve_id").isNull(), "no CVE"), (F.col("day").isNull(), "no date"))


@register("osm_threats")
def osm_threats(spark, path):
    """Threat records need a UUID and an aware time; of repeats the last line wins."""
    good, bad = lines(spark, path, "id string, last_updated string, package string, ecosystem string, severity string")
    aware = F.col("last_updated").rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    rows = good.withColumn("k", F.monotonically_increasing_id())
    ok, refused = split(rows, (~F.coalesce(F.lower("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"), F.lit(False)), "no UUID"), (~F.coalesce(aware, F.lit(False)), "time without a zone"))
    w = Window.partitionBy("id").orderBy(F.col("k").desc())
    last = ok.withColumn("r", F.row_number().over(w)).where("r = 1").select(F.col("id").alias("threat_id"), F.try_to_timestamp("last_updated").alias("last_updated"), "package", "ecosystem", "severity")
    return last, bad.unionByName(refused)


@register("download_counts")
def download_counts(spark, path):
    """Registry answers: ok with a count, not found, or an error; they never blend."""
    good, bad = lines(spark, path, "package string, status int, downloads bigint")
    outcome = F.when((F.col("status") == 200) & (F.col("downloads") >= 0), "ok").when(F.col("status") == 404, "not_found").otherwise("error")
    rows = good.select("package", outcome.alias("outcome"), F.when(outcome == "ok", F.col("downloads")).alias("downloads"))
    ok, refused = split(rows, (F.col("package").isNull(), "no package"))
    return ok, bad.unionByName(refused)
