"""Catalogues of exploited vulnerabilities, the CVE registry, scores and rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import dates
from tidewatch.functions import text as T
from tidewatch.sources import SourceError, register
from tidewatch.sources.common import clamp, documents, lines, split, urls, zip_members


@register("cisa_kev")
def cisa_kev(spark, path):
    """One document with a declared count; notes hold references."""
    doc = documents(spark, path, "catalogVersion string, dateReleased string, count int, vulnerabilities array<struct<cveID:string,"
                    "vendorProject:string,product:string,vulnerabilityName:string,dateAdded:string,shortDescription:string,dueDate:string,"
                    "knownRansomwareCampaignUse:string,notes:string,cwes:array<string>>>")
    wrong = doc.where(F.coalesce(F.size("vulnerabilities"), F.lit(0)) != F.coalesce("count", F.lit(-1)))
    if not wrong.isEmpty():
        raise SourceError("declared count differs from the entries")
    v = doc.select(F.explode("vulnerabilities").alias("v")).select("v.*")
    rows = v.select(
        F.trim("cveID").alias("source_entry_id"), T.first_cve(F.col("cveID")).alias("cve_id"), F.col("vendorProject").alias("vendor"), "product",
        dates.any_date(F.col("dateAdded")).alias("date_added"), F.when(F.col("knownRansomwareCampaignUse") == "Known", True).alias("ransomware"),
        urls(F.col("notes")).alias("urls"), clamp(F.col("cwes")).alias("cwe_ids"))
    return split(rows, (F.coalesce(T.id_namespace(F.col("source_entry_id")) != "cve", F.lit(True)), "identifier is not a CVE"), (F.col("date_added").isNull(), "no date"))


@register("euvd_kev")
def euvd_kev(spark, path):
    """Pages of items; aliases and references are line lists; an item seen on two pages counts once."""
    doc = documents(spark, path, "total int, items array<struct<id:string,description:string,datePublished:string,dateUpdated:string,"
                    "baseScore:double,baseScoreVersion:string,references:string,aliases:string,exploitedSince:string>>")
    items = doc.select(F.explode("items").alias("i")).select("i.*").dropDuplicates(["id"])
    short = doc.agg(F.max("total").alias("t")).crossJoin(items.agg(F.count("*").alias("n"))).where("n < t")
    if not short.isEmpty():
        raise SourceError("fewer items than the pages declare")
    rows = items.select(
        F.col("id").alias("source_entry_id"), T.first_cve(F.coalesce("aliases", F.lit("")), F.coalesce("description", F.lit(""))).alias("cve_id"),
        dates.any_date(F.col("exploitedSince")).alias("date_added"), F.col("baseScore").alias("score"),
        F.filter(F.split(F.coalesce("aliases", F.lit("")), r"\s*\n\s*"), lambda a: a != "").alias("aliases"), urls(F.col("references"), r"\s*\n\s*").alias("urls"))
    return split(rows, (F.col("source_entry_id").isNull(), "no identifier"))


@register("circl_kev")
def circl_kev(spark, path):
    """NDJSON: one row per piece of evidence; telemetry (honeypot, sinkhole) is no assertion."""
    good, bad = lines(spark, path, "uuid string, vulnerability struct<vulnId:string,altId:array<string>>, gcve struct<origin_uuid:string>,"
                      "timestamps struct<asserted_at:string,first_seen_at:string>, references array<string>,"
                      "evidence array<struct<type:string,source:string,signal:string,confidence:double>>")
    e = good.select("*", F.posexplode_outer("evidence").alias("k", "e"))
    rows = e.where("e is null or lower(e.type) not in ('honeypot', 'sinkhole')").select(
        F.concat_ws("#", "uuid", F.coalesce("k", F.lit(0)).cast("string")).alias("source_entry_id"),
        F.coalesce("e.source", "gcve.origin_uuid").alias("upstream_source"),
        T.first_cve(F.col("vulnerability.vulnId"), F.concat_ws(" ", "vulnerability.altId")).alias("cve_id"),
        dates.any_date(F.col("timestamps.asserted_at")).alias("date_added"), F.col("e.signal").alias("signal"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("e.confidence"))).alias("confidence"), F.col("references").alias("urls"))
    ok, refused = split(rows, (F.col("cve_id").isNull(), "no CVE"))
    return ok, bad.unionByName(refused)


@register("vulncheck_kev")
def vulncheck_kev(spark, path):
    """Backup zip or JSON page: one row per well-formed CVE of a record, known since its first report."""
    schema = "data array<struct<vendorProject:string,product:string,cve:array<string>,date_added:string,vulncheck_reported_exploitation:array<struct<url:string,date_added:string>>>>"
    if path.endswith(".zip"):
        doc = zip_members(spark, path, ".json").select(F.from_json(F.when(F.col("text").rlike(r"^\s*\["), F.concat(F.lit('{"data":'), "text", F.lit("}"))).otherwise(F.col("text")), schema).alias("d")).select("d.*")
    else:
        doc = documents(spark, path, schema)
    r = doc.select(F.explode("data").alias("d")).select("d.*").select("*", F.explode_outer("cve").alias("c"))
    since = F.array_min(F.transform("vulncheck_reported_exploitation", lambda x: dates.any_date(x["date_added"])))
    rows = r.select(
        F.concat_ws("@", F.upper(F.trim("c")), "date_added").alias("source_entry_id"), T.first_cve(F.col("c")).alias("cve_id"),
        F.col("vendorProject").alias("vendor"), "product", dates.any_date(F.col("date_added")).alias("date_added"), since.alias("exploited_since"),
        F.array_distinct(F.transform("vulncheck_reported_exploitation", lambda x: x["url"])).alias("urls"))
    return split(rows, (F.col("cve_id").isNull(), "no CVE"))


_SCORE = "struct<cvssData:struct<version:string,baseScore:double,vectorString:string>,type:string>"
_VERSIONS = ("cvssMetricV40", "cvssMetricV31", "cvssMetricV30", "cvssMetricV2")


@register("cvelist_bundle")
def cvelist_bundle(spark, path, baseline: bool = True):
    """The registry's zip (also doubly wrapped): first English description, newest score, lists of at most 20."""
    cvss = "struct<cvssV4_0:struct<baseScore:double>,cvssV3_1:struct<baseScore:double>,cvssV3_0:struct<baseScore:double>,cvssV2_0:struct<baseScore:double>>"
    schema = (f"cveMetadata struct<cveId:string,state:string,datePublished:string,dateUpdated:string>, containers struct<cna:struct<descriptions:array<struct<lang:string,value:string>>,"
              f"metrics:array<{cvss}>,problemTypes:array<struct<descriptions:array<struct<cweId:string>>>>,references:array<struct<url:string>>>>")
    files = zip_members(spark, path, ".json").where("member rlike 'CVE-[0-9]{4}-[0-9]+[.]json$'")
    if baseline and files.isEmpty():
        raise SourceError("an empty baseline")
    r = files.select("member", F.from_json("text", schema).alias("r")).select("member", "r.cveMetadata.*", "r.containers.cna.*")
    score = F.coalesce(*[F.get(F.filter(F.expr(f"transform(metrics, m -> m.{v}.baseScore)"), lambda x: x.isNotNull()), F.lit(0))
                         for v in ("cvssV4_0", "cvssV3_1", "cvssV3_0", "cvssV2_0")])
    english = F.get(F.filter("descriptions", lambda d: F.lower(d["lang"]).startswith("en")), F.lit(0))["value"]
    rows = r.select(
        F.col("cveId").alias("cve_id"), "state", dates.any_date(F.col("datePublished")).alias("date_published"), F.substring(english, 1, 8000).alias("description"),
        score.alias("score"), clamp(F.filter(F.flatten(F.transform("problemTypes", lambda p: F.transform(p["descriptions"], lambda d: d["cweId"]))), lambda c: c.startswith("CWE-"))).alias("cwe_ids"),
        clamp(F.transform("references", lambda u: u["url"])).alias("urls"), T.cve_year(F.col("cveId")).alias("cve_year"))
    return split(rows, (F.coalesce(T.id_namespace(F.col("cve_id")) != "cve", F.lit(True)), "identifier is not a CVE"))


@register("nvd_pages")
def nvd_pages(spark, path):
    """Per version the primary score, else the first; the newest version that has one wins."""
    metrics = ",".join(f"{v}:array<{_SCORE}>" for v in _VERSIONS)
    doc = documents(spark, path, f"totalResults int, vulnerabilities array<struct<cve:struct<id:string,published:string,lastModified:string,vulnStatus:string,"
                    f"descriptions:array<struct<lang:string,value:string>>,metrics:struct<{metrics}>,weaknesses:array<struct<description:array<struct<value:string>>>>>>>")
    c = doc.select(F.explode("vulnerabilities").alias("v")).select("v.cve.*")
    best = []
    for v in _VERSIONS:
        m = F.col(f"metrics.{v}")
        best.append(F.coalesce(F.get(F.filter(m, lambda x: x["type"] == "Primary"), F.lit(0)), F.get(m, F.lit(0)))["cvssData"])
    rows = c.select(
        F.col("id").alias("cve_id"), F.col("vulnStatus").alias("status"), dates.any_date(F.col("published")).alias("date_published"),
        F.coalesce(*best)["baseScore"].alias("score"), F.coalesce(*best)["version"].alias("score_version"),
        clamp(F.filter(F.flatten(F.transform("weaknesses", lambda w: F.transform(w["description"], lambda d: d["value"]))), lambda x: x.startswith("CWE-"))).alias("cwe_ids"))
    return split(rows, (F.coalesce(T.id_namespace(F.col("cve_id")) != "cve", F.lit(True)), "identifier is not a CVE"))


@register("epss_csv")
def epss_csv(spark, path):
    """Each file's first line: model version and score date (both needed). Bad, repeated and out-of-range rows are rejected, rows without an identifier too."""
    from pyspark.sql import Window

    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    head = raw.where("value like '#%'").groupBy("file").agg(
        F.max(F.nullif(F.regexp_extract("value", r"model_version:([^,\s]+)", 1), F.lit(""))).alias("model_version"),
        F.max(dates.any_date(F.regexp_extract("value", r"score_date:(\d{4}-\d{2}-\d{2})", 1))).alias("score_date")).where("model_version is not null and score_date is not null")
    if not raw.select("file").distinct().join(head, "file", "left_anti").isEmpty():
        raise SourceError("no model version or score date in the header")
    body = raw.where("value not like '#%' and trim(value) <> '' and value not like 'cve,%'").select(
        "file", F.from_csv("value", "cve string, epss string, percentile string").alias("r"))
    rows = body.join(head, "file").select(
        "file", F.upper(F.trim("r.cve")).alias("cve_id"), F.expr("try_cast(r.epss as decimal(9,6))").alias("score"),
        F.expr("try_cast(r.percentile as decimal(9,6))").alias("percentile"), "score_date", "model_version")
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("file", "cve_id").orderBy("score", "percentile")))
    good, bad = split(rows, (F.coalesce(T.id_namespace(F.col("cve_id")) != "cve", F.lit(True)), "malformed identifier"), (F.col("score").isNull() | F.col("percentile").isNull(), "not a number"),
                      (~F.col("score").between(0, 1) | ~F.col("percentile").between(0, 1), "out of range"), (F.col("copy") > 1, "repeated"))
    return good.drop("copy", "file"), bad


@register("ecb_rates")
def ecb_rates(spark, path):
    """A wide CSV of daily rates (Date, then a column per currency) as long rows."""
    wide = spark.read.csv(path, header=True)
    cols = [c for c in wide.columns if c.strip() and c.strip().lower() != "date" and not c.startswith("_c")]
    long = wide.withColumnsRenamed({c: c.strip() for c in wide.columns}).unpivot(["Date"], [c.strip() for c in cols], "currency", "rate")
    rows = long.select(dates.any_date(F.col("Date")).alias("day"), "currency", F.expr("try_cast(rate as double)").alias("rate")).where("rate is not null")
    return split(rows, (F.col("day").isNull(), "no date"), (F.col("rate") <= 0, "rate not positive"))
