"""Address lists, routing and reference data. An address never leaves a reader: it becomes its /24 at once."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from tidewatch.sources import register
from tidewatch.sources.common import lines, split

IPV4 = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"
#: First octets (and the 16-bit blocks) that are no public address.
RESERVED_8 = (0, 10, 127)
RESERVED_16 = (169 * 256 + 254, 192 * 256 + 168)


def slash24(ip: Column) -> Column:
    """The /24 index of a public IPv4 address, else null."""
    part = [F.regexp_extract(ip, IPV4, k).try_cast("int") for k in (1, 2, 3, 4)]
    valid = F.greatest(*part) <= 255
    b16 = part[0] * 256 + part[1]
    reserved = part[0].isin(*RESERVED_8) | (part[0] >= 224) | b16.isin(*RESERVED_16) | b16.between(172 * 256 + 16, 172 * 256 + 31) | (
        (part[0] == 100) & part[1].between(64, 127))
    return F.when(F.coalesce(valid & ~reserved, F.lit(False)), b16 * 256 + part[2])


def _hits(rows, source: str):
    """(source, slash24, host, categories) with the address as a digest that only counts distinct ones."""
    d = rows.select(F.lit(source).alias("source"), slash24(F.trim("ip")).alias("slash24"), F.xxhash64(F.trim("ip")).alias("host"), "categories", "ip")
    good, bad = split(d, (F.col("slash24").isNull(), "no public IPv4 address"))
    return good.drop("ip").groupBy("source", "slash24", "host").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("categories")))).alias("categories")), bad.select("reason", F.lit(None).cast("string").alias("record"))


def ip_list(spark, path, source: str, category: str):
    """One address a line; # and ; start comments."""
    t = spark.read.text(path).select(F.trim(F.regexp_replace("value", r"[#;].*$", "")).alias("ip")).where("ip <> ''")
    return _hits(t.withColumn("categories", F.array(F.lit(category))), source)


@register("blocklist")
def blocklist(spark, path):
    return ip_list(spark, path, "blocklist", "attack")


@register("ip_csv")
def ip_csv(spark, path):
    """CSV with ip and a |-separated category column."""
    d = spark.read.csv(path, header=True, schema="ip string, categories string")
    return _hits(d.withColumn("categories", F.split(F.coalesce("categories", F.lit("")), r"\|")), "ip_csv")


@register("url_hosts")
def url_hosts(spark, path):
    """Addresses that host listed urls (ip:port and urls)."""
    t = spark.read.text(path).where("value not like '#%' and trim(value) <> ''")
    ip = F.regexp_extract("value", r"(?:^|//|@|\b)((?:\d{1,3}\.){3}\d{1,3})", 1)
    return _hits(t.select(ip.alias("ip"), F.array(F.lit("hosting")).alias("categories")), "url_hosts")


@register("pfx2as")
def pfx2as(spark, path):
    """prefix, length, origins (joined by _ or ,): /8 to /24 as /24 ranges; several origins stay in order."""
    d = spark.read.csv(path, sep="\t", schema="prefix string, plen int, origins string")
    origins = F.transform(F.split("origins", "[_,]"), lambda x: x.try_cast("bigint"))
    size = F.expr("shiftleft(1L, 24 - plen)")
    rows = d.select("prefix", "plen", origins.alias("origins"), F.regexp_extract("prefix", IPV4, 1).try_cast("bigint").alias("a"),
                    F.regexp_extract("prefix", IPV4, 2).try_cast("bigint").alias("b"), F.regexp_extract("prefix", IPV4, 3).try_cast("bigint").alias("c"))
    good, bad = split(rows, (F.col("a").isNull(), "not IPv4"), (~F.col("plen").between(8, 24), "length outside /8 to /24"), (F.exists("origins", lambda x: x.isNull()), "origin is no number"))
    lo = F.floor((F.col("a") * 65536 + F.col("b") * 256 + F.col("c")) / size) * size
    return good.select(lo.alias("lo24"), (lo + size - 1).alias("hi24"), "plen", F.col("origins")[0].alias("asn"), F.slice("origins", F.lit(2), F.size("origins") - 1).alias("moas")), bad


@register("as_organisations")
def as_organisations(spark, path):
    """NDJSON of two record types: networks name their organisation; joined to one row per network."""
    good, bad = lines(spark, path, "type string, asn string, name string, organizationId string, country string")
    org = good.where("type = 'Organization'").select("organizationId", F.col("name").alias("organisation"), "country").dropDuplicates(["organizationId"])
    asn = good.where("type = 'ASN'").select(F.col("asn").cast("bigint").alias("asn"), "name", "organizationId")
    return asn.join(org, "organizationId", "left"), bad


@register("facet_counts")
def facet_counts(spark, path):
    """Facet counts by network, split by country where a facet was capped, summed again."""
    good, bad = lines(spark, path, "country string, facets array<struct<value:string,count:bigint>>")
    f = good.select(F.explode("facets").alias("f")).select(F.regexp_extract("f.value", r"(\d+)", 1).try_cast("bigint").alias("asn"), F.col("f.count").alias("n"))
    ok, refused = split(f, (F.col("asn").isNull(), "no network number"))
    return ok.groupBy("asn").agg(F.sum("n").alias("n")), bad.unionByName(refused)


@register("ranked_shares")
def ranked_shares(spark, path):
    """Ranked shares with the scope as a key: loc:XX for a country, cc:XX for its own networks."""
    good, bad = lines(spark, path, "scope string, country string, asn bigint, share double")
    key = F.concat(F.when(F.col("scope") == "location", "loc:").otherwise("cc:"), F.upper("country"))
    rows = good.select(key.alias("key"), "asn", "share")
    ok, refused = split(rows, (~F.col("share").between(0, 100), "share out of range"))
    w = Window.partitionBy("key").orderBy(F.col("share").desc(), "asn")
    return ok.withColumn("rank", F.row_number().over(w)), bad.unionByName(refused)


def per_network(hits, lookup, research):
    """(source, asn, ips, slash24s): each address once a source, research scanners out, unmapped under a null network.

    ``lookup`` is (slash24, asn), ``research`` (slash24) of scanners.
    """
    d = hits.join(research.select("slash24").distinct(), "slash24", "left_anti").join(lookup.select("slash24", "asn"), "slash24", "left")
    return d.groupBy("source", "asn").agg(F.count_distinct("host").alias("ips"), F.count_distinct("slash24").alias("slash24s"))
