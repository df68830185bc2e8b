"""Verdicts on claimed victims by the evidence of their group of names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import reality
from tidewatch.operators.scratch import cut
from tidewatch.plans import matching
from tidewatch.plans.tables import assertions


def _claims(spark, sf_dir):
    o = matching.organisation_names(spark, sf_dir).select("org", "raw", "lk", "domain", "country")
    name = F.when(F.col("org") % 101 == 0, "N/A").when(F.col("org") % 97 == 0, F.concat(F.substring("raw", 1, 2), F.lit("*****"))).otherwise(F.col("raw"))
    grp = F.when(F.col("org") % 101 == 0, F.lit("n/a")).when(F.col("org") % 97 == 0, F.concat(F.lit("masked"), "org")).otherwise(F.regexp_replace("lk", " ", ""))
    return o.withColumn("name", name).withColumn("grp", grp)


def evidence_verdicts(spark, sf_dir):
    """Label, rule, domain and evidence digest of each organisation as a claimed victim; one verdict per link key, from the sites, registry entries and lists of all its bearers."""
    c = cut(_claims(spark, sf_dir))
    words = F.split("lk", " ")
    groups = c.groupBy("grp").agg(F.min("name").alias("name"), F.min("lk").alias("lk"), F.min("country").alias("country"), F.count("*").alias("n")).select(
        "grp", "name", words.alias("words"), (F.length("lk") % 6 == 0).alias("person_like"), (F.col("n") > 8).alias("weak"), "country")
    none, no = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    source = F.element_at(F.array(*[F.lit(x) for x in ("tracker_domain", "slug_guess", "official_site", "search", "leak_post")]), (F.col("org") % 5 + 1).cast("int"))
    sites = c.where("domain is not null").select(
        "grp", F.lit("site").alias("kind"), source.alias("source"), F.col("domain").alias("host"), F.when(F.col("org") % 4 == 0, "Home").otherwise(F.col("raw")).alias("title"), none.alias("entity"),
        no.alias("person"), (F.col("org") % 3 > 0).alias("live"), F.when(F.col("org") % 2 == 0, F.col("country")).alias("country"))
    entries = c.where("org % 6 = 1").select(
        "grp", F.lit("registry").alias("kind"), F.element_at(F.array(*[F.lit(x) for x in ("wikidata", "gleif", "edgar")]), (F.col("org") % 3 + 1).cast("int")).alias("source"), none.alias("host"), none.alias("title"),
        F.col("lk").alias("entity"), (F.col("org") % 12 == 1).alias("person"), no.alias("live"), F.lit(None).cast("int").alias("country"))
    lists = assertions(spark, sf_dir).where("not withdrawn").groupBy("vuln").agg(F.count_distinct("source").alias("lists")).where("lists = 5")
    others = c.join(lists, c["org"] == lists["vuln"]).select(
        "grp", F.lit("confirmed").alias("kind"), F.lit("lists").alias("source"), none.alias("host"), none.alias("title"), none.alias("entity"), no.alias("person"), no.alias("live"), F.lit(None).cast("int").alias("country"))
    evidence = cut(sites.unionByName(entries).unionByName(others))
    return reality.fanned_out(c.select(F.col("org").alias("claim"), "grp"), reality.group_verdicts(groups, evidence))


_TRACKERS = ", ".join(f"'{x}'" for x in reality.TRACKERS)
_ALLOWED = ", ".join(f"'{x}'" for x in reality.ALLOWED)
_VERDICTS = rf"""WITH {matching._NAMES}, c AS (SELECT org, raw, lk, domain, country, CASE WHEN org % 101 = 0 THEN 'N/A' WHEN org % 97 = 0 THEN substr(raw, 1, 2) || '*****' ELSE raw END AS name,
  CASE WHEN org % 101 = 0 THEN 'n/a' WHEN org % 97 = 0 THEN 'masked' || org ELSE replace(lk, ' ', '') END AS grp FROM names),
g AS (SELECT grp, min(name) AS name, string_split(min(lk), ' ') AS words, length(min(lk)) % 6 = 0 AS person_like, count(*) > 8 AS weak, min(country) AS own_country FROM c GROUP BY grp),
l AS (SELECT o_custkey AS vuln FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = 5),
e AS (SELECT grp, 'site' AS kind, ['tracker_domain', 'slug_guess', 'official_site', 'search', 'leak_post'][org % 5 + 1] AS source, domain AS host, CASE WHEN org % 4 = 0 THEN 'Home' ELSE raw END AS title, NULL::VARCHAR AS entity,
    NULL::BOOLEAN AS person, org % 3 > 0 AS live, CASE WHEN org % 2 = 0 THEN country END AS country FROM c WHERE domain IS NOT NULL
  UNION ALL SELECT grp, 'registry', ['wikidata', 'gleif', 'edgar'][org % 3 + 1], NULL, NULL, lk, org % 12 = 1, NULL, NULL FROM c WHERE org % 6 = 1
  UNION ALL SELECT grp, 'confirmed', 'lists', NULL, NULL, NULL, NULL, NULL, NULL FROM c JOIN l ON vuln = org),
i AS (SELECT DISTINCT grp, md5(concat_ws(chr(31), {", ".join(f"coalesce({x}::VARCHAR, '-')" for x in ("kind", "source", "host", "title", "entity", "person", "live", "country"))})) AS item FROM e),
k AS (SELECT grp, count(*) || ':' || sum(('0x' || substr(item, 1, 8))::BIGINT)::VARCHAR AS pack FROM i GROUP BY grp),
m AS (SELECT e.*, g.words, g.person_like, g.own_country, source IN ({_TRACKERS}) AS own, kind = 'site' AND coalesce(live, false) AND source IN ({_ALLOWED})
    AND len(list_filter(words, lambda w: NOT list_contains(regexp_split_to_array(lower(coalesce(title, '')), '[^a-z0-9]+'), w))) = 0 AS said FROM e JOIN g USING (grp)),
t AS (SELECT *, said AND (own OR NOT (len(words) = 1 AND length(words[1]) <= 4)) AND (own OR NOT person_like) AS site FROM m),
s AS (SELECT grp, count(DISTINCT CASE WHEN site THEN host END) AS hosts, min(CASE WHEN site THEN host END) AS host, count(DISTINCT CASE WHEN site AND own THEN host END) AS own_hosts, min(CASE WHEN site AND own THEN host END) AS own_host,
  count(DISTINCT CASE WHEN site THEN lower(title) END) AS titles, coalesce(bool_or(site AND coalesce(country = own_country, false)), false) AS near, coalesce(bool_or(said AND NOT own AND person_like), false) AS guarded,
  coalesce(bool_or(kind = 'registry' AND lower(entity) = array_to_string(words, ' ') AND NOT person), false) AS registered, coalesce(bool_or(kind = 'confirmed'), false) AS confirmed FROM t GROUP BY grp),
d AS (SELECT g.*, coalesce(hosts, 0) AS hosts, coalesce(own_hosts, 0) AS own_hosts, host, own_host, coalesce(hosts, 0) > 1 AND own_hosts <> 1 AND titles > 1 AS several, weak OR person_like AS shaky, near, coalesce(guarded, false) AS guarded,
  coalesce(registered, false) AS registered, coalesce(confirmed, false) AS confirmed, coalesce(pack, '0:0') AS pack FROM g LEFT JOIN s USING (grp) LEFT JOIN k USING (grp)),
v AS (SELECT *, CASE WHEN regexp_matches(lower(trim(name)), '^(test|example|unknown|n/?a|tba|tbd)\b.{{0,3}}$') THEN 'A1' WHEN contains(name, '**') THEN 'mask' WHEN hosts = 0 AND guarded THEN 'person_guard'
  WHEN several AND shaky THEN 'multi_host' WHEN several THEN 'multi_host_real' WHEN hosts > 0 THEN 'E1' WHEN registered AND NOT shaky THEN 'E2' WHEN confirmed THEN 'E3' ELSE 'none' END AS via FROM d),
w AS (SELECT *, CASE via WHEN 'A1' THEN 'not_org' WHEN 'mask' THEN 'redacted_unresolved' WHEN 'multi_host' THEN 'ambiguous' WHEN 'person_guard' THEN 'ambiguous' WHEN 'none' THEN 'ambiguous' ELSE 'real_org' END AS label FROM v)
SELECT org AS claim, label, CASE via WHEN 'A1' THEN 'placeholder' WHEN 'multi_host' THEN 'multi_candidate' WHEN 'person_guard' THEN 'no_evidence' WHEN 'none' THEN 'no_evidence' END AS subtype, via,
  CASE WHEN via = 'E1' AND (hosts = 1 OR own_hosts = 1) THEN coalesce(own_host, CASE WHEN near OR registered THEN host END) END AS domain, person_like AND label = 'ambiguous' AS person_risk, pack FROM c JOIN w USING (grp)"""

QUERIES = {"evidence_verdicts": evidence_verdicts}
ORACLE_SQL = {"evidence_verdicts": _VERDICTS}
