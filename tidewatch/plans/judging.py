"""Judgement of claims and victims: grounded facts with reasons, coarse dates, roles of vulnerabilities, reality of names, guessed hosts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import classify
from tidewatch.functions import text as T
from tidewatch.plans import matching
from tidewatch.plans.tables import ASSERTIONS, assertions, table

DAY = lambda s: F.lit(s).cast("date")


def _claims(spark, sf_dir):
    """A claim per order line with the document it is read from: one sentence a line, negated or hedged by status and flag.

    The quote is the sentence of the claim's line; for some it is cut short, or the number is another's.
    """
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").alias("q"), F.to_date("l_shipdate").alias("day"))
    verb = F.when((F.col("l_returnflag") == "N") & (F.col("q") < 10), "did not lose").when(F.col("q") > 45, "may have lost").otherwise("lost")
    sentence = F.concat(F.lit("Unit "), F.col("l_partkey").cast("string"), F.lit(" "), verb, F.lit(" "), F.col("q").cast("string"), F.lit(" records in "), F.date_format("day", "yyyy-MM"))
    d = l.withColumn("sentence", sentence)
    text = d.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "sentence"))), lambda x: x["sentence"]), ". ").alias("document"))
    quote = F.when(F.col("l_partkey") % 17 == 0, F.substring("sentence", 1, 8)).when(F.col("l_partkey") % 13 == 0, F.concat(F.col("sentence"), F.lit(" or so"))).otherwise(F.col("sentence"))
    value = F.when(F.col("l_partkey") % 11 == 0, F.col("q") + 1000).otherwise(F.col("q"))
    return d.join(text, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "day", "sentence", quote.alias("quote"), value.alias("value"), "document")


_CLAIMS = """cl0 AS (SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus, l_quantity::INT AS q, CAST(l_shipdate AS DATE) AS day, 'Unit ' || l_partkey || ' ' || CASE WHEN l_returnflag = 'N' AND l_quantity < 10 THEN 'did not lose'
    WHEN l_quantity > 45 THEN 'may have lost' ELSE 'lost' END || ' ' || l_quantity::INT || ' records in ' || strftime(l_shipdate, '%Y-%m') AS sentence FROM lineitem),
cd AS (SELECT l_orderkey, string_agg(sentence, '. ' ORDER BY l_linenumber, l_partkey, sentence) AS document FROM cl0 GROUP BY 1),
cl AS (SELECT cl0.*, document, CASE WHEN l_partkey % 17 = 0 THEN substr(sentence, 1, 8) WHEN l_partkey % 13 = 0 THEN sentence || ' or so' ELSE sentence END AS quote,
  CASE WHEN l_partkey % 11 = 0 THEN q + 1000 ELSE q END AS value FROM cl0 JOIN cd USING (l_orderkey))"""

#: (reason, condition over quote, value, document, day and status), the first that holds refuses a claim; read alike by both engines.
REASONS = [
    ("quote too short", "length(quote) < 12"), ("number not in quote", "strpos(quote || ' ', ' ' || cast(value as varchar(20)) || ' ') = 0"), ("quote not in document", "strpos(document, quote) = 0"),
    ("negated", "strpos(quote, ' not ') > 0"), ("hedged", "strpos(quote, ' may ') > 0"), ("value out of range", "value < 2 or value > 1000"),
    ("date implausible", "day < date '1993-01-01'"), ("still open", "l_linestatus = 'O' and day < date '1996-01-01'"),
]


def fact_judge(spark, sf_dir):
    """Claims with the reason for which each is refused, or accepted: the quote in the document, the number in the quote, no negation or hedge, plausible values."""
    reason = F
    for name, condition in REASONS:
        reason = reason.when(F.expr(_spark(condition)), name)
    d = _claims(spark, sf_dir).withColumn("reason", reason.otherwise("accepted"))
    return d.groupBy("reason").agg(F.count("*").alias("claims"), F.count_distinct("l_orderkey").alias("documents"), F.sum("value").cast("long").alias("total"))


def _spark(condition: str) -> str:
    """strpos(text, part) is instr in Spark."""
    return condition.replace("strpos(", "instr(").replace("varchar(20)", "string")


def claim_verdicts(spark, sf_dir):
    """Each claim with the reason for which it is refused, or accepted: grounded in its document by quote and number, not negated, then not hedged and plausible."""
    d = _claims(spark, sf_dir)
    refused = T.refused_udf("quote", "document", F.col("value").cast("double"), F.lit("records"))
    later = F
    for name, condition in REASONS[4:]:
        later = later.when(F.expr(_spark(condition)), name)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "value", F.coalesce(refused, later.otherwise("accepted")).alias("verdict"))


_GROUNDED = [("quote too short", "length(quote) < 12"), ("quote not in document", "strpos(document, quote) = 0"),
             ("number not in quote", r"NOT list_contains(list_transform(regexp_extract_all(quote, '\d+'), lambda x: x::BIGINT), value)"), ("negated", "strpos(quote, ' not ') > 0"), *REASONS[4:]]
_EACH = f"WITH {_CLAIMS} SELECT l_orderkey, l_linenumber, l_partkey, value, CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in _GROUNDED) + " ELSE 'accepted' END AS verdict FROM cl"
_JUDGE = f"WITH {_CLAIMS} SELECT CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in REASONS) + " ELSE 'accepted' END AS reason, count(*) AS claims, count(DISTINCT l_orderkey) AS documents, sum(value)::BIGINT AS total FROM cl GROUP BY 1"


def coarse_dates(spark, sf_dir):
    """Year-months that a document states in free text, as windows one month around, and whether the order's day falls into one."""
    d = _claims(spark, sf_dir).select("l_orderkey", "document").distinct()
    said = F.array_distinct(F.regexp_extract_all("document", F.lit(r"\b((?:19|20)\d\d-(?:0[1-9]|1[0-2]))\b"), 1))
    w = d.select("l_orderkey", F.explode(said).alias("m")).withColumn("lo", F.add_months(F.to_date(F.concat("m", F.lit("-01"))), -1))
    w = w.withColumn("hi", F.date_sub(F.add_months("lo", 3), 1))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("day"))
    return w.join(o, "l_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("stated"), F.min("lo").alias("first"), F.max("hi").alias("last"), F.bool_or(F.col("day").between(F.col("lo"), F.col("hi"))).alias("inside"))


_COARSE = r"""WITH m AS (SELECT DISTINCT l_orderkey, strftime(l_shipdate, '%Y-%m') AS m FROM lineitem), w AS (SELECT l_orderkey, ((m || '-01')::DATE - INTERVAL 1 MONTH)::DATE AS lo FROM m),
h AS (SELECT *, (lo + INTERVAL 3 MONTH)::DATE - 1 AS hi FROM w)
SELECT l_orderkey, count(*) AS stated, min(lo) AS first, max(hi) AS last, bool_or(CAST(o_orderdate AS DATE) BETWEEN lo AND hi) AS inside FROM h JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey"""


def vulnerability_links(spark, sf_dir):
    """Vulnerabilities tied to victims: the role an order states may only be lowered by what else is known, and links are held for a reason.

    Roles: 2 entry, 1 used, 0 mentioned. A part shipped after the order's quarter is at most mentioned; one of an open line at most used. Held: no
    incident of the customer that year by another list, or more than five vulnerabilities in the order.
    """
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("vuln"), "l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("day"))
    a = assertions(spark, sf_dir).select(F.col("entry").alias("l_orderkey"), F.col("vuln").alias("victim"), "source", "added")
    j = l.join(a, "l_orderkey")
    stated = F.when(F.col("l_returnflag") == "R", 2).when(F.col("l_returnflag") == "A", 1).otherwise(0)
    cap = F.when(F.datediff("day", "added") > 90, 0).when(F.col("l_linestatus") == "O", 1).otherwise(2)
    links = j.groupBy("victim", "vuln", "l_orderkey", "source", F.year("added").alias("year")).agg(F.max(F.least(stated, cap)).alias("role"), F.max(stated).alias("stated"))
    size = links.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    lists = a.groupBy("victim", F.year("added").alias("year")).agg(F.count_distinct("source").alias("lists"))
    held = F.when(F.col("lists") < 2, "no other source").when(F.col("n") > 5, "too many in one document")
    d = links.join(size, "l_orderkey").join(lists, ["victim", "year"]).withColumn("held", held)
    return d.groupBy("victim", "vuln").agg(F.max(F.when(F.col("held").isNull(), F.col("role"))).alias("role"), F.max("stated").alias("stated"), F.count("*").alias("links"), F.min("held").alias("held"))


_LINKS = f"""WITH {ASSERTIONS}, j AS (SELECT a.vuln AS victim, l_partkey AS vuln, l_orderkey, source, year(added) AS year, CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 1 ELSE 0 END AS stated,
  CASE WHEN CAST(l_shipdate AS DATE) - added > 90 THEN 0 WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS cap FROM lineitem JOIN a ON entry = l_orderkey),
k AS (SELECT victim, vuln, l_orderkey, source, year, max(least(stated, cap)) AS role, max(stated) AS stated FROM j GROUP BY ALL), z AS (SELECT l_orderkey, count(*) AS n FROM k GROUP BY 1),
s AS (SELECT vuln AS victim, year(added) AS year, count(DISTINCT source) AS lists FROM a GROUP BY ALL),
d AS (SELECT k.*, CASE WHEN lists < 2 THEN 'no other source' WHEN n > 5 THEN 'too many in one document' END AS held FROM k JOIN z USING (l_orderkey) JOIN s USING (victim, year))
SELECT victim, vuln, (max(role) FILTER (WHERE held IS NULL))::INT AS role, max(stated)::INT AS stated, count(*) AS links, min(held) AS held FROM d GROUP BY victim, vuln"""


def victim_reality(spark, sf_dir):
    """Whether a claimed victim is a real organisation: the first rule that decides, from the name alone to evidence of others.

    Names that hide or say nothing are refused; then a domain of its own, a registry-like list, two other lists within two years, and a name shared with
    a listed organisation confirm; what is left is unproven, and one-word names wait for a person.
    """
    o = matching.organisation_names(spark, sf_dir).select("org", "nn", "lk", "domain", "country")
    a = assertions(spark, sf_dir).groupBy(F.col("vuln").alias("org")).agg(
        F.count_distinct("source").alias("lists"), F.bool_or(F.col("source") == "1-URGENT").alias("registry"), F.datediff(F.max("added"), F.min("added")).alias("span"))
    d = o.join(a, "org", "left")
    listed = d.where("registry").groupBy("nn").agg(F.count("*").alias("alike"))
    d = d.join(listed, "nn", "left")
    verdict = (
        F.when(F.col("lists").isNull(), "refused: never claimed").when(F.length("lk") < 4, "refused: name says nothing").when(F.col("domain").isNotNull() & (F.col("lists") >= 3), "real: own domain")
        .when(F.col("registry") & F.col("country").isNotNull(), "real: registry").when((F.col("lists") >= 3) & (F.col("span") <= 730), "real: other sources")
        .when(F.coalesce("alike", F.lit(0)) > F.when(F.col("registry"), 1).otherwise(0), "real: known name").when(F.size(F.split("lk", " ")) == 1, "review: one word").otherwise("unproven"))
    return d.select("org", verdict.alias("verdict"))


_REALITY = f"""WITH {matching._NAMES}, {ASSERTIONS}, v AS (SELECT vuln AS org, count(DISTINCT source) AS lists, bool_or(source = '1-URGENT') AS registry, max(added) - min(added) AS span FROM a GROUP BY 1),
d AS (SELECT names.*, lists, registry, span FROM names LEFT JOIN v USING (org)), g AS (SELECT nn, count(*) AS alike FROM d WHERE registry GROUP BY nn)
SELECT org, CASE WHEN lists IS NULL THEN 'refused: never claimed' WHEN length(lk) < 4 THEN 'refused: name says nothing' WHEN domain IS NOT NULL AND lists >= 3 THEN 'real: own domain'
  WHEN registry AND country IS NOT NULL THEN 'real: registry' WHEN lists >= 3 AND span <= 730 THEN 'real: other sources' WHEN coalesce(alike, 0) > CASE WHEN registry THEN 1 ELSE 0 END THEN 'real: known name'
  WHEN len(string_split(lk, ' ')) = 1 THEN 'review: one word' ELSE 'unproven' END AS verdict FROM d LEFT JOIN g USING (nn)"""

ENDINGS = ("com", "org", "net", "de", "fr")


def guessed_hosts(spark, sf_dir):
    """Hosts that a name may have (words joined, dashed, first word, initials, under five endings), and the organisations whose domain's label is among them."""
    o = matching.organisation_names(spark, sf_dir).select("org", "lk", "initials", "label")
    w = F.split("lk", " ")
    slugs = F.array_distinct(F.filter(F.array(F.array_join(w, ""), F.array_join(w, "-"), F.element_at(w, 1), F.array_join(F.slice(w, 1, 2), "-"), F.col("initials")), lambda x: F.length(x) >= 3))
    ends = F.array(*[F.lit(e) for e in ENDINGS])
    hosts = F.flatten(F.transform(slugs, lambda x: F.transform(ends, lambda e: F.concat_ws(".", x, e))))
    d = o.select("org", "label", hosts.alias("hosts"))
    return d.select("org", F.size("hosts").cast("long").alias("guesses"), F.element_at("hosts", 1).alias("first_guess"),
                    F.coalesce(F.array_contains("hosts", F.concat("label", F.lit(".com"))), F.lit(False)).alias("label_guessed"))


_GUESSED = f"""WITH n AS ({matching._NAMES_SQL}), w AS (SELECT *, string_split(lk, ' ') AS w FROM n),
s AS (SELECT org, label, list_filter([array_to_string(w, ''), array_to_string(w, '-'), w[1], array_to_string(w[1:2], '-'), initials], lambda x: length(x) >= 3) AS l FROM w),
u AS (SELECT org, label, l[1] AS head, (SELECT count(DISTINCT x) FROM (SELECT unnest(l) AS x)) AS k, list_contains(l, label) AS hit FROM s)
SELECT org, (5 * k)::BIGINT AS guesses, head || '.com' AS first_guess, coalesce(hit, false) AS label_guessed FROM u"""

def filing_classes(spark, sf_dir):
    """Industry of parts by two coded columns, the band of their size, the country of their domain's ending."""
    p = table(spark, sf_dir, "part")
    sic, naics = F.col("p_partkey") * 7 % 10_000, F.col("p_partkey") * 37 % 900_000 + 110_000
    ending = F.element_at(F.array(*[F.lit(x) for x in ("com", "de", "co", "uk", "fr", "ai", "jp")]), (F.col("p_partkey") % 7 + 1).cast("int"))
    return p.select("p_partkey", classify.industry_of_sic(sic).alias("by_sic"), classify.industry_of_naics(naics).alias("by_naics"),
                    classify.size_band(F.col("p_size") * 200).alias("size_band"), classify.country_of_domain(F.concat(F.lit("x."), ending)).alias("country"))


_nul = lambda v: "NULL" if v is None else f"'{v}'"
_FILINGS = f"""WITH s(lo, hi, n) AS (VALUES {", ".join(f"({a}, {b}, {_nul(n)})" for a, b, n in classify.SIC_RANGES)}), c(prefix, n) AS (VALUES {", ".join(f"('{k}', {_nul(v)})" for k, v in classify.NAICS_PREFIXES.items())}),
p AS (SELECT p_partkey, p_size, p_partkey * 7 % 10000 AS sic, (p_partkey * 37 % 900000 + 110000)::VARCHAR AS naics, ['com', 'de', 'co', 'uk', 'fr', 'ai', 'jp'][p_partkey % 7 + 1] AS e FROM part),
bs AS (SELECT p_partkey, n FROM p JOIN s ON sic BETWEEN lo AND hi QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY hi - lo, lo) = 1),
bn AS (SELECT p_partkey, n FROM p JOIN c ON starts_with(naics, prefix) QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY length(prefix) DESC) = 1)
SELECT p_partkey, bs.n AS by_sic, bn.n AS by_naics, CASE WHEN p_size * 200 < 250 THEN 'lt_250' WHEN p_size * 200 < 5000 THEN '250_4999' ELSE '5000_plus' END AS size_band,
  CASE e WHEN 'uk' THEN 'GB' WHEN 'de' THEN 'DE' WHEN 'fr' THEN 'FR' WHEN 'jp' THEN 'JP' END AS country FROM p LEFT JOIN bs USING (p_partkey) LEFT JOIN bn USING (p_partkey)"""


def similar_names(spark, sf_dir):
    """Pairs of distinct organisation names of the same first four letters and nearly one length whose Jaro-Winkler similarity is 0.9 or more.

    No SQL: DuckDB's function halves an odd number of transpositions downwards.
    """
    n = matching.organisation_names(spark, sf_dir).select("nn").distinct().withColumn("k", F.substring("nn", 1, 4))
    o = n.select(F.col("nn").alias("other"), "k")
    pairs = n.join(o, "k").where("nn < other and abs(length(nn) - length(other)) <= 4").select("nn", "other")
    return pairs.withColumn("similarity", F.round(T.jaro_winkler_udf("nn", "other"), 6)).where("similarity >= 0.9")


QUERIES = {f.__name__: f for f in (fact_judge, coarse_dates, vulnerability_links, victim_reality, guessed_hosts, filing_classes)}
ORACLE_SQL = dict(zip(QUERIES, (_JUDGE, _COARSE, _LINKS, _REALITY, _GUESSED, _FILINGS)))
QUERIES["similar_names"] = similar_names
QUERIES["claim_verdicts"], ORACLE_SQL["claim_verdicts"] = claim_verdicts, _EACH
