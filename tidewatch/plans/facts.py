"""Facts and tests over texts and claims: phrases, names in texts, scrubbing, volumes, titles, predicates, scores of extraction."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.functions import text as T
from tidewatch.operators import joins
from tidewatch.plans.tables import ASSERTIONS, OBSERVATIONS, assertions, observations, table

DAY = lambda s: F.lit(s).cast("date")
WORDS = r"[a-z0-9]+"


def gazetteer_hits(spark, sf_dir):
    """Documents that hold a known name: runs of up to three words, squashed, that equal the label of a page's host (four letters or more)."""
    parts = F.split(T.domain_of(F.col("url")), r"\.")
    names = table(spark, sf_dir, "pages").select(F.lower(F.element_at(parts, -3)).alias("name")).where(F.length("name") >= 4).distinct()
    d = table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit(WORDS), 0).alias("w"))
    runs = F.array_distinct(F.flatten(F.transform(F.array(*[F.lit(n) for n in (1, 2, 3)]), lambda n: F.when(F.size("w") >= n, F.transform(
        F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), ""))).otherwise(F.array().cast("array<string>")))))
    return d.select("doc_id", F.explode(runs).alias("name")).join(names, "name").groupBy("doc_id").agg(F.count("*").alias("names"), F.min("name").alias("first_name"))


_LABEL = r"string_split(regexp_replace(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]+)', 1), '^www\.|\.$', '', 'g'), '.')[-3]"
_GAZETTEER = f"""WITH n AS (SELECT DISTINCT name FROM (SELECT {_LABEL} AS name FROM pages) WHERE length(name) >= 4),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents),
r AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], '') AS name FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, range(1, 4) t(k)))
SELECT doc_id, count(*) AS names, min(name) AS first_name FROM r JOIN n USING (name) GROUP BY doc_id"""


def title_phrases(spark, sf_dir):
    """Headlines (the words of an order's parts in line order) that hold a victim's name in a window of up to eight words, 30 days before to 365 after."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", F.col("l_partkey").alias("p_partkey"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    t = l.join(p, "p_partkey").groupBy("l_orderkey").agg(
        F.to_date(F.min("l_shipdate")).alias("day"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "p_partkey", "p_name"))), lambda x: x["p_name"]), " ").alias("title"))
    w = F.split("title", " ")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.least(F.lit(8), F.size(w))), lambda n: F.transform(
        F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))))
    victims = p.groupBy("p_name").agg(F.min("p_partkey").alias("victim")).withColumn("seen", F.date_add(DAY("1997-01-01"), (F.col("victim") % 400).cast("int")))
    j = t.select("l_orderkey", "day", F.explode(F.array_distinct(spans)).alias("p_name")).join(victims, "p_name")
    return j.where("datediff(day, seen) between -30 and 365").groupBy("l_orderkey").agg(F.count("*").alias("victims"), F.min("victim").alias("victim"))


_PHRASES = """WITH t AS (SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS day, string_split(string_agg(p_name, ' ' ORDER BY l_linenumber, p_partkey, p_name), ' ') AS w FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
s AS (SELECT DISTINCT l_orderkey, day, array_to_string(w[i:i + n - 1], ' ') AS p_name FROM (SELECT l_orderkey, day, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM t, range(2, 9) r(n) WHERE n <= len(w))),
v AS (SELECT p_name, min(p_partkey) AS victim, DATE '1997-01-01' + (min(p_partkey) % 400)::INT AS seen FROM part GROUP BY 1)
SELECT l_orderkey, count(*) AS victims, min(victim) AS victim FROM s JOIN v USING (p_name) WHERE day - seen BETWEEN -30 AND 365 GROUP BY l_orderkey"""

#: mask, pattern: fixed values, applied in this order.
SCRUBS = [("[mail]", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), ("[secret]", r"(?i)(password|token|secret|api_?key) ?[:=] ?[A-Za-z0-9+/_.=-]{8,}"), ("[key]", r"AKIA[A-Z0-9]{12,}"),
          ("[hex]", r"[0-9a-f]{32,}"), ("[ip]", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"), ("[phone]", r"\+?[0-9][0-9 ()-]{8,}[0-9]")]


def scrubbed_texts(spark, sf_dir):
    """Texts with mails, secrets, keys, digests, addresses and numbers masked: how many of each, and the digest of what is left."""
    t = F.coalesce("text", F.lit(""))
    for mask, pattern in SCRUBS:
        t = F.regexp_replace(t, pattern, mask)
    d = table(spark, sf_dir, "documents").select("doc_id", t.alias("clean"))
    n = lambda mask: F.size(F.split("clean", "\\" + mask)) - 1
    return d.select("doc_id", *[n(m).cast("long").alias("n_" + m[1:-1]) for m, _ in SCRUBS], F.md5("clean").alias("digest")).where(
        " or ".join(f"n_{m[1:-1]} > 0" for m, _ in SCRUBS))


_T = "coalesce(text, '')"
for _mask, _pattern in SCRUBS:
    _T = f"regexp_replace({_T}, '{_pattern}', '{_mask}', 'g')"
_SCRUBBED = f"WITH c AS (SELECT doc_id, {_T} AS clean FROM documents), x AS (SELECT doc_id, " + ", ".join(
    f"(len(string_split(clean, '{m}')) - 1)::BIGINT AS n_{m[1:-1]}" for m, _ in SCRUBS) + ", md5(clean) AS digest FROM c) SELECT * FROM x WHERE " + " OR ".join(f"n_{m[1:-1]} > 0" for m, _ in SCRUBS)


def page_titles(spark, sf_dir):
    """Titles of pages cleaned as headlines: prefixes, outlet tails, ellipses and doubled titles taken off, and the label of their host."""
    raw = F.trim(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))
    t = F.regexp_replace(raw, r"(?i)^(exclusive|breaking|update[d]?|report|news|watch|live)\s*[:|-]\s*", "")
    t = F.trim(F.regexp_replace(F.regexp_replace(t, r"\s*[|-]\s*[A-Za-z0-9. ]{1,20}$", ""), r"\s*(\.\.\.|…)$", ""))
    w = F.split(F.lower(t), r"\s+")
    half = (F.size(w) / 2).cast("int")
    doubled = (F.size(w) >= 2) & (F.size(w) % 2 == 0) & (F.array_join(F.slice(w, F.lit(1), half), " ") == F.array_join(F.slice(w, half + 1, half), " "))
    kept = F.when(doubled, F.array_join(F.slice(F.split(t, r"\s+"), F.lit(1), half), " ")).otherwise(t)
    return table(spark, sf_dir, "pages").select("page_id", raw.alias("raw"), kept.alias("title"), T.registrable_label(T.domain_of(F.col("url"))).alias("label"))


_TITLES = r"""WITH r AS (SELECT page_id, url, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS raw FROM pages),
t AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(raw, '(?i)^(exclusive|breaking|update[d]?|report|news|watch|live)\s*[:|-]\s*', ''), '\s*[|-]\s*[A-Za-z0-9. ]{1,20}$', ''), '\s*(\.\.\.|…)$', '')) AS t FROM r),
w AS (SELECT *, regexp_split_to_array(lower(t), '\s+') AS w, regexp_split_to_array(t, '\s+') AS v FROM t),
h AS (SELECT *, string_split(regexp_replace(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]+)', 1), '^www\.|\.$', '', 'g'), '.') AS p FROM w)
SELECT page_id, raw, CASE WHEN len(w) >= 2 AND len(w) % 2 = 0 AND array_to_string(w[1:len(w) // 2], ' ') = array_to_string(w[len(w) // 2 + 1:len(w)], ' ') THEN array_to_string(v[1:len(v) // 2], ' ') ELSE t END AS title,
  CASE WHEN len(p) >= 3 AND length(p[-1]) = 2 AND p[-2] IN ('co', 'com', 'org', 'net', 'ac', 'gov', 'edu', 'ne', 'or', 'go') THEN p[-3] WHEN len(p) >= 2 THEN p[-2] ELSE p[1] END AS label FROM h"""

#: language, words that only it has among these; fixed values.
CUES = {"en": "the|and|of|with|that", "de": "und|der|die|nicht|ein", "fr": "le|les|des|est|une", "es": "el|los|que|una|por"}


def language_guess(spark, sf_dir):
    """Language by the most frequent of a few telling words, ties in the order of the list; against the stated one."""
    w = F.regexp_extract_all(F.lower("text"), F.lit(r"[a-zäöüßàâçéèêëîïôûñáíóú]+"), 0)
    d = table(spark, sf_dir, "documents").select("lang", w.alias("w"))
    told = lambda cues: F.size(F.filter("w", lambda x: x.isin(*cues.split("|"))))
    d = d.select("lang", *[told(cues).alias(k) for k, cues in CUES.items()])
    top = F.greatest(*CUES)
    guess = F
    for k in CUES:
        guess = guess.when((F.col(k) == top) & (top > 0), k)
    return d.withColumn("guess", guess.otherwise("und")).groupBy("lang", "guess").agg(F.count("*").alias("docs"))


_GUESS = "WITH w AS (SELECT lang, regexp_extract_all(lower(text), '[a-zäöüßàâçéèêëîïôûñáíóú]+') AS w FROM documents), n AS (SELECT lang, " + ", ".join(
    f"len(list_filter(w, lambda x: x IN ({', '.join(repr(v) for v in c.split('|'))}))) AS {k}" for k, c in CUES.items()) + f"), t AS (SELECT *, greatest({', '.join(CUES)}) AS top FROM n) " .replace("), t", " FROM w), t") + \
    "SELECT lang, CASE " + " ".join(f"WHEN {k} = top AND top > 0 THEN '{k}'" for k in CUES) + " ELSE 'und' END AS guess, count(*) AS docs FROM t GROUP BY ALL"


def scanning_predicate(spark, sf_dir):
    """Sightings that count as scanning: not purchases, a property of fifty or more, and not on the vulnerability's first day if that was backfilled (three or more at once)."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("day"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    first = e.groupBy("user_id").agg(F.min("day").alias("first"))
    size = e.groupBy("user_id", "day").agg(F.count("*").alias("n"))
    d = e.join(first, "user_id").join(size, ["user_id", "day"]).where("event_type <> 'purchase' and k >= 50 and not (day = first and n >= 3)")
    return d.groupBy("user_id").agg(F.count("*").alias("scans"), F.min("day").alias("first_scan"))


_SCANS = """WITH e AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, (props->>'$.k')::INT AS k FROM events),
x AS (SELECT *, min(day) OVER (PARTITION BY user_id) AS first, count(*) OVER (PARTITION BY user_id, day) AS n FROM e)
SELECT user_id, count(*) AS scans, min(day) AS first_scan FROM x WHERE event_type <> 'purchase' AND k >= 50 AND NOT (day = first AND n >= 3) GROUP BY user_id"""


def subset_scopes(spark, sf_dir):
    """Whether each month's emergency scope is a subset of the whole one: rows of the first without one in the second."""
    a = assertions(spark, sf_dir).withColumn("month", F.trunc("added", "month"))
    small = a.where("source = '1-URGENT'").select("month", "vuln").distinct()
    whole = a.where("source <> '5-LOW'").select("month", "vuln").distinct().withColumn("inside", F.lit(1))
    return small.join(whole, ["month", "vuln"], "left").groupBy("month").agg(F.count("*").alias("emergency"), F.count("inside").alias("inside"), (F.count("*") == F.count("inside")).alias("subset"))


_SUBSET = f"""WITH {ASSERTIONS}, s AS (SELECT DISTINCT date_trunc('month', added)::DATE AS month, vuln FROM a WHERE source = '1-URGENT'), w AS (SELECT DISTINCT date_trunc('month', added)::DATE AS month, vuln, 1 AS i FROM a WHERE source <> '5-LOW')
SELECT month, count(*) AS emergency, count(i) AS inside, count(*) = count(i) AS subset FROM s LEFT JOIN w USING (month, vuln) GROUP BY month"""


def alias_lookup(spark, sf_dir):
    """Customers and suppliers that share a number, a balance in tens, or a name in a list of aliases: three equi-joins, no nested loop."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c"), F.regexp_extract("c_name", "([0-9]+)$", 1).alias("num"), F.floor(F.col("c_acctbal") / 10).alias("bal"))
    n = F.regexp_extract("s_name", "([0-9]+)$", 1)
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"), n.alias("snum"), F.floor(F.col("s_acctbal") / 10).alias("sbal"),
                                                F.array(F.lpad((n.cast("long") + 100).cast("string"), 9, "0"), F.lpad((n.cast("long") * 2).cast("string"), 9, "0")).alias("aliases"))
    one = joins.any_key_join(c, s, [(F.col("num"), F.col("snum")), (F.col("bal"), F.col("sbal"))], "c", "s")
    known = s.select("s", F.explode("aliases").alias("num")).join(c.select("c", "num"), "num").select("c", "s")
    return one.unionByName(known).distinct()


_ALIAS = """WITH c AS (SELECT c_custkey AS c, regexp_extract(c_name, '([0-9]+)$', 1) AS num, floor(c_acctbal / 10) AS bal FROM customer),
s AS (SELECT s_suppkey AS s, regexp_extract(s_name, '([0-9]+)$', 1) AS snum, floor(s_acctbal / 10) AS sbal FROM supplier),
x AS (SELECT *, [lpad((snum::BIGINT + 100)::VARCHAR, 9, '0'), lpad((snum::BIGINT * 2)::VARCHAR, 9, '0')] AS aliases FROM s)
SELECT DISTINCT c, s FROM c JOIN x ON num = snum OR bal = sbal OR list_contains(aliases, num)"""


def money_at_rate(spark, sf_dir):
    """Prices in the first list's currency at the claim's day: the base list is one, the coin-like list has no rate, others need a rate on the last usable day.

    Rates are quoted on days with at least two lists; if the claim's list is missing on the last such day within nine, there is no answer.
    """
    a = assertions(spark, sf_dir)
    rates = a.groupBy("source", "added").agg((F.max("price") / 100_000).alias("rate"))
    quoted = rates.groupBy("added").agg(F.count("*").alias("lists")).where("lists >= 2").select("added", F.col("added").alias("quoted"), F.lit(1).alias("one"))
    d = joins.asof_backward(a.select("entry", "source", "added", "price").withColumn("one", F.lit(1)), quoted, ["one"], "added", "quoted", 9)
    j = d.drop("one").join(rates.withColumnRenamed("added", "quoted"), ["source", "quoted"], "left")
    rate = F.when(F.col("source") == "1-URGENT", 1.0).when(F.col("source") == "5-LOW", None).otherwise(F.col("rate"))
    return j.select("entry", "source", "added", "quoted", F.round(F.col("price") * rate, 4).alias("money"))


_MONEY = f"""WITH {ASSERTIONS}, r AS (SELECT source, added, max(price) / 100000 AS rate FROM a GROUP BY ALL), q AS (SELECT added AS quoted FROM r GROUP BY added HAVING count(*) >= 2),
j AS (SELECT a.*, CASE WHEN a.added - quoted <= 9 THEN quoted END AS quoted FROM a ASOF LEFT JOIN q ON a.added >= quoted)
SELECT entry, j.source, j.added, quoted, round(price * CASE j.source WHEN '1-URGENT' THEN 1.0 WHEN '5-LOW' THEN NULL ELSE rate END, 4) AS money FROM j LEFT JOIN r ON r.source = j.source AND r.added = quoted"""


def wilson_variants(spark, sf_dir):
    """Three score intervals of each part's returned share: clamped and rounded, rounded, and the raw lower end."""
    l = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("k"))
    z, n, p = 1.959964, F.col("n"), F.col("k") / F.col("n")
    mid, half, scale = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)), 1 + z * z / n
    low, high = (mid - half) / scale, (mid + half) / scale
    return l.select("l_suppkey", "n", "k", F.round(F.greatest(F.lit(0.0), low), 3).alias("low_clamped"), F.round(F.least(F.lit(1.0), high), 3).alias("high_clamped"),
                    F.round(low, 6).alias("low_rounded"), F.round(high, 6).alias("high_rounded"), low.alias("low_raw"))


_Z = "1.959964"
_LOW = f"((p + {_Z} * {_Z} / (2 * n) - {_Z} * sqrt(p * (1 - p) / n + {_Z} * {_Z} / (4 * n * n))) / (1 + {_Z} * {_Z} / n))"
_HIGH = _LOW.replace(f" - {_Z} * sqrt", f" + {_Z} * sqrt")
_WILSON3 = f"""WITH d AS (SELECT l_suppkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS k FROM lineitem GROUP BY 1), x AS (SELECT *, k / n AS p FROM d)
SELECT l_suppkey, n, k, round(greatest(0, {_LOW}), 3) AS low_clamped, round(least(1, {_HIGH}), 3) AS high_clamped, round({_LOW}, 6) AS low_rounded, round({_HIGH}, 6) AS high_rounded, {_LOW} AS low_raw FROM x"""


def field_scores(spark, sf_dir):
    """Precision and recall per field of extracted facts against the gold ones: texts equal, numbers within two per cent.

    Gold: an order's first line; extracted: its last. A side without a value has none for the field.
    """
    l = table(spark, sf_dir, "lineitem")
    pick = lambda f: l.groupBy("l_orderkey").agg(f(F.struct("l_returnflag", F.col("l_quantity").alias("q"), F.round("l_extendedprice", 0).alias("price")), F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("x"))
    g, e = pick(F.min_by).select("l_orderkey", F.col("x").alias("g")), pick(F.max_by).select("l_orderkey", F.col("x").alias("e"))
    num = lambda a, b: F.abs(a - b) <= 0.02 * F.abs(a)
    none = lambda c, ok: F.when(ok, c)
    j = g.join(e, "l_orderkey")
    rows = F.array(*[F.struct(F.lit(n).alias("field"), a.isNotNull().alias("gold"), b.isNotNull().alias("found"), F.coalesce(hit, F.lit(False)).alias("hit")) for n, a, b, hit in (
        ("flag", none(F.col("g.l_returnflag"), F.col("g.l_returnflag") != "N"), none(F.col("e.l_returnflag"), F.col("e.l_returnflag") != "N"),
         (F.col("g.l_returnflag") == F.col("e.l_returnflag")) & (F.col("g.l_returnflag") != "N")),
        ("quantity", none(F.col("g.q"), F.col("g.q") > 5), none(F.col("e.q"), F.col("e.q") > 5), num(F.col("g.q"), F.col("e.q")) & (F.col("g.q") > 5) & (F.col("e.q") > 5)),
        ("price", F.col("g.price"), F.col("e.price"), num(F.col("g.price"), F.col("e.price"))))])
    d = j.select(F.explode(rows).alias("r")).select("r.*").groupBy("field").agg(F.count_if("gold").alias("gold"), F.count_if("found").alias("found"), F.count_if("hit").alias("hit"))
    return d.select("field", "gold", "found", "hit", F.round(F.try_divide("hit", "found"), 6).alias("precision"), F.round(F.try_divide("hit", "gold"), 6).alias("recall"))


_FIELDS = """WITH x AS (SELECT l_orderkey, arg_min({'f': l_returnflag, 'q': l_quantity, 'p': round(l_extendedprice, 0)}, (l_linenumber, l_partkey, l_suppkey)) AS g,
  arg_max({'f': l_returnflag, 'q': l_quantity, 'p': round(l_extendedprice, 0)}, (l_linenumber, l_partkey, l_suppkey)) AS e FROM lineitem GROUP BY 1),
r AS (SELECT 'flag' AS field, g.f <> 'N' AS gold, e.f <> 'N' AS found, g.f = e.f AND g.f <> 'N' AS hit FROM x UNION ALL
  SELECT 'quantity', g.q > 5, e.q > 5, abs(g.q - e.q) <= 0.02 * abs(g.q) AND g.q > 5 AND e.q > 5 FROM x UNION ALL SELECT 'price', true, true, abs(g.p - e.p) <= 0.02 * abs(g.p) FROM x),
d AS (SELECT field, count(*) FILTER (WHERE gold) AS gold, count(*) FILTER (WHERE found) AS found, count(*) FILTER (WHERE hit) AS hit FROM r GROUP BY field)
SELECT *, round(hit / nullif(found, 0), 6) AS precision, round(hit / nullif(gold, 0), 6) AS recall FROM d"""


def pair_scores(spark, sf_dir):
    """Extracted (order, part) pairs against gold ones per stratum (line status): recall, leaked pairs of the other list, precision without the largest order."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linestatus", "l_returnflag")
    d = l.groupBy("l_orderkey", "l_partkey").agg(F.min("l_linestatus").alias("stratum"), F.bool_or(F.col("l_returnflag") != "N").alias("gold"), F.bool_or(F.col("l_returnflag") != "R").alias("found"))
    size = d.where("found").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    big = size.orderBy(F.desc("n"), "l_orderkey").limit(1).select("l_orderkey", F.lit(True).alias("big"))
    d = d.join(big, "l_orderkey", "left")
    hit = F.col("gold") & F.col("found")
    rest = F.col("found") & F.col("big").isNull()
    return d.groupBy("stratum").agg(
        F.round(F.try_divide(F.count_if(hit), F.count_if("gold")), 6).alias("recall"), F.round(F.try_divide(F.count_if(F.col("found") & ~F.col("gold")), F.count_if(~F.col("gold"))), 6).alias("leak"),
        F.round(F.try_divide(F.count_if(hit & F.col("big").isNull()), F.count_if(rest)), 6).alias("precision_without_largest"))


_PAIR = """WITH d AS (SELECT l_orderkey, l_partkey, min(l_linestatus) AS stratum, bool_or(l_returnflag <> 'N') AS gold, bool_or(l_returnflag <> 'R') AS found FROM lineitem GROUP BY ALL),
b AS (SELECT l_orderkey FROM d WHERE found GROUP BY 1 ORDER BY count(*) DESC, l_orderkey LIMIT 1)
SELECT stratum, round(count(*) FILTER (WHERE gold AND found) / nullif(count(*) FILTER (WHERE gold), 0), 6) AS recall, round(count(*) FILTER (WHERE found AND NOT gold) / nullif(count(*) FILTER (WHERE NOT gold), 0), 6) AS leak,
  round(count(*) FILTER (WHERE gold AND found AND l_orderkey NOT IN (SELECT l_orderkey FROM b)) / nullif(count(*) FILTER (WHERE found AND l_orderkey NOT IN (SELECT l_orderkey FROM b)), 0), 6) AS precision_without_largest FROM d GROUP BY stratum"""


def naming_sentences(spark, sf_dir):
    """Sentences of pages' texts that name the label of their host: at most eight a page, in order, each once, 20 to 400 characters."""
    body = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), r"<[^>]+>", "\n")
    d = table(spark, sf_dir, "pages").select("page_id", F.lower(F.element_at(F.split(T.domain_of(F.col("url")), r"\."), -3)).alias("name"), F.array_distinct(T.sentences(body)).alias("s"))
    x = d.select("page_id", "name", F.posexplode("s").alias("at", "sentence")).where(
        F.length("sentence").between(20, 400) & F.lower("sentence").contains(F.substring("name", 1, 4)))
    w = Window.partitionBy("page_id").orderBy("at")
    return x.withColumn("k", F.row_number().over(w)).where("k <= 8").select("page_id", "k", F.md5("sentence").alias("digest"))


_NAMING = rf"""WITH d AS (SELECT page_id, {_LABEL} AS name, regexp_split_to_array(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', chr(10), 'g'), '[.!?]+|\n') AS p FROM pages),
s AS (SELECT page_id, name, list_filter(list_transform(p, lambda x: trim(x, ' ')), lambda x: x <> '') AS s FROM d),
x AS (SELECT page_id, name, s[i] AS sentence, i FROM (SELECT page_id, name, s, unnest(range(1, len(s) + 1)) AS i FROM s) WHERE list_position(s, s[i]) = i)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) AS k, md5(sentence) AS digest FROM x WHERE length(sentence) BETWEEN 20 AND 400 AND contains(lower(sentence), substr(name, 1, 4)) QUALIFY k <= 8"""

QUERIES = {f.__name__: f for f in (
    gazetteer_hits, title_phrases, scrubbed_texts, page_titles, language_guess, scanning_predicate, subset_scopes, alias_lookup, money_at_rate, wilson_variants, field_scores,
    pair_scores, naming_sentences)}
ORACLE_SQL = dict(zip(QUERIES, (
    _GAZETTEER, _PHRASES, _SCRUBBED, _TITLES, _GUESS, _SCANS, _SUBSET, _ALIAS, _MONEY, _WILSON3, _FIELDS, _PAIR, _NAMING)))
