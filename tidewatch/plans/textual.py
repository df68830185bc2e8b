"""Text facts, boilerplate, document kinds, similarity blocking, linkage and events over the text tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.functions import text as T
from tidewatch.operators import graph, linkage, resolve, windows
from tidewatch.operators.scratch import cut
from tidewatch.plans.tables import ASSERTIONS, OBSERVATIONS, assertions, observations, table

MARKS = r"[.!?]+|\n"


def boilerplate_sentences(spark, sf_dir):
    """Sentences in at least five documents of one source."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.explode(F.array_distinct(T.sentences(F.col("text")))).alias("sentence"))
    return d.groupBy("source", "sentence").agg(F.count_distinct("doc_id").alias("docs")).where("docs >= 5")


_BOILERPLATE = r"""WITH s AS (SELECT DISTINCT doc_id, source, trim(x) AS sentence FROM (SELECT doc_id, source, unnest(regexp_split_to_array(text, '[.!?]+|\n')) AS x FROM documents))
SELECT source, sentence, count(DISTINCT doc_id) AS docs FROM s WHERE sentence <> '' GROUP BY ALL HAVING count(DISTINCT doc_id) >= 5"""


def without_boilerplate(spark, sf_dir):
    """Sentences per document before and after boilerplate is taken out."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.explode(T.sentences(F.col("text"))).alias("sentence"))
    common = boilerplate_sentences(spark, sf_dir).select("source", "sentence", F.lit(1).alias("b"))
    return d.join(common, ["source", "sentence"], "left").groupBy("doc_id").agg(F.count("*").alias("sentences"), F.count("b").alias("boilerplate"))


_WITHOUT = f"""WITH b AS ({_BOILERPLATE}), s AS (SELECT doc_id, source, trim(x) AS sentence FROM (SELECT doc_id, source, unnest(regexp_split_to_array(text, '[.!?]+|\\n')) AS x FROM documents))
SELECT doc_id, count(*) AS sentences, count(b.docs) AS boilerplate FROM s LEFT JOIN b USING (source, sentence) WHERE sentence <> '' GROUP BY doc_id"""


def token_idf(spark, sf_dir):
    """Document frequency of each token, and whether it is rare or distinctive."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = d.agg(F.count("*").alias("docs"))
    t = d.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z0-9]+"), 0))).alias("token"))
    df = t.groupBy("token").agg(F.count("*").alias("df"))
    return df.crossJoin(F.broadcast(n)).select("token", "df", (F.col("df") <= 50).alias("rare"), (F.col("df") * 100 <= F.col("docs")).alias("distinctive"))


_IDF = """WITH t AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS token FROM documents)
SELECT token, count(*) AS df, count(*) <= 50 AS rare, count(*) * 100 <= (SELECT count(*) FROM documents) AS distinctive FROM t GROUP BY token"""


def sentence_facts(spark, sf_dir):
    """Numbers of at least four digits per document: how many, the largest, and how many look like years."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.transform(
        F.regexp_extract_all("text", F.lit(r"[0-9]{4,15}"), 0), lambda x: x.cast("long")).alias("n"))
    return d.where(F.size("n") > 0).select(
        "doc_id", F.size("n").cast("long").alias("numbers"), F.array_max("n").alias("largest"),
        F.size(F.filter("n", lambda x: x.between(1990, 2030))).cast("long").alias("years"))


_FACTS = """WITH d AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[0-9]{4,15}'), lambda x: x::BIGINT) AS n FROM documents)
SELECT doc_id, len(n)::BIGINT AS numbers, list_max(n) AS largest, len(list_filter(n, lambda x: x BETWEEN 1990 AND 2030))::BIGINT AS years FROM d WHERE len(n) > 0"""

#: (kind, pattern), the first that matches decides
KINDS = [("licence", "(?i)licen[sc]e"), ("contact", "[a-z0-9.]+@[a-z0-9.]+"), ("secret", "(?i)(password|token|secret) ?[=:]"), ("loud", "!!"), ("markup", "[#$%&*]{3}")]


def doc_kind(spark, sf_dir):
    kind = F
    for name, pattern in KINDS:
        hit = F.col("text").rlike(pattern)
        kind = F.when(hit, name) if kind is F else kind.when(hit, name)
    d = table(spark, sf_dir, "documents").select("lang", kind.otherwise("plain").alias("kind"), "n_chars")
    return d.groupBy("lang", "kind").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))


_KIND = "WITH d AS (SELECT lang, n_chars, CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in KINDS) + """ ELSE 'plain' END AS kind FROM documents)
SELECT lang, kind, count(*) AS docs, sum(n_chars)::BIGINT AS chars FROM d GROUP BY ALL"""


def rule_precision(spark, sf_dir):
    """Precision and recall of the rule 'long and plain' against the quality labels, by language."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", ((F.col("n_chars") >= 400) & ~F.col("text").rlike("[#$%&*]{3}|!!")).alias("rule"))
    j = d.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    hit = F.count_if(F.col("rule") & (F.col("quality") == 1))
    return j.groupBy("lang").agg(
        F.count("*").alias("n"), F.round(F.try_divide(hit, F.count_if("rule")), 6).alias("precision"), F.round(F.try_divide(hit, F.count_if(F.col("quality") == 1)), 6).alias("recall"))


_PRECISION = """WITH j AS (SELECT lang, n_chars >= 400 AND NOT regexp_matches(text, '[#$%&*]{3}|!!') AS rule, quality = 1 AS q FROM documents JOIN labels USING (doc_id))
SELECT lang, count(*) AS n, round(count(*) FILTER (WHERE rule AND q) / nullif(count(*) FILTER (WHERE rule), 0), 6) AS precision,
  round(count(*) FILTER (WHERE rule AND q) / nullif(count(*) FILTER (WHERE q), 0), 6) AS recall FROM j GROUP BY lang"""


def page_domains(spark, sf_dir):
    """Hosts of pages with their tags and links: domain, pages, links and headings."""
    p = table(spark, sf_dir, "pages")
    count = lambda pattern: F.sum(F.size(F.regexp_extract_all("html", F.lit(pattern), 0))).cast("long")
    return p.groupBy(T.domain_of(F.col("url")).alias("domain")).agg(
        F.count("*").alias("pages"), count("<a [^>]*href").alias("links"), count("<h[1-6]").alias("headings"))


_DOMAINS = r"""SELECT regexp_replace(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]+)', 1), '^www\.|\.$', '', 'g') AS domain, count(*) AS pages,
  sum(len(regexp_extract_all(html, '<a [^>]*href')))::BIGINT AS links, sum(len(regexp_extract_all(html, '<h[1-6]')))::BIGINT AS headings FROM pages GROUP BY 1"""


def conversation_turns(spark, sf_dir):
    """Per conversation: turns, first role, longest answer, and whether turns are numbered without a gap."""
    c = table(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(
        F.count("*").alias("turns"), F.min_by("role", "turn").alias("first_role"), F.max(F.length("text")).alias("longest"),
        ((F.max("turn") - F.min("turn") + 1) == F.count_distinct("turn")).alias("gapless"))


_TURNS = """SELECT conv_id, count(*) AS turns, arg_min(role, turn) AS first_role, max(length(text))::INT AS longest,
  max(turn) - min(turn) + 1 = count(DISTINCT turn) AS gapless FROM conversations GROUP BY conv_id"""


def trigram_pairs(spark, sf_dir):
    """Pairs of part names whose trigrams overlap by half or more, met through one of the rarer trigrams of both.

    Two names at half or more share one of their floor(n / 2) + 1 rarest trigrams, so only these are posted.
    """
    return linkage.trigram_pairs(table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("t")).distinct(), "t", 0.5)


_TRIGRAM = """WITH t AS (SELECT DISTINCT p_name || ' ' || p_type AS t FROM part), g AS (SELECT t, list_distinct(CASE WHEN length(t) >= 3
  THEN list_transform(range(1, length(t) - 1), lambda i: substr(lower(t), i, 3)) ELSE [lower(t)] END) AS g FROM t)
SELECT * FROM (SELECT a.t, b.t AS u, round(len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))), 9) AS similarity FROM g a JOIN g b ON a.t < b.t)
WHERE similarity >= 0.5"""


def _blocked(a):
    keys = [F.concat_ws("|", F.lit("s"), "vuln", "source"), F.concat_ws("|", F.lit("q"), "vuln", F.date_format(F.trunc("added", "quarter"), "yyyy-MM-dd"))]
    pairs, dropped = linkage.blocked_pairs(a.select("entry", "vuln", "source", "added", "price"), "entry", keys, F.abs(F.datediff("l.added", "r.added")) <= 365)
    return pairs.select(F.col("l.entry").alias("a"), F.col("r.entry").alias("b")), dropped


def blocked_pairs(spark, sf_dir):
    """Assertion pairs that share (customer, list) or (customer, quarter) within a year; ``blocks_dropped`` lists what is in no pair."""
    return _blocked(assertions(spark, sf_dir))[0]


def blocks_dropped(spark, sf_dir):
    """The blocks over 300 pairs that blocked_pairs (rule 'pairs') and linkage_weights and linkage_clusters (rule 'weights') leave out."""
    a = assertions(spark, sf_dir)
    return _blocked(a)[1].withColumn("rule", F.lit("pairs")).unionByName(_compared_of(a)[1].withColumn("rule", F.lit("weights")))


_BLOCKED = f"""WITH {ASSERTIONS}, x AS (SELECT * FROM a),
k AS (SELECT entry, added, 's|' || vuln || '|' || source AS key FROM x UNION ALL SELECT entry, added, 'q|' || vuln || '|' || date_trunc('quarter', added)::DATE FROM x),
z AS (SELECT key FROM k GROUP BY key HAVING count(*) * (count(*) - 1) / 2 BETWEEN 1 AND 300)
SELECT DISTINCT l.entry AS a, r.entry AS b FROM k l JOIN k r USING (key) SEMI JOIN z USING (key) WHERE l.entry < r.entry AND abs(l.added - r.added) <= 365"""

_DROPPED = f"""WITH {ASSERTIONS}, k AS (SELECT 'pairs' AS rule, 's|' || vuln || '|' || source AS block FROM a
UNION ALL SELECT 'pairs', 'q|' || vuln || '|' || date_trunc('quarter', added)::DATE FROM a
UNION ALL SELECT 'weights', vuln || '|' || date_trunc('year', added)::DATE FROM a)
SELECT block, count(*) AS n, rule FROM k GROUP BY rule, block HAVING count(*) * (count(*) - 1) / 2 > 300"""


def _compared_of(a):
    keys = [F.concat_ws("|", "vuln", F.trunc("added", "year").cast("string"))]
    pairs, dropped = linkage.blocked_pairs(a.select("entry", "vuln", "source", "added", "price"), "entry", keys)
    gap, ratio = F.abs(F.datediff("l.added", "r.added")), F.greatest("l.price", "r.price") / F.least("l.price", "r.price")
    compared = pairs.select(
        F.col("l.entry").alias("a"), F.col("r.entry").alias("b"), F.when(gap <= 30, "near").when(gap <= 120, "year").otherwise("far").alias("date_level"),
        F.when(ratio <= 1.2, "same").when(ratio <= 2, "close").otherwise("other").alias("price_level"), (F.col("l.source") == F.col("r.source")).alias("truth"))
    return compared, dropped


_COMPARED = f"""{ASSERTIONS}, x AS (SELECT *, vuln || '|' || year(added) AS key FROM a),
z AS (SELECT key FROM x GROUP BY key HAVING count(*) * (count(*) - 1) / 2 BETWEEN 1 AND 300),
p AS (SELECT l.entry AS a, r.entry AS b, abs(l.added - r.added) AS gap, greatest(l.price, r.price) / least(l.price, r.price) AS ratio, l.source = r.source AS truth
  FROM x l JOIN x r USING (key) SEMI JOIN z USING (key) WHERE l.entry < r.entry),
c AS (SELECT a, b, CASE WHEN gap <= 30 THEN 'near' WHEN gap <= 120 THEN 'year' ELSE 'far' END AS date_level,
  CASE WHEN ratio <= 1.2 THEN 'same' WHEN ratio <= 2 THEN 'close' ELSE 'other' END AS price_level, truth FROM p)"""


def _weights(c):
    w = linkage.weights(c, ["date_level", "price_level"], "truth")
    return w.select("feature", "level", *[F.round(c, 9).alias(c) for c in ("m", "u", "weight")])


def linkage_weights(spark, sf_dir):
    """Weights of date and price levels, from pairs of one customer and year; ``blocks_dropped`` lists what is in no pair."""
    return _weights(_compared_of(assertions(spark, sf_dir))[0])


_WEIGHTS = f"""WITH {_COMPARED}, l AS (SELECT 'date_level' AS feature, date_level AS level, truth FROM c UNION ALL SELECT 'price_level', price_level, truth FROM c),
n AS (SELECT feature, level, count(*) FILTER (WHERE truth) AS km, count(*) FILTER (WHERE NOT truth) AS ku FROM l GROUP BY ALL),
s AS (SELECT feature, level, (km + 1) / (sum(km) OVER w + count(*) OVER w) AS m, (ku + 1) / (sum(ku) OVER w + count(*) OVER w) AS u FROM n WINDOW w AS (PARTITION BY feature))
SELECT feature, level, round(m, 9) AS m, round(u, 9) AS u, round(log2(m / u), 9) AS weight FROM s"""


def _clusters(c):
    p = linkage.scored(c, ["a", "b"], ["date_level", "price_level"], linkage.weights(c, ["date_level", "price_level"], "truth"), 1.0)
    marked = p.join(c.select("a", "b", (F.col("price_level") == "other").alias("cannot")), ["a", "b"])
    return linkage.clusters(marked, "a", "b", auto=0.7, review=0.6)


def linkage_clusters(spark, sf_dir):
    """Scored pairs to constrained clusters (an order-dependent greedy; no SQL); ``blocks_dropped`` lists what is in no pair."""
    return _clusters(cut(_compared_of(assertions(spark, sf_dir))[0]))


def components(spark, sf_dir):
    """Documents with equal texts: each group by its smallest id."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    first = d.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    return graph.components(d.join(first, "h").where("doc_id <> first"), "doc_id", "first")


_COMPONENTS = """SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY text) AS component FROM documents
QUALIFY count(*) OVER (PARTITION BY text) > 1"""


def event_units(spark, sf_dir):
    """Events: episodes of neighbouring customers (vuln mod 50) chained by overlapping days, lone episodes too; by the smallest unit.

    Chains of overlapping intervals are the runs between days that no earlier interval reaches, so no pairs
    are made; the running maximum is over a group's distinct first days, however many episodes begin on one.
    """
    e = windows.anchored_episodes(assertions(spark, sf_dir).withColumn("group", F.pmod("vuln", F.lit(50))), ["group", "vuln"], "added", 90)
    e = e.withColumn("unit", F.col("vuln") * 1000 + F.col("episode"))
    days = e.groupBy("group", "first_day").agg(F.max("last_day").alias("last_day"), F.min("unit").alias("least"))
    w = Window.partitionBy("group").orderBy("first_day")
    reach = F.max("last_day").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("first_day") > F.col("reach"), F.lit(True)).cast("int")
    runs = days.withColumn("reach", reach).withColumn("run", F.sum(fresh).over(w))
    named = runs.withColumn("component", F.min("least").over(Window.partitionBy("group", "run"))).select("group", "first_day", "component")
    return e.join(named, ["group", "first_day"]).select(F.col("unit").alias("id"), "component")


def precedence_pick(spark, sf_dir):
    """One claim per customer: list order, then latest, then smallest id."""
    a = assertions(spark, sf_dir).withColumnRenamed("source", "basis")
    return resolve.by_precedence(a, ["vuln"], ["1-URGENT", "2-HIGH", "3-MEDIUM"], "added", "entry").select("vuln", "basis", "entry", "price")


_PRECEDENCE = f"""WITH {ASSERTIONS} SELECT vuln, source AS basis, entry, price FROM a QUALIFY row_number() OVER (PARTITION BY vuln ORDER BY
  CASE source WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 3 END, added DESC NULLS LAST, entry) = 1"""


def count_disagreement(spark, sf_dir):
    a = assertions(spark, sf_dir).withColumn("year", F.year("added"))
    return resolve.disagreements(a, ["vuln", "year"], "source", "price")


_DISAGREE = f"""WITH {ASSERTIONS} SELECT vuln, year(added)::INT AS year, count(DISTINCT source) AS sources, min(price) AS lo, max(price) AS hi,
  count(DISTINCT source) > 1 AND max(price) > min(price) * 1.10 AS disagree FROM a GROUP BY ALL"""


def tier_conflict(spark, sf_dir):
    """The best list of each customer must agree on the status, else there is a conflict to review."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("vuln"), F.substring("o_orderpriority", 1, 1).cast("int").alias("tier"), F.col("o_orderstatus").alias("status"))
    return resolve.top_tier(o, ["vuln"], "tier", "status")


_TIER = """WITH o AS (SELECT o_custkey AS vuln, o_orderpriority[1]::INT AS tier, o_orderstatus AS status FROM orders),
t AS (SELECT * FROM o QUALIFY tier = min(tier) OVER (PARTITION BY vuln))
SELECT vuln, tier, CASE WHEN count(DISTINCT status) = 1 THEN min(status) END AS status, count(DISTINCT status) > 1 AS conflict FROM t GROUP BY ALL"""


def incident_facts(spark, sf_dir):
    """One wide row per order from its lines: conditional aggregates and the fact that decided."""
    l = table(spark, sf_dir, "lineitem")
    pick = F.struct("l_shipdate", "l_linenumber", "l_partkey")
    return l.groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).cast("long").alias("returned"),
        F.count_if(F.col("l_linestatus") == "O").alias("open_lines"), F.min_by("l_partkey", pick).alias("first_part"),
        F.max_by("l_partkey", pick).alias("last_part"), F.count_distinct("l_suppkey").alias("suppliers"))


_INCIDENT = """SELECT l_orderkey, (sum(l_quantity) FILTER (WHERE l_returnflag = 'R'))::BIGINT AS returned, count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines,
  arg_min(l_partkey, (l_shipdate, l_linenumber, l_partkey)) AS first_part, arg_max(l_partkey, (l_shipdate, l_linenumber, l_partkey)) AS last_part,
  count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_orderkey"""


def first_identity(spark, sf_dir):
    """Documents by identity: same text, else same source and length."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("strong"), F.concat_ws("|", "source", "lang", "n_chars").alias("weak"))
    return resolve.first_identity(d, "doc_id", ["strong", "weak"])


_IDENTITY = """WITH d AS (SELECT doc_id, text, count(*) OVER (PARTITION BY text) AS c1, min(doc_id) OVER (PARTITION BY text) AS m1,
  count(*) OVER (PARTITION BY source, lang, n_chars) AS c2, min(doc_id) OVER (PARTITION BY source, lang, n_chars) AS m2 FROM documents)
SELECT doc_id, CASE WHEN c1 > 1 THEN m1 WHEN c2 > 1 THEN m2 ELSE doc_id END AS owner FROM d"""


def busy_victims(spark, sf_dir):
    """Sightings with at least five others of the same user within two days before: a range window over seconds of days."""
    from pyspark.sql import Window

    o = observations(spark, sf_dir).groupBy("vuln", "day").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("vuln").orderBy(F.datediff("day", F.lit("1970-01-01").cast("date"))).rangeBetween(-2, 0)
    return o.withColumn("recent", F.sum("n").over(w)).where("recent >= 10")


_BUSY = f"""WITH {OBSERVATIONS}, d AS (SELECT vuln, day, sum(n)::BIGINT AS n FROM o GROUP BY ALL),
r AS (SELECT *, (sum(n) OVER (PARTITION BY vuln ORDER BY day RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW))::BIGINT AS recent FROM d)
SELECT * FROM r WHERE recent >= 10"""

QUERIES = {f.__name__: f for f in (
    boilerplate_sentences, without_boilerplate, token_idf, sentence_facts, doc_kind, rule_precision, page_domains, conversation_turns,
    trigram_pairs, blocked_pairs, linkage_weights, components, precedence_pick, count_disagreement, tier_conflict, incident_facts,
    first_identity, busy_victims, linkage_clusters, event_units)}
ORACLE_SQL = dict(zip(QUERIES, (
    _BOILERPLATE, _WITHOUT, _IDF, _FACTS, _KIND, _PRECISION, _DOMAINS, _TURNS, _TRIGRAM, _BLOCKED, _WEIGHTS, _COMPONENTS, _PRECEDENCE,
    _DISAGREE, _TIER, _INCIDENT, _IDENTITY, _BUSY)))
QUERIES["blocks_dropped"], ORACLE_SQL["blocks_dropped"] = blocks_dropped, _DROPPED
