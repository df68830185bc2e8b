"""Names of organisations and actors: likeness, names of posts, one spelling, aliases."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import likeness, naming
from tidewatch.operators.scratch import cut, stored
from tidewatch.plans import matching
from tidewatch.plans.tables import table


def _names(spark, sf_dir):
    """(name, nn, lk, toks, aliases, orgs): the names of organisations with a word of their number, and the initials of every third as an alias."""
    o = matching.organisation_names(spark, sf_dir)
    word = F.concat(F.lit("v"), F.translate((F.floor(F.col("org") / 4) + 1000).cast("string"), "0123456789", "abcdefghij"))
    d = o.select(F.concat_ws(" ", "nn", word).alias("nn"), F.concat_ws(" ", "lk", word).alias("lk"), F.when(F.col("org") % 3 == 0, F.concat("initials", word)).alias("alias"), "org")
    return d.groupBy(F.col("nn").alias("name"), "lk").agg(F.count("*").alias("orgs"), F.array_sort(F.collect_set("alias")).alias("aliases")).select(
        "name", F.col("name").alias("nn"), "lk", F.split("lk", " ").alias("toks"), "aliases", "orgs")


def _levels(spark, sf_dir):
    """Of all pairs that share their first two words and the first three letters of the last one."""
    key = F.concat_ws(" ", F.array_join(F.slice("toks", 1, 2), " "), F.substring(F.element_at("toks", -1), 1, 3))
    return likeness.levels_within(naming.weighed(cut(_names(spark, sf_dir))), key)


def name_levels(spark, sf_dir):
    """Level of likeness of names that begin alike (kin, abbreviations and runs of initials; no SQL, tested against all pairs of a small table)."""
    return _levels(spark, sf_dir).select("l", "r", "level")


def soft_names(spark, sf_dir):
    """Soft likeness of names that begin alike: words by rarity, each beside its most similar one."""
    return _levels(spark, sf_dir).select("l", "r", F.round("soft", 6).alias("soft"))


_WORD = "'v' || translate((org // 4 + 1000)::VARCHAR, '0123456789', 'abcdefghij')"
_SOFT = f"""WITH {matching._NAMES}, w AS (SELECT nn || ' ' || {_WORD} AS name, lk || ' ' || {_WORD} AS lk FROM names),
g AS (SELECT name, lk, count(*) AS orgs, string_split(lk, ' ') AS toks FROM w GROUP BY name, lk),
u AS (SELECT DISTINCT name, orgs, unnest(toks) AS t FROM g), df AS (SELECT t, sum(orgs) AS df FROM u GROUP BY t),
x AS (SELECT name, t, ln((SELECT sum(orgs) FROM g) / df) + 1e-9 AS w FROM u JOIN df USING (t)), z AS (SELECT name, sqrt(sum(w * w)) AS norm FROM x GROUP BY name),
k AS (SELECT name, array_to_string(toks[1:2], ' ') || ' ' || substr(toks[-1], 1, 3) AS k FROM g),
p AS (SELECT DISTINCT a.name AS l, b.name AS r FROM k a JOIN k b ON a.k = b.k AND a.name < b.name),
s AS (SELECT p.l, p.r, a.t, a.w, b.w AS v, b.t AS u, CASE WHEN a.t = b.t THEN 1 WHEN least(length(a.t), length(b.t)) >= 4 AND a.t[1] = b.t[1]
    AND jaro_winkler_similarity(least(a.t, b.t), greatest(a.t, b.t)) >= 0.9 THEN jaro_winkler_similarity(least(a.t, b.t), greatest(a.t, b.t)) ELSE 0 END AS sim
  FROM p JOIN x a ON a.name = p.l JOIN x b ON b.name = p.r),
b AS (SELECT l, r, w, v, sim FROM s QUALIFY row_number() OVER (PARTITION BY l, r, t ORDER BY sim DESC, u) = 1)
SELECT l, r, round(sum(w * v * sim) / (max(zl.norm) * max(zr.norm)), 6) AS soft FROM b JOIN z zl ON zl.name = l JOIN z zr ON zr.name = r GROUP BY l, r"""


def _posts(spark, sf_dir):
    """Documents as leak posts: their first words as a name within a decorated title, the whole text below it."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    words = F.slice(F.filter(F.split(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\p{L} \n]", ""), r"\s+"), lambda w: w != ""), 1, 3)
    name = F.initcap(F.array_join(words, " "))
    form = F.element_at(F.array(F.concat(F.lit("[LEAKED] "), name), F.concat(name, F.lit(" Hacked")), F.concat(name, F.lit(" - full leak")), name), (F.col("doc_id") % 4 + 1).cast("int"))
    return d.select(F.col("doc_id").alias("post"), F.col("source").alias("grp"), form.alias("title"), F.col("text").alias("body"), F.col("source").alias("actor"), F.lit(None).cast("string").alias("domain"))


def post_names(spark, sf_dir):
    """The name that each post is about, by stored answers on its candidates, in one spelling per source (no SQL; tested on cases and against plain votes)."""
    known = matching.organisations(spark, sf_dir).select(F.col("raw").alias("name")).distinct()
    offered = stored(naming.offered(_posts(spark, sf_dir), known))
    # stored answers are derived from the ids
    p = F.conv(F.substring(F.md5(F.concat_ws("|", "post", "place")), 1, 6), 16, 10).cast("long") % 1000 / 1000
    made = naming.decisions(offered, offered.select("post", "place", F.when(F.col("place") == 1, F.greatest(p, F.lit(0.75))).otherwise(p * 0.72).alias("p")))
    made = stored(made)
    named = naming.canonical(made.select("post", "grp", "chosen"))
    return made.select("post", "grp", "reason", "chosen").join(named.select("post", "name"), "post", "left")


def canonical_names(spark, sf_dir):
    """One spelling per list and organisation of the names that orders were filed under."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("post"), F.col("o_orderpriority").alias("grp"), F.col("o_custkey").alias("org"))
    raw = F.concat_ws(" ", F.initcap(F.concat(F.lit("v"), F.translate((F.floor(F.col("org") / 4) + 1000).cast("string"), "0123456789", "abcdefghij"))), "raw")
    d = o.join(matching.organisations(spark, sf_dir).select("org", "raw"), "org").withColumn("raw", raw)
    form = F.element_at(F.array(F.col("raw"), F.upper("raw"), F.concat("raw", F.lit(" Holdings")), F.lower("raw"), F.col("raw")), (F.col("post") % 5 + 1).cast("int"))
    return naming.canonical(d.select("post", "grp", form.alias("chosen")))


_END = r"[,\s]+(?:inc|llc|ltd|limited|gmbh|corp|corporation|co|plc|s\.?a|ag|bv|nv|pty)\.?$"
_CORE = rf"regexp_replace(lower(regexp_replace(trim({{0}}), '(?i){_END}', '')), '[^a-z0-9]', '', 'g')"
_CANONICAL = rf"""WITH {matching._ORGS}, v AS (SELECT org, upper(w[1]) || lower(w[2:]) || ' ' || raw AS raw FROM (SELECT *, {_WORD} AS w FROM orgs)),
d AS (SELECT o_orderkey AS post, o_orderpriority AS grp, [raw, upper(raw), raw || ' Holdings', lower(raw), raw][o_orderkey % 5 + 1] AS chosen FROM orders JOIN v ON org = o_custkey),
n AS (SELECT grp, chosen AS s, {_CORE.format('chosen')} AS k, count(DISTINCT post) AS n FROM d GROUP BY ALL),
w AS (SELECT * FROM n WHERE lower(s) <> s AND NOT (upper(s) = s AND length(replace(s, ' ', '')) > 5) AND NOT regexp_matches(s, '(?i)^(?:[a-z0-9-]+\.)+[a-z]{{2,24}}$')),
b AS (SELECT a.grp, a.s AS chosen, a.n AS own, arg_max(w.s, (w.n, len(string_split(w.s, ' ')), -length(w.s), w.s)) AS best, max(w.n) AS n FROM n a JOIN w ON w.grp = a.grp
  AND (w.k = a.k OR length(a.k) >= 4 AND starts_with(w.k, a.k) AND length(replace(w.k, a.k, '')) = length(w.k) - length(a.k)) WHERE a.k <> '' GROUP BY ALL)
SELECT post, d.grp, d.chosen, CASE WHEN b.n >= b.own THEN best ELSE d.chosen END AS name FROM d LEFT JOIN b ON b.grp = d.grp AND b.chosen = d.chosen"""


def _alias_tables(spark, sf_dir):
    """Aliases (the first two words of each document, of its source), titles (first lines), words of organisations (of parts' names and some aliases')."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.regexp_extract(F.coalesce("text", F.lit("")), r"^[^\n]*", 0).alias("title"))
    words = F.filter(F.split(F.lower("title"), r"\s+"), lambda w: w != "")
    aliases = d.where(F.size(words) > 1).select(F.array_join(F.slice(words, 1, 2), " ").alias("alias"), F.concat("source", F.lit(" Group")).alias("actor"))
    own = F.array(naming.actor_key(F.array_join(F.slice(words, 1, 2), " ")))
    names = d.where(F.col("doc_id") % 10 == 0).select(F.array_compact(own).alias("words"))
    return aliases, d.select(F.col("doc_id").alias("id"), "title"), names.unionByName(table(spark, sf_dir, "part").select(F.split("p_name", " ").alias("words")))


def actor_aliases(spark, sf_dir):
    """Aliases of actors and whether they are evidence: no organisation's word, and in at most one per cent of titles."""
    aliases, titles, names = _alias_tables(spark, sf_dir)
    return naming.alias_index(aliases, names, titles)


def actors_named(spark, sf_dir):
    """Titles that name an actor by an alias that is evidence."""
    aliases, titles, names = _alias_tables(spark, sf_dir)
    return naming.actors_in_titles(titles, cut(naming.alias_index(aliases, names, titles)))


_AKEY = "nullif(CASE WHEN length(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9]+', '', 'g'), '(ransomware|ransom|group|team|gang|leaks|leak|blog)$', '')) >= 4 " \
    "THEN regexp_replace(regexp_replace(lower({0}), '[^a-z0-9]+', '', 'g'), '(ransomware|ransom|group|team|gang|leaks|leak|blog)$', '') ELSE regexp_replace(lower({0}), '[^a-z0-9]+', '', 'g') END, '')"
_ALIASES = rf"""WITH t AS (SELECT doc_id AS id, source, split_part(coalesce(text, ''), chr(10), 1) AS title FROM documents),
s AS (SELECT *, list_filter(regexp_split_to_array(lower(title), '\s+'), lambda w: w <> '') AS w FROM t),
a AS (SELECT {_AKEY.format("array_to_string(w[1:2], ' ')")} AS alias, min(source || ' Group') AS actor FROM s WHERE len(w) > 1 GROUP BY 1 HAVING alias IS NOT NULL),
o AS (SELECT DISTINCT {_AKEY.format("array_to_string(w[1:2], ' ')")} AS alias FROM s WHERE id % 10 = 0 UNION SELECT unnest(string_split(p_name, ' ')) FROM part),
q AS (SELECT id, list_filter(list_transform(regexp_split_to_array(lower(title), '\s+'), lambda x: regexp_replace(x, '[^a-z0-9]+', '', 'g')), lambda x: x <> '') AS w FROM t),
r AS (SELECT DISTINCT id, {_AKEY.format("array_to_string(w[i:i + k - 1], '')")} AS alias FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM q, (SELECT unnest(range(1, 5)) AS k))),
df AS (SELECT alias, count(*) AS titles FROM r WHERE alias IN (SELECT alias FROM a) GROUP BY alias),
x AS (SELECT a.alias, a.actor, coalesce(titles, 0) AS titles, o.alias IS NULL AND coalesce(titles, 0) <= greatest(0.01 * (SELECT count(*) FROM t), 1) AS kept
  FROM a LEFT JOIN df USING (alias) LEFT JOIN o ON o.alias = a.alias)"""

QUERIES = {f.__name__: f for f in (soft_names, canonical_names, actor_aliases, actors_named)}
ORACLE_SQL = dict(zip(QUERIES, (_SOFT, _CANONICAL, f"{_ALIASES} SELECT * FROM x", f"{_ALIASES} SELECT DISTINCT id, actor FROM r JOIN x USING (alias) WHERE kept")))
QUERIES |= {"name_levels": name_levels, "post_names": post_names}
