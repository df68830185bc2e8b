"""Reading: lists, volumes, article pages and the titles that matter."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import reading as R
from tidewatch.plans.tables import table


def listed_elements(spark, sf_dir):
    """The items of a list written for each part: names with brackets that hold commas, elements with commas of their own, joined labels."""
    p = table(spark, sf_dir, "part")
    form = F.element_at(F.array(
        F.concat_ws("", "p_name", F.lit(" ("), "p_type", F.lit(", ["), "p_brand", F.lit("; new]), and "), F.initcap("p_name"), F.lit(" and "), F.initcap("p_type")),
        F.concat_ws("", F.lit("account number, credit card account number, or debit card number; "), "p_name", F.lit(", in combination with "), "p_brand"),
        F.concat_ws("", "p_name", F.lit("), "), "p_type", F.lit("\n"), "p_name", F.lit(", or "), "p_brand", F.lit(" & "), F.initcap("p_name"))), (F.col("p_partkey") % 3 + 1).cast("int"))
    return R.listed_items(p.select("p_partkey", form.alias("text")), "p_partkey", "text").withColumn("place", F.col("place").cast("long"))


_INIT = "array_to_string(list_transform(string_split({0}, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ')"
_LISTED = rf"""WITH t AS (SELECT p_partkey, [p_name || ' (' || p_type || ', [' || p_brand || '; new]), and ' || {_INIT.format('p_name')} || ' and ' || {_INIT.format('p_type')},
    'account number' || chr(1) || ' credit card account number' || chr(1) || ' or debit card number; ' || p_name || ', in combination with ' || p_brand,
    p_name || '), ' || p_type || chr(10) || p_name || ', or ' || p_brand || ' & ' || {_INIT.format('p_name')}][p_partkey % 3 + 1] AS text FROM part),
c AS (SELECT p_partkey, unnest(regexp_extract_all(text, '[^()\[\],;\n]+|[()\[\],;\n]')) AS piece, generate_subscripts(regexp_extract_all(text, '[^()\[\],;\n]+|[()\[\],;\n]'), 1) AS pos FROM t),
s AS (SELECT *, sum(CASE WHEN piece IN ('(', '[') THEN 1 WHEN piece IN (')', ']') THEN -1 ELSE 0 END) OVER w AS total FROM c WINDOW w AS (PARTITION BY p_partkey ORDER BY pos)),
e AS (SELECT *, piece IN (',', ';', chr(10)) AND total - least(0, min(total) OVER (PARTITION BY p_partkey ORDER BY pos)) = 0 AS ends FROM s),
n AS (SELECT *, sum(ends::INT) OVER (PARTITION BY p_partkey ORDER BY pos) AS part FROM e),
j AS (SELECT p_partkey, part, string_agg(piece, '' ORDER BY pos) AS s FROM n WHERE NOT ends GROUP BY ALL),
h AS (SELECT p_partkey, part, string_split(regexp_replace(s, '\s+(?:and|&)\s+([A-Z])', chr(3) || '\1', 'g'), chr(3)) AS s FROM j),
l AS (SELECT p_partkey, part, unnest(s) AS s, generate_subscripts(s, 1) AS k FROM h),
k AS (SELECT p_partkey, part, k, trim(regexp_replace(trim(regexp_replace(replace(s, chr(1), ','), '\s+', ' ', 'g'), ' .''"' || chr(9)), '^(?i:and/or|and|or)\s+', '')) AS s FROM l),
f AS (SELECT * FROM k WHERE length(regexp_replace(s, '[^\p{{L}}]', '', 'g')) >= 2),
g AS (SELECT *, regexp_matches(s, '^(?i:in combination)\b') AND row_number() OVER (PARTITION BY p_partkey ORDER BY part, k) > 1 AS goes_on FROM f),
i AS (SELECT *, sum((NOT goes_on)::INT) OVER (PARTITION BY p_partkey ORDER BY part, k) AS item FROM g),
w AS (SELECT p_partkey, item AS at_, string_agg(s, ', ' ORDER BY part, k) AS item FROM i GROUP BY p_partkey, i.item),
u AS (SELECT p_partkey, item, min(at_) AS at_ FROM w GROUP BY ALL)
SELECT p_partkey, row_number() OVER (PARTITION BY p_partkey ORDER BY at_) AS place, item FROM u"""


def _told(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("long").cast("string")
    price = F.format_number(F.floor(F.col("l_extendedprice")), 0)
    forms = [F.concat(F.lit("More than "), price, F.lit(" records and approx. "), q, F.lit(" GB of files")), F.concat(q, F.lit(",5 tb+ stolen, up to "), q, F.lit("k customers")),
             F.concat(F.lit("about "), q, F.lit(".25 million users; 0 files")), F.concat(F.lit("~"), q, F.lit("+ documents, nearly "), price, F.lit(" MB")), F.concat(F.lit("no number of "), F.col("l_returnflag"))]
    return l.select("l_orderkey", "l_linenumber", F.element_at(F.array(*forms), ((F.col("l_orderkey") + F.col("l_linenumber")) % 5 + 1).cast("int")).alias("text"))


def stated_volumes(spark, sf_dir):
    """Volumes in a sentence written for each line item: qualifier, value and unit."""
    d = _told(spark, sf_dir).select("l_orderkey", "l_linenumber", F.posexplode(R.volumes(F.col("text"))).alias("k", "v"))
    return d.select("l_orderkey", "l_linenumber", (F.col("k") + 1).cast("long").alias("place"), "v.span", "v.qualifier", F.col("v.value").cast("long").alias("value"), "v.unit")


_CASE = lambda word, t: "CASE " + " ".join(f"WHEN {word} = '{k}' THEN {v!r}" for k, v in t.items()) + " END"
_SQL_VOLUME = R.VOLUME.replace("'", "''")
_VOLUMES = rf"""WITH t AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, l_quantity::BIGINT AS q, format('{{:,}}', floor(l_extendedprice)::BIGINT) AS price, l_returnflag FROM lineitem),
x AS (SELECT *, ['More than ' || price || ' records and approx. ' || q || ' GB of files', q || ',5 tb+ stolen, up to ' || q || 'k customers', 'about ' || q || '.25 million users; 0 files',
  '~' || q || '+ documents, nearly ' || price || ' MB', 'no number of ' || l_returnflag][(l_orderkey + l_linenumber) % 5 + 1] AS text FROM t),
m AS (SELECT rid, l_orderkey, l_linenumber, unnest(regexp_extract_all(text, '{_SQL_VOLUME}')) AS span, generate_subscripts(regexp_extract_all(text, '{_SQL_VOLUME}'), 1) AS pos FROM x),
g AS (SELECT *, {", ".join(f"lower(regexp_extract(span, '{_SQL_VOLUME}', {k})) AS g{k}" for k in range(1, 7))} FROM m),
b AS (SELECT *, {_CASE('g5', R.BYTES)} AS size FROM g),
n AS (SELECT *, CASE WHEN size IS NOT NULL AND regexp_matches(g2, '^\d+,\d{{1,2}}$') THEN replace(g2, ',', '.') ELSE replace(g2, ',', '') END AS digits FROM b),
v AS (SELECT *, round(TRY_CAST(digits AS DOUBLE) * coalesce({_CASE('g3', R.SCALES)}, 1) * coalesce(size, 1))::BIGINT AS value,
  CASE WHEN size IS NOT NULL THEN 'bytes' {" ".join(f"WHEN g5 IN ({', '.join(repr(w) for w in ws)}) THEN '{k}'" for k, ws in R.COUNTED.items())} END AS unit,
  CASE WHEN g4 <> '' OR g6 <> '' THEN 'over' ELSE coalesce({_CASE("regexp_replace(g1, '[.]$', '')", R.QUALIFIERS)}, 'exact') END AS qualifier FROM n)
SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY rid ORDER BY pos) AS place, trim(span) AS span, qualifier, value, unit FROM v WHERE value > 0"""


def article_texts(spark, sf_dir):
    """The article text of each page, its characters and its lines."""
    d = table(spark, sf_dir, "pages").select("page_id", R.article_text(F.col("html")).alias("text"))
    return d.select("page_id", "text", F.length("text").cast("long").alias("n_chars"), F.size(F.split("text", "\n")).cast("long").alias("n_lines"))


def _sql_plain(x: str) -> str:
    for tag in R.NO_TEXT:
        x = f"regexp_replace({x}, '(?is)<{tag}\\b.*?</{tag}>', ' ', 'g')"
    x = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    x = f"list_reduce(list_prepend({x}, list_distinct(regexp_extract_all({x}, '&#([0-9]{{1,6}});', 1))), lambda s, n: replace(s, '&#' || n || ';', chr(n::INT)))"
    for k, v in R.ENTITIES.items():
        x = f"replace({x}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    return f"trim(regexp_replace(replace({x}, '&amp;', '&'), '\\s+', ' ', 'g'))"


_ARTICLES = rf"""WITH s AS (SELECT page_id, coalesce(nullif(regexp_extract(html, '(?is)<article\b.*?</article>'), ''), html) AS scope FROM pages),
p AS (SELECT page_id, unnest(regexp_extract_all(scope, '(?is)<p\b[^>]*>(.*?)</p>', 1)) AS p, generate_subscripts(regexp_extract_all(scope, '(?is)<p\b[^>]*>(.*?)</p>', 1), 1) AS pos FROM s),
t AS (SELECT page_id, pos, {_sql_plain('p')} AS p FROM p),
j AS (SELECT page_id, string_agg(p, chr(10) ORDER BY pos) AS joined FROM t WHERE length(p) > 40 GROUP BY page_id),
a AS (SELECT page_id, CASE WHEN length(joined) > 300 THEN joined ELSE {_sql_plain('scope')} END AS text FROM s LEFT JOIN j USING (page_id))
SELECT page_id, text, length(text) AS n_chars, len(string_split(text, chr(10))) AS n_lines FROM a"""


def relevant_pages(spark, sf_dir):
    """Pages whose title holds a name (the first two words of another page's heading) and, besides, a word of the benchmark."""
    p = table(spark, sf_dir, "pages")
    titles = p.select(F.col("page_id").alias("id"), R.plain_text(F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)).alias("title"))
    heads = p.select(R.norm_words(R.plain_text(F.regexp_extract("html", r"(?is)<h1\b[^>]*>(.*?)</h1>", 1))).alias("w")).where("size(w) > 1")
    names = heads.select(F.array_join(F.slice("w", 1, 2), " ").alias("name")).distinct()
    terms = table(spark, sf_dir, "benchmark").select(F.explode(R.norm_words(F.col("text"))).alias("term")).distinct()
    return R.relevant(titles, names, terms)


_NORM = "list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
_RELEVANT = rf"""WITH t AS (SELECT page_id AS id, {_NORM.format(_sql_plain("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"))} AS w FROM pages),
n AS (SELECT DISTINCT array_to_string(w[1:2], ' ') AS name FROM (SELECT {_NORM.format(_sql_plain("regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)"))} AS w FROM pages) WHERE len(w) > 1),
b AS (SELECT DISTINCT unnest({_NORM.format('text')}) AS term FROM benchmark),
r AS (SELECT DISTINCT id, array_to_string(w[i:i + k - 1], ' ') AS k FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM t, (SELECT unnest(range(1, 5)) AS k)))
SELECT DISTINCT r.id, n.name FROM r JOIN n ON n.name = r.k JOIN r q ON q.id = r.id JOIN b ON b.term = q.k WHERE NOT contains(' ' || r.k || ' ', ' ' || b.term || ' ')"""

QUERIES = {f.__name__: f for f in (listed_elements, stated_volumes, article_texts, relevant_pages)}
ORACLE_SQL = dict(zip(QUERIES, (_LISTED, _VOLUMES, _ARTICLES, _RELEVANT)))
