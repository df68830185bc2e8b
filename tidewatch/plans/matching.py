"""Records of organisations and incidents from the star schema, their names, comparison, scores and clusters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.functions import text as T
from tidewatch.operators import linkage, matching
from tidewatch.operators.scratch import cut, stored
from tidewatch.plans.tables import table

AUTO, REVIEW, PRIOR = 0.95, 0.5, 0.01


def organisations(spark, sf_dir):
    """One organisation per customer: a raw name with a legal form by its nation, a domain where the balance allows, country and sector."""
    legal = F.element_at(F.array(*[F.lit(x) for x in ("", ", Inc.", " LLC", " Group Ltd", " & Co. Services")]), (F.col("c_nationkey") % 5 + 1).cast("int"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("c_custkey"), "p_name", "p_brand")
    c = table(spark, sf_dir, "customer").join(p, "c_custkey")
    raw = F.concat(F.when(F.col("c_nationkey") % 4 == 0, "The ").otherwise(""), F.initcap("p_name"), F.lit(" "), F.initcap("c_mktsegment"), legal)
    domain = F.when(F.col("c_acctbal") >= 0, F.concat(F.regexp_replace("p_name", " ", "-"), F.lit("."), F.lower(F.regexp_replace("p_brand", "#", "")), F.lit(".com")))
    return c.select(F.col("c_custkey").alias("org"), raw.alias("raw"), domain.alias("domain"), F.when(F.col("c_nationkey") % 7 != 0, F.col("c_nationkey")).alias("country"),
                    F.when(F.col("c_acctbal") < 9000, F.col("c_mktsegment")).alias("sector"))


_ORGS = """orgs AS (SELECT c_custkey AS org, CASE WHEN c_nationkey % 4 = 0 THEN 'The ' ELSE '' END || array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ')
    || ' ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ['', ', Inc.', ' LLC', ' Group Ltd', ' & Co. Services'][c_nationkey % 5 + 1] AS raw,
  CASE WHEN c_acctbal >= 0 THEN replace(p_name, ' ', '-') || '.' || lower(replace(p_brand, '#', '')) || '.com' END AS domain,
  CASE WHEN c_nationkey % 7 <> 0 THEN c_nationkey END AS country, CASE WHEN c_acctbal < 9000 THEN c_mktsegment END AS sector FROM customer JOIN part ON p_partkey = c_custkey)"""
_LEGAL = r"\b(" + "|".join(T.LEGAL_FORMS_RE) + r")\b\.?"
_QUALIFIERS = ", ".join(f"'{q}'" for q in T.QUALIFIERS if " " not in q)
_NAMES = rf"""{_ORGS}, n AS (SELECT *, trim(regexp_replace(regexp_replace(replace(lower(raw), '&', ' and '), '{_LEGAL}', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS nn FROM orgs),
names AS (SELECT *, coalesce(nullif(array_to_string(list_filter(string_split(nn, ' '), lambda x: x NOT IN ({_QUALIFIERS})), ' '), ''), nn) AS lk FROM n)"""


def organisation_names(spark, sf_dir):
    """Normal name, link key, initials and registrable domain of each organisation."""
    o = organisations(spark, sf_dir).withColumn("nn", T.plain_name(F.col("raw")))
    o = o.withColumn("lk", T.link_key(F.col("nn")))
    toks = F.split("nn", " ")
    letters = F.array_join(F.transform(F.filter(toks, lambda x: ~x.isin(*T.SMALL_WORDS)), lambda x: F.substring(x, 1, 1)), "")
    return o.select("org", "raw", "nn", "lk", letters.alias("initials"), "domain", T.registrable_label(F.col("domain")).alias("label"), "country", "sector")


_SMALL = ", ".join(f"'{w}'" for w in T.SMALL_WORDS)
_NAMES_SQL = f"""WITH {_NAMES} SELECT org, raw, nn, lk, array_to_string(list_transform(list_filter(string_split(nn, ' '), lambda x: x NOT IN ({_SMALL})), lambda x: x[1]), '') AS initials,
  domain, string_split(domain, '.')[-2] AS label, country, sector FROM names"""

#: source class by list; fixed order of precedence.
CLASSES = {"1-URGENT": "reg", "2-HIGH": "sec", "3-MEDIUM": "hibp", "4-NOT SPECIFIED": "press", "5-LOW": "other"}


def records(spark, sf_dir):
    """One incident record per order: names of its organisation, public day, event day (first returned line), people and class.

    An event after publication by more than a year, or before 1990, is no event.
    """
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("iid"), F.col("o_custkey").alias("org"), F.to_date("o_orderdate").alias("pub"),
                                              F.floor(F.col("o_totalprice") / 5000).cast("long").alias("people"), F.col("o_orderpriority").alias("list"))
    ev = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("iid")).agg(F.to_date(F.min("l_shipdate")).alias("ev"))
    cls = F
    for k, v in CLASSES.items():
        cls = cls.when(F.col("list") == k, v)
    sound = (F.datediff("ev", "pub") <= 365) & (F.col("ev") >= F.lit("1990-01-01").cast("date"))
    names = organisation_names(spark, sf_dir).select("org", "nn", "lk", "domain", "country", "sector")
    return o.join(ev, "iid", "left").join(names, "org").select(
        "iid", "org", "nn", "lk", F.array_distinct(F.split("lk", " ")).alias("toks"), "domain", "country", "sector", "people",
        F.when(sound, F.col("ev")).alias("ev"), "pub", cls.otherwise("other").alias("cls"))


_RECORDS = f"""{_NAMES}, e AS (SELECT l_orderkey AS iid, CAST(min(l_shipdate) AS DATE) AS ev FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
recs AS (SELECT o_orderkey AS iid, org, nn, lk, list_distinct(string_split(lk, ' ')) AS toks, domain, country, sector, floor(o_totalprice / 5000)::BIGINT AS people,
  CASE WHEN ev - CAST(o_orderdate AS DATE) <= 365 AND ev >= DATE '1990-01-01' THEN ev END AS ev, CAST(o_orderdate AS DATE) AS pub,
  CASE o_orderpriority {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in CLASSES.items())} ELSE 'other' END AS cls
  FROM orders JOIN names ON org = o_custkey LEFT JOIN e ON e.iid = o_orderkey)"""
_COMPARED = """levels AS (SELECT *, CASE WHEN lnn = rnn THEN 'exact' WHEN llk = rlk THEN 'linkkey' WHEN small >= 2 AND common = small THEN 'contain'
    WHEN common > 0 AND common < small THEN 'conflict' WHEN common > 0 THEN 'single' ELSE 'none' END AS name,
  CASE WHEN ldomain IS NULL OR rdomain IS NULL THEN 'missing' WHEN ldomain = rdomain THEN 'equal' ELSE 'different' END AS domain,
  CASE WHEN gap IS NULL THEN 'missing' WHEN year_off THEN 'md_match_year_off' WHEN gap = 0 THEN 'd0' WHEN gap <= 3 THEN 'd3' WHEN gap <= 14 THEN 'd14' WHEN gap <= 45 THEN 'd45' WHEN gap <= 120 THEN 'd120' ELSE 'gt120' END AS event,
  CASE WHEN pgap <= 14 THEN 'p14' WHEN pgap <= 45 THEN 'p45' WHEN pgap <= 120 THEN 'p120' WHEN pgap <= 365 THEN 'p365' ELSE 'gt365' END AS public,
  CASE WHEN lev IS NULL AND rev IS NULL THEN 'na' WHEN coalesce(lev > rpub, false) OR coalesce(rev > lpub, false) THEN 'impossible' ELSE 'ok' END AS impossible,
  CASE WHEN lcls IN ('reg', 'sec') AND rcls IN ('reg', 'sec') THEN CASE WHEN lcls = rcls THEN 'same_reg' ELSE 'diff_reg' END ELSE 'other' END AS source,
  CASE WHEN lcountry IS NULL OR rcountry IS NULL THEN 'missing' WHEN lcountry = rcountry THEN 'agree' ELSE 'conflict' END AS country,
  CASE WHEN lsector IS NULL OR rsector IS NULL THEN 'missing' WHEN lsector = rsector THEN 'agree' ELSE 'differ' END AS sector,
  CASE WHEN lpeople = rpeople THEN 'same' ELSE 'other' END AS people,
  CASE WHEN lcls = 'sec' OR rcls = 'sec' THEN 'sec_any' WHEN lcls = 'reg' AND rcls = 'reg' THEN 'reg_reg' WHEN lcls = 'press' AND rcls = 'press' THEN 'press_press'
    WHEN (lcls = 'reg' AND rcls = 'hibp') OR (lcls = 'hibp' AND rcls = 'reg') THEN 'reg_hibp' WHEN (lcls = 'reg' AND rcls = 'press') OR (lcls = 'press' AND rcls = 'reg') THEN 'reg_press' ELSE 'other' END AS date_class
  FROM (SELECT *, len(list_intersect(ltoks, rtoks)) AS common, least(len(ltoks), len(rtoks)) AS small, abs(lev - rev) AS gap, abs(lpub - rpub) AS pgap,
    strftime(lev, '%m-%d') = strftime(rev, '%m-%d') AND abs(year(lev) - year(rev)) = 1 AS year_off FROM pairs)),
cmp AS (SELECT *, list_filter([CASE WHEN domain = 'different' THEN 'domain_differs' END, CASE WHEN name = 'conflict' THEN 'tokens_conflict' END,
  CASE WHEN gap > 180 AND NOT year_off THEN 'event_dates_gt_180d' END, CASE WHEN country = 'conflict' THEN 'country_differs' END], lambda x: x IS NOT NULL) AS cannot FROM levels)"""
_SIDES = ", ".join(f"l.{c} AS l{c}, r.{c} AS r{c}" for c in ("iid", "org", "nn", "lk", "toks", "domain", "country", "sector", "people", "ev", "pub", "cls"))
_BLOCKS = """keys AS (SELECT iid, 'd|' || domain || '|' || date_trunc('month', pub)::DATE AS k FROM recs WHERE domain IS NOT NULL UNION ALL
  SELECT iid, 'n|' || array_to_string(string_split(nn, ' ')[1:2], ' ') || '|' || date_trunc('week', pub)::DATE FROM recs UNION ALL SELECT iid, 'o|' || org || '|' || year(pub) FROM recs),
ok AS (SELECT k FROM keys GROUP BY k HAVING count(*) * (count(*) - 1) / 2 BETWEEN 1 AND 300),
blocked AS (SELECT DISTINCT x.iid AS a, y.iid AS b FROM keys x JOIN keys y ON x.k = y.k AND x.iid < y.iid SEMI JOIN ok ON ok.k = x.k)"""


def _kept(spark, sf_dir):
    return stored(matching.packed(records(spark, sf_dir)), "records")


def _blocked(r):
    """(pairs, blocks dropped) of packed records."""
    keys = [F.when(F.col("domain").isNotNull(), F.concat_ws("|", F.lit("d"), "domain", F.date_format(F.trunc("pub", "month"), "yyyy-MM-dd"))),
            F.concat_ws("|", F.lit("n"), F.array_join(F.slice(F.split(F.coalesce("nn", "lk"), " "), 1, 2), " "), F.date_format(F.trunc("pub", "week"), "yyyy-MM-dd")),
            F.concat_ws("|", F.lit("o"), "org", F.year("pub"))]
    pairs, dropped = linkage.blocked_pairs(r, "iid", keys)
    return matching.compared(matching.unpacked(pairs)), dropped


def record_blocks(spark, sf_dir):
    """Blocks of records by domain and month, first two words and week, organisation and year: their size, and whether they are over 300 pairs."""
    r = records(spark, sf_dir)
    over = _blocked(matching.packed(r))[1].select(F.col("block").alias("k"), F.lit(True).alias("over"))
    k = r.select(F.explode(F.array_compact(F.array(
        F.when(F.col("domain").isNotNull(), F.concat_ws("|", F.lit("d"), "domain", F.date_format(F.trunc("pub", "month"), "yyyy-MM-dd"))),
        F.concat_ws("|", F.lit("n"), F.array_join(F.slice(F.split("nn", " "), 1, 2), " "), F.date_format(F.trunc("pub", "week"), "yyyy-MM-dd")),
        F.concat_ws("|", F.lit("o"), "org", F.year("pub"))))).alias("k"))
    return k.groupBy("k").agg(F.count("*").alias("n")).join(over, "k", "left").select("k", "n", F.coalesce("over", F.lit(False)).alias("over"))


_BLOCKS_SQL = f"WITH {_RECORDS}, {_BLOCKS} SELECT k, count(*) AS n, count(*) * (count(*) - 1) / 2 > 300 AS over FROM keys GROUP BY k"
_FEATURES = list(matching.LEVELS)


def record_features(spark, sf_dir):
    """All blocked pairs with their nine levels and the reasons against a link."""
    d = _blocked(_kept(spark, sf_dir))[0]
    return d.select(F.col("l.iid").alias("a"), F.col("r.iid").alias("b"), *_FEATURES, F.concat_ws(",", "cannot").alias("cannot"))


_PAIRS = f"pairs AS (SELECT {_SIDES} FROM blocked JOIN recs l ON l.iid = a JOIN recs r ON r.iid = b)"
_FEATURES_SQL = f"WITH {_RECORDS}, {_BLOCKS}, {_PAIRS}, {_COMPARED} SELECT liid AS a, riid AS b, {', '.join(_FEATURES)}, array_to_string(cannot, ',') AS cannot FROM cmp"
DRAWS = 8


def _random(r):
    return matching.compared(matching.unpacked(matching.random_pairs(r, DRAWS, "u")))


def level_u(spark, sf_dir):
    """Shares of the levels among random pairs of records, those of the event by class of sources."""
    return matching.estimate_u(_random(_kept(spark, sf_dir))).withColumn("u", F.round("u", 9))


_RANDOM = f"""dealt AS (SELECT recs.*, k, ('0x' || substr(md5('u:' || k || ':' || iid), 1, 8))::UBIGINT % greatest(1, (SELECT (count(*) + 1) // 2 FROM recs)) AS bucket FROM recs, range(1, {DRAWS + 1}) t(k)),
pairs AS (SELECT {_SIDES} FROM dealt l JOIN dealt r ON l.k = r.k AND l.bucket = r.bucket AND l.iid < r.iid)"""
_VALUES = ", ".join(f"('{f}', '{v}', {len(vs)})" for f, vs in matching.KEYS.items() for v in vs)
_KEY = lambda f: "'event:' || date_class" if f == "event" else f"'{f}'"
_STACK = " UNION ALL ".join(f"SELECT {_KEY(f)} AS feature, {f} AS level, * FROM cmp" for f in _FEATURES)
_U = f"""SELECT feature, level, (coalesce(c.n, 0) + 1) / (sum(coalesce(c.n, 0)) OVER (PARTITION BY feature) + levels) AS u
  FROM (VALUES {_VALUES}) v(feature, level, levels) LEFT JOIN (SELECT feature, level, count(*) AS n FROM ({_STACK}) GROUP BY ALL) c USING (feature, level)"""
_U_SQL = f"WITH {_RECORDS}, {_RANDOM}, {_COMPARED}, u AS ({_U}) SELECT feature, level, round(u, 9) AS u FROM u"


def _model(r):
    """Matches: blocked pairs of one organisation within 45 days; pairs far apart stand for three, as their stratum is sampled less."""
    pairs = stored(matching.short(_blocked(r)[0]), "pairs")
    same = pairs.where("l.org = r.org and public in ('p14', 'p45')")
    return pairs, matching.estimate_m(same, F.when(F.col("public") == "p14", 1.0).otherwise(3.0), matching.estimate_u(_random(r)))


def level_weights(spark, sf_dir):
    """m, u and the factor of each level: weighted matches, pulled towards u by their effective number."""
    return _model(_kept(spark, sf_dir))[1].select("feature", "level", *[F.round(c, 9).alias(c) for c in ("m", "u", "bf")])


_U_OF = f"uu AS (WITH {_RANDOM}, {_COMPARED} {_U})"
_M = f"""{_RECORDS}, {_U_OF}, {_BLOCKS}, {_PAIRS}, {_COMPARED},
mm AS (SELECT *, CASE WHEN public = 'p14' THEN 1.0 ELSE 3.0 END::DOUBLE AS w FROM cmp WHERE lorg = rorg AND public IN ('p14', 'p45')),
mc AS (SELECT feature, level, sum(w) AS w, sum(w * w) AS w2 FROM ({_STACK.replace('FROM cmp', 'FROM mm')}) GROUP BY ALL),
mt AS (SELECT feature, sum(w) AS tw, sum(w) * sum(w) / sum(w2) AS n_eff FROM mc GROUP BY feature),
model AS (SELECT *, log2(m / u) AS bf FROM (SELECT uu.feature, uu.level, (coalesce(n_eff, 0) * coalesce(w, 0) / coalesce(tw, 1) + 4 * u) / (coalesce(n_eff, 0) + 4) AS m, u
  FROM uu LEFT JOIN mc USING (feature, level) LEFT JOIN mt ON mt.feature = uu.feature))"""
_M_SQL = f"WITH {_M} SELECT feature, level, round(m, 9) AS m, round(u, 9) AS u, round(bf, 9) AS bf FROM model"


def _scorer(r):
    """(compared blocked pairs, a function that scores compared pairs) of packed records."""
    pairs, model = _model(r)
    n = r.agg(F.count("*").alias("n"))
    share = r.groupBy(F.coalesce("nn", "lk").alias("nn")).agg(F.count("*").alias("c")).crossJoin(F.broadcast(n)).select("nn", (F.col("c") / F.col("n")).alias("share"))
    model = cut(model)
    return pairs, lambda d: matching.scored(d, model, share, PRIOR, AUTO, REVIEW)


def _scores(spark, sf_dir):
    pairs, score = _scorer(_kept(spark, sf_dir))
    return score(pairs)


def record_scores(spark, sf_dir):
    """Blocked pairs with weight, probability, caps and band."""
    return _scores(spark, sf_dir).select("a", "b", F.round("weight", 6).alias("weight"), F.round("p", 6).alias("p"), F.concat_ws(",", "caps").alias("caps"), "band")


_BF = " + ".join(f"(SELECT bf FROM model WHERE feature = {_KEY(f)} AND level = cmp.{f})" for f in _FEATURES)
_S = f"""{_M}, sh AS (SELECT nn, count(*) / (SELECT count(*) FROM recs) AS share FROM recs GROUP BY nn), ue AS (SELECT u FROM uu WHERE feature = 'name' AND level = 'exact'),
sw AS (SELECT liid AS a, riid AS b, cannot, log2({PRIOR} / (1 - {PRIOR})) + {_BF} + CASE WHEN name = 'exact' THEN greatest(-6.0, least(4.0, log2((SELECT u FROM ue) / share))) ELSE 0 END AS weight,
  list_filter([CASE WHEN (len(ltoks) = 1 OR len(rtoks) = 1) AND event NOT IN ('d0', 'd3', 'd14') AND domain <> 'equal' THEN 'single_token' END,
    CASE WHEN event = 'missing' AND public NOT IN ('p14', 'p45') THEN 'undated' END], lambda x: x IS NOT NULL) AS caps FROM cmp LEFT JOIN sh ON sh.nn = lnn),
sp AS (SELECT *, 1 / (1 + pow(2.0, -weight)) AS p FROM sw),
s AS (SELECT *, CASE WHEN p >= {AUTO} AND len(caps) = 0 THEN 'auto' WHEN p >= {REVIEW} THEN 'review' ELSE 'none' END AS band FROM sp)"""
_S_SQL = f"WITH {_S} SELECT a, b, round(weight, 6) AS weight, round(p, 6) AS p, array_to_string(caps, ',') AS caps, band FROM s"


def _clustered(spark, sf_dir):
    r = _kept(spark, sf_dir)
    pairs, score = _scorer(r)
    s = stored(score(pairs), "scores")
    on_demand = lambda ids: score(matching.compared(matching.unpacked(linkage.beside(ids, r, "iid"))))
    return s, *matching.clusters_noted(s, r.select(F.col("iid").alias("id"), "pub"), REVIEW, score=on_demand)


def record_clusters(spark, sf_dir):
    """Incidents in clusters named by their earliest member (an order-dependent greedy; no SQL)."""
    return _clustered(spark, sf_dir)[1]


def record_decisions(spark, sf_dir):
    """What is stored for each blocked pair (the notes come from the greedy; no SQL)."""
    s, _, notes = _clustered(spark, sf_dir)
    return matching.decided(s, notes)


def level_em(spark, sf_dir):
    """m without labels, from the level patterns of all blocked pairs, with u as random pairs have it (an iteration; no SQL)."""
    r = _kept(spark, sf_dir)
    d = _blocked(r)[0].groupBy(*_FEATURES).agg(F.count("*").alias("n"))
    u = matching.estimate_u(_random(r).withColumn("date_class", F.lit("other")))
    known = {(r["feature"].removesuffix(":other"), r["level"]): r["u"] for r in u.collect()}  # a row per level
    return matching.level_em(d, known).select("feature", "level", F.round("m", 6).alias("m"), F.round("u", 6).alias("u"))


def name_frequencies(spark, sf_dir):
    """How many organisations and how many incidents a name's word stands in, and whether it is rare or distinctive."""
    r = records(spark, sf_dir).select("iid", "org", F.explode("toks").alias("token"))
    n = r.agg(F.count_distinct("org").alias("orgs"))
    d = r.groupBy("token").agg(F.count_distinct("org").alias("df"), F.count_distinct("iid").alias("tf"))
    return d.crossJoin(F.broadcast(n)).select("token", "df", "tf", (F.col("df") <= 50).alias("rare"), (F.col("df") * 100 <= F.col("orgs")).alias("distinctive"))


_FREQ = f"""WITH {_RECORDS}, x AS (SELECT iid, org, unnest(toks) AS token FROM recs)
SELECT token, count(DISTINCT org) AS df, count(DISTINCT iid) AS tf, count(DISTINCT org) <= 50 AS rare, count(DISTINCT org) * 100 <= (SELECT count(DISTINCT org) FROM recs) AS distinctive FROM x GROUP BY token"""

QUERIES = {f.__name__: f for f in (organisation_names, record_blocks, record_features, level_u, level_weights, record_scores, name_frequencies)}
ORACLE_SQL = dict(zip(QUERIES, (_NAMES_SQL, _BLOCKS_SQL, _FEATURES_SQL, _U_SQL, _M_SQL, _S_SQL, _FREQ)))
QUERIES |= {f.__name__: f for f in (record_clusters, record_decisions, level_em)}
