"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (filter_audit, fingerprints, langid, lm_scoring, manifest, mixing, near_dedup, packing, quality, secrets, sharding,
                           vector_dedup, warc)


def op1_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.budgeted(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_dedup.near_duplicates(docs, words=3, percent=85)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    return lm_scoring.scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), good)


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.linked_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_absolute_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6 with lines counted by distinct texts, as in the pipeline."""
    return quality.quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), by="texts")


def op7_warc_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op9_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return sharding.sharded(docs, sharding.balanced_limit(docs))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return manifest.proofs(docs, manifest.tampered(docs))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op5_embedding_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5 where links are common: each vector, a slightly bent copy, and one whose cosine with it is about the limit."""
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    bent = F.transform("embedding", lambda x, i: x * (1000 + (i * 7 + F.col("vec_id")) % 13) / 1000)
    far = F.transform("embedding", lambda x, i: x * ((i * (F.col("vec_id") % 5 + 1)) % 7 + 1) / 7)
    # the new id last: within one select the lambda would see it
    copies = [v.withColumn("embedding", x).withColumn("vec_id", F.col("vec_id") + k * COPY) for k, x in enumerate((bent, far), 1)]
    return vector_dedup.linked_vectors(v.unionByName(copies[0]).unionByName(copies[1]))


def op6_few_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6 with a limit of five documents, so that lines go and documents are rejected on small tables as well."""
    return quality.quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), min_docs=5)


def op7_warc_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7 where each page is there twice, so that half of the long ones are revisits."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return warc.round_trip(pages.unionByName(pages.withColumn("page_id", F.col("page_id") + COPY)))


#: Added to the ids of copies.
COPY = 10_000_000

QUERIES = {
    "op4_lm_scoring": op4_lm_scoring,
    "op3_language_id": op3_language_id,
    "op7_warc_reassembly": op7_warc_reassembly,
    "op9_extendible_sharding": op9_extendible_sharding,
    "op1_hierarchical_mixing": op1_hierarchical_mixing,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op10_secret_scan": op10_secret_scan,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op6_absolute_lines": op6_absolute_lines,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_filter_audit": op12_filter_audit,
    "op13_document_fingerprints": op13_document_fingerprints,
    "op5_embedding_copies": op5_embedding_copies,
    "op6_few_lines": op6_few_lines,
    "op7_warc_copies": op7_warc_copies,
}

_OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), wins AS (
  SELECT r, i, ws[i : i + 4] AS g FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 3)) AS i) WHERE len(ws) >= 5
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM wins) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM again) GROUP BY r
), held AS (
  SELECT host, k, count(*) AS n FROM (
    SELECT DISTINCT host, doc, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS k
    FROM (SELECT host, coalesce(doc_id::VARCHAR, 'text ' || t) AS doc, unnest(ls) AS l FROM w)
  ) GROUP BY host, k
), frequent AS (
  SELECT host, k FROM held WHERE n > 20
), lost AS (
  SELECT r, count(*) AS n_lines, sum(len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))) AS n_words
  FROM (SELECT r, host, unnest(ls) AS l FROM w) x
  WHERE EXISTS (SELECT 1 FROM frequent f WHERE f.host = x.host
                AND f.k = lower(trim(regexp_replace(x.l, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')))
  GROUP BY r
), m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         coalesce(lost.n_lines, 0)::BIGINT AS n_removed_lines,
         (len(ws) - coalesce(lost.n_words, 0))::BIGINT AS left_words
  FROM w LEFT JOIN covered USING (r) LEFT JOIN lost USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND NOT (n_removed_lines > 0 AND (left_words < 10 OR 100 * left_words < 25 * n_words)) AS kept,
       n_removed_lines, left_words
FROM m
"""

def _op1_level(k: int) -> str:
    """One level of the tree: children of each node of the level above, filled to a common level."""
    names = ["domain", "lang", "source"][: k + 1]
    cols, up = ", ".join(names), ", ".join(names[:-1]) or "1"
    weight = "CASE WHEN lang = 'en' THEN 4 ELSE 1 END" if names[-1] == "lang" else "1"
    above = f"JOIN l{k - 1} USING ({', '.join(names[:-1])})" if k else "CROSS JOIN total"
    window = f"PARTITION BY {up}"
    running = f"({window} ORDER BY cap / w, cap, {cols} ROWS UNBOUNDED PRECEDING)"
    return f"""
n{k} AS (
  SELECT {cols}, cap::HUGEINT AS cap, ({weight})::HUGEINT AS w, budget::HUGEINT AS budget
  FROM (SELECT {cols}, sum(tokens * 2) AS cap FROM leaves GROUP BY {cols}) {above}
), f{k} AS (
  SELECT *, (sum(cap) OVER {running} * w + cap * (sum(w) OVER ({window}) - sum(w) OVER {running}) <= budget * w) AS is_full FROM n{k}
), l{k} AS (
  SELECT {cols}, CASE WHEN is_full THEN cap ELSE least(cap,
    (budget - coalesce(sum(cap) FILTER (WHERE is_full) OVER ({window}), 0)) * w
    // greatest(coalesce(sum(w) FILTER (WHERE NOT is_full) OVER ({window}), 0), 1)) END AS budget
  FROM f{k}
)"""


_OP1 = r"""
WITH d AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, ''))) AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) = '' THEN 'other'
         ELSE 'domain' || (regexp_extract(source, '([0-9]{1,9})$', 1)::INT % 4)::VARCHAR END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(n_tokens) AS tokens FROM d GROUP BY ALL HAVING sum(n_tokens) > 0
), total AS (
  SELECT floor(sum(tokens) * 80 / 100)::BIGINT AS budget FROM leaves
),""" + ",".join(map(_op1_level, range(3))) + r""", spent AS (
  SELECT domain, lang, source, budget // tokens AS e, budget % tokens AS tail FROM l2 JOIN leaves USING (domain, lang, source)
), h AS (
  SELECT d.*, coalesce(e, 0) AS e, coalesce(tail, 0) AS tail, md5('17:' || coalesce(e, 0)::BIGINT::VARCHAR || ':' || k) AS h
  FROM d LEFT JOIN spent USING (domain, lang, source)
), c AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM h
)
SELECT doc_id, domain, lang, source, n_tokens, e::BIGINT AS full_epochs,
       greatest(0, least(n_tokens, tail - before))::BIGINT AS tail_tokens
FROM c
"""

_OP9 = """
WITH t AS (
  SELECT coalesce(sum(strlen(text)), 0) AS total FROM documents
), l AS (
  SELECT total, greatest(1, least(33554432, total // 64)) AS most FROM t
), c AS (
  SELECT most, least(24, greatest(6, 6 + length(bin(((total + most - 1) // most)::UBIGINT)))) AS depth FROM l
), r AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         right(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT::BIT::VARCHAR, 32) AS b
  FROM documents
), n AS (
  SELECT d, left(b, d) AS p, sum(n_bytes)::BIGINT AS bytes, count(*) AS docs FROM r, range(0, 25) t(d) GROUP BY ALL
), s AS (
  SELECT b, min(d) AS d FROM (SELECT DISTINCT b FROM r) r2 JOIN n ON left(r2.b, n.d) = n.p, c
  WHERE n.d <= depth AND (n.bytes <= most OR n.d = depth AND n.docs = 1) GROUP BY b
)
SELECT doc_id, n_bytes, left(r.b, s.d) AS shard, s.d::INT AS depth, n.bytes AS shard_bytes, n.bytes > most AS oversized
FROM r JOIN s ON r.b = s.b JOIN n ON n.d = s.d AND n.p = left(r.b, s.d), c
"""

_OP7 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, ''))::BIGINT AS n FROM pages
), t AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS top, count(*) OVER (PARTITION BY h) AS c FROM p
)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN n >= 1000 AND c > 1 AND top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND c > 1 AND page_id IS DISTINCT FROM top THEN top END AS refers_to, true AS complete
FROM t
"""



def _op11_values(text: str) -> str:
    """The hash of a row's values, each with its length in bytes."""
    one = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
    return "sha256(" + " || ".join(one.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _op11_tree(p: str, levels: int) -> str:
    """Levels of a tree over {p}n0 (grp, pos, h) and folds of {p}f0 (r, grp, pos, cur, sib) up to its root; a lone node stays."""
    out = []
    for k in range(levels):
        out.append(f"""{p}c{k} AS (SELECT *, count(*) OVER (PARTITION BY grp) AS c FROM {p}n{k}),
{p}n{k + 1} AS (SELECT grp, pos // 8 AS pos, CASE WHEN max(c) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE max(h) END AS h FROM {p}c{k} GROUP BY grp, pos // 8),
{p}s{k} AS (SELECT a.grp, a.pos, max(a.c) AS c, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS lft,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS rgt
  FROM {p}c{k} a JOIN {p}c{k} b ON a.grp IS NOT DISTINCT FROM b.grp AND a.pos // 8 = b.pos // 8 GROUP BY a.grp, a.pos),
{p}f{k + 1} AS (SELECT r, f.grp, f.pos // 8 AS pos, CASE WHEN c > 1 THEN sha256(lft || cur || rgt) ELSE cur END AS cur, sib || lft || rgt AS sib
  FROM {p}f{k} f JOIN {p}s{k} s ON f.grp IS NOT DISTINCT FROM s.grp AND f.pos = s.pos)""")
    return ",\n".join(out)


#: Trees of up to 8 ** 7 documents of a language and 8 ** 3 languages.
_OP11 = f"""
WITH tab AS (
  SELECT list(v ORDER BY b) AS tab FROM (SELECT b, list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(b))
), d AS (
  SELECT *, row_number() OVER () AS r, {_op11_values('text')} AS leaf,
    {_op11_values("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 3 = 0 AS hit
  FROM documents, tab
), o AS (
  SELECT r, lang AS grp, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf,
    CASE WHEN hit THEN lowered ELSE leaf END AS cur FROM d
), an0 AS (SELECT grp, pos, leaf AS h FROM o), af0 AS (SELECT r, grp, pos, cur, '' AS sib FROM o),
{_op11_tree('a', 7)},
g AS (SELECT grp AS lang, 0 AS grp, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, h FROM an7),
bn0 AS (SELECT grp, pos, h FROM g),
bf0 AS (SELECT r, g.grp, g.pos, cur, sib FROM af7 f JOIN g ON f.grp IS NOT DISTINCT FROM g.lang),
{_op11_tree('b', 3)}
SELECT d.doc_id, d.leaf, g.h AS subroot, t.h AS root, sha256(f.sib) AS proof_sha256, f.cur AS folded_root, f.cur = t.h AS verified
FROM d JOIN bf3 f USING (r) JOIN g ON d.lang IS NOT DISTINCT FROM g.lang JOIN bn3 t ON true
"""

_OP12 = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), l AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false)::INT AS good, coalesce(bool_or(toxic = 1), false)::INT AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN l USING (doc_id)
), m AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), x AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), steps AS (
  SELECT o AS filter_order, step, o[step] AS own, left(o, step - 1) AS earlier
  FROM (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    (SELECT unnest(range(1, 6))::INT AS step)
), c AS (
  SELECT part, filter_order, step, own,
    sum(n) FILTER (WHERE translate(fails, earlier || own, '') = fails) AS kept,
    sum(n) FILTER (WHERE contains(fails, own) AND translate(fails, earlier, '') = fails) AS removed,
    sum(n) FILTER (WHERE contains(fails, own) AND translate(fails, earlier, '') <> fails) AS redundant,
    sum(n) FILTER (WHERE fails = own) AS unique_fails,
    sum(good) FILTER (WHERE contains(fails, own) AND translate(fails, earlier, '') = fails) AS good_lost,
    sum(toxic) FILTER (WHERE contains(fails, own) AND translate(fails, earlier, '') = fails) AS toxic_lost
  FROM m, steps GROUP BY ALL
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM c
"""

_OP5 = """
WITH RECURSIVE e AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), ok AS (
  SELECT * FROM e WHERE vec_id IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), p AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), r AS (
  SELECT vec_id AS id, vec_id AS c FROM ok UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.id
), c AS (
  SELECT id, min(c) AS c FROM r GROUP BY id
), n AS (
  SELECT a, count(*) AS n FROM p GROUP BY a
)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.c, e.vec_id) AS component_id, coalesce(coalesce(c.c, e.vec_id) = e.vec_id, false) AS kept
FROM e LEFT JOIN c ON c.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
_BENT = f"""(SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS embedding FROM embeddings UNION ALL
  SELECT vec_id + {COPY}, list_transform(embedding, lambda x, i: x::DOUBLE * (1000 + ((i - 1) * 7 + vec_id) % 13) / 1000) FROM embeddings UNION ALL
  SELECT vec_id + {2 * COPY}, list_transform(embedding, lambda x, i: x::DOUBLE * (((i - 1) * (vec_id % 5 + 1)) % 7 + 1) / 7) FROM embeddings)"""

ORACLE_SQL: dict[str, str] = {
    "op5_embedding_near_dedup": _OP5,
    "op5_embedding_copies": _OP5.replace("FROM embeddings", f"FROM {_BENT}"),
    "op6_few_lines": _OP6.replace("n > 20", "n > 5"),
    "op7_warc_copies": _OP7.replace("FROM pages", f"FROM (SELECT page_id, html FROM pages UNION ALL SELECT page_id + {COPY}, html FROM pages)"),
    "op11_merkle_manifest": _OP11,
    "op12_filter_audit": _OP12,
    "op7_warc_reassembly": _OP7,
    "op9_extendible_sharding": _OP9,
    "op1_hierarchical_mixing": _OP1,
    "op6_quality_rules": _OP6,
    "op6_absolute_lines": _OP6.replace("coalesce(doc_id::VARCHAR, 'text ' || t)", "t")}
