"""Quality rules: per-text counts and cross-document line frequency, in DataFrame functions only.

Lines are normalised (lower case, white space runs to one space, trimmed) and hashed. For each
host (``source``) the distinct documents holding a line are counted: rows of one ``doc_id`` count once, a
row without an id counts by its text. A line is removed on a host where more than ``min_docs`` documents hold it,
whatever the host's size. With ``by="texts"`` equal texts count once instead, so that a page copied many times does not
turn its own lines into boilerplate (the corpus pipeline, where copies are taken out later). A document is rejected
when lines were removed and fewer than ``min_words`` words or less than ``left_percent`` per cent of its words stay.

Counting is cheap first: rows holding a line are summed in each task before the shuffle; only lines above the limit
in rows, a superset, are counted exactly.

Size of what is joined back: while each host has at most ``LONGEST`` frequent lines, a host's list goes
with it to its documents as a broadcast array. Else only the ``LONGEST`` pairs of host and line that most
texts hold go that way, and the others are joined to the distinct texts by (host, line): each of them is held
by less than one ``LONGEST``-th of all that is joined, so none is a hot key.

Defined cases: an empty table gives an empty result; very long texts are read whole; no rule depends on an order, so ties
don't occur; a null text counts as an empty one; a null ``source`` is a host of its own; a
line without a word is never counted or removed; every input row gives one row, repeated rows
and null ids included; extra columns pass through ``filtered`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import store

GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_DOCS, MIN_WORDS, LEFT_PERCENT = 20, 10, 25
WINDOW = 5
#: Lines of one host that go to its documents as an array.
LONGEST = 1_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")


def _key(line: Column) -> Column:
    return F.xxhash64(F.lower(F.btrim(F.regexp_replace(line, GAP, " "))))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: str) -> Column:
    """Words inside WINDOW-word windows that occur at least twice, from hashed windows.

    The windows' hashes are compared as a whole first; only a text with an equal pair sorts them
    with their places, and the places' union is measured from gap to gap.
    """
    wins = F.col("wins")
    placed = F.sort_array(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        again = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    covered = F.aggregate(
        _let(placed, places),
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("at")),
        lambda s, x: F.struct((s["n"] + F.least(F.lit(WINDOW), x - s["at"])).alias("n"), x.alias("at")),
        lambda s: s["n"],
    )
    return F.when(F.size(F.array_distinct(wins)) < F.size(wins), covered).otherwise(0)


def _measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts; helper columns start with an underscore."""
    body = F.coalesce("text", F.lit(""))
    d = docs.withColumn("_words", words_of(body)).withColumn("_lines", _lines(body))
    d = d.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    h = F.col("_hashes")
    d = d.withColumn("wins", F.when(
        F.size("_words") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW),
                    lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<long>")))
    n_words, repeats = F.size("_words").cast("long"), _repeat_words("_words").cast("long")
    d = d.select(
        *[c for c in d.columns if c not in ("wins", "_hashes")],
        n_words.alias("_n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("_word_chars"),
        F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("_n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("_n_dup_lines"),
        repeats.alias("_n_repeat_words"),
    )
    return d.drop("_words")


def _identity() -> list[Column]:
    body = F.coalesce("text", F.lit(""))
    return [F.coalesce("source", F.lit("")).alias("_host"), F.xxhash64(body).alias("_t"), F.length(body).alias("_n")]


def _texts(docs: DataFrame) -> DataFrame:
    """(_host, _t, _n, keys): the distinct texts of each host and their distinct lines."""
    keys = F.array_distinct(F.transform(_lines(F.coalesce("text", F.lit(""))), _key)).alias("keys")
    return docs.select(*_identity(), keys).groupBy("_host", "_t", "_n").agg(F.first("keys").alias("keys"))


def _rows(docs: DataFrame) -> DataFrame:
    """(_host, _doc, keys): each row's document and its distinct lines."""
    body = F.coalesce("text", F.lit(""))
    keys = F.array_distinct(F.transform(_lines(body), _key)).alias("keys")
    doc = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.xxhash64(body), F.length(body)))
    return docs.select(F.coalesce("source", F.lit("")).alias("_host"), doc.alias("_doc"), keys)


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, by: str = "documents") -> DataFrame:
    """(_host, key, docs): the hashes of the lines above the limit, and how many documents (or texts) hold each."""
    if by == "texts":
        held = _texts(docs).select("_host", F.explode("keys").alias("key"))
        return held.groupBy("_host", "key").agg(F.count("*").alias("docs")).where(F.col("docs") > min_docs)
    # eight bytes a line: written once, so that the texts are read once here
    held = store.saved(_rows(docs), "host-lines").select("_host", "_doc", F.explode("keys").alias("key"))
    often = store.saved(held.groupBy("_host", "key").agg(F.count("*").alias("rows")).where(F.col("rows") > min_docs).drop("rows"), "often")
    # distinct (document, line) pairs are dealt by all three columns, so a line that very many hold is no hot key
    pairs = held.join(store.hinted(often), ["_host", "key"], "left_semi").distinct()
    return pairs.groupBy("_host", "key").agg(F.count("*").alias("docs")).where(F.col("docs") > min_docs)


def _with_frequent(docs: DataFrame, min_docs: int, by: str) -> DataFrame:
    """``docs`` with _host and _frequent, the frequent lines of its host (all those it holds, at least)."""
    pairs = store.saved(frequent_lines(docs, min_docs, by), "frequent-lines")
    longest, rows = pairs.groupBy("_host").agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).first()
    short = (longest or 0) <= LONGEST and (rows or 0) <= store.BROADCAST_ROWS
    first = pairs if short else store.saved(pairs.orderBy(F.desc("docs"), "_host", "key").limit(LONGEST), "first-lines")
    arrays = F.broadcast(first.groupBy("_host").agg(F.collect_set("key").alias("_frequent")))
    d = docs.withColumn("_host", F.coalesce("source", F.lit("")))
    if short:
        return d.join(arrays, "_host", "left")
    at, known = ["_host", "key"], F.broadcast(first.select("_host", "key"))
    rest = pairs.select(*at).join(known, at, "left_anti")
    lines = _texts(docs).select("_host", "_t", "_n", F.explode("keys").alias("key")).join(known, at, "left_anti")
    more = lines.join(rest, at).groupBy("_host", "_t", "_n").agg(F.collect_set("key").alias("_more"))
    d = docs.select("*", *_identity()).join(more, ["_host", "_t", "_n"], "left").join(arrays, "_host", "left")
    none = F.array().cast("array<long>")
    both = F.concat(F.coalesce("_frequent", none), F.coalesce("_more", none))
    return d.withColumn("_frequent", both).drop("_t", "_n", "_more")


def _hit_lines(lines: Column, keep: bool) -> Column:
    """Of ``lines`` those that are frequent on the row's host (or, with ``keep``, all others)."""
    return _let(F.col("_hits"), lambda hits: F.filter(lines, lambda x: F.array_contains(hits, _key(x)) != F.lit(keep)))


def _judged(docs, min_docs, by, min_words, left_percent):
    d = _measured(_with_frequent(docs, min_docs, by))
    none = F.array().cast("array<long>")
    # one look-up by hash of all lines of a text; most texts have no hit and need no more
    hits = F.when(F.col("_frequent").isNull(), none).otherwise(F.array_intersect(F.transform("_lines", _key), F.col("_frequent")))
    d = d.withColumn("_hits", hits)
    d = d.withColumn("_removed", F.when(F.size("_hits") == 0, F.array().cast("array<string>")).otherwise(_hit_lines(F.col("_lines"), False)))
    lost = F.aggregate("_removed", F.lit(0), lambda n, x: n + F.size(words_of(x)))
    d = d.withColumn("_left_words", F.col("_n_words") - lost)
    base = (F.col("_n_words") < 10) | (100 * F.col("_n_repeat_words") > 20 * F.col("_n_words"))
    spent = (F.size("_removed") > 0) & (
        (F.col("_left_words") < min_words) | (100 * F.col("_left_words") < left_percent * F.col("_n_words")))
    return d.withColumn("_base_failed", base).withColumn("_kept", ~base & ~spent)


def quality(docs: DataFrame, min_docs: int = MIN_DOCS, by: str = "documents",
            min_words: int = MIN_WORDS, left_percent: int = LEFT_PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): counts, removed lines, verdict."""
    d = _judged(docs.select("doc_id", "text", "source"), min_docs, by, min_words, left_percent)
    # a generator, which later filters on the verdict can't be pushed below: they would repeat all it is made of
    return d.select(F.inline(F.array(F.struct(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_word_chars").alias("word_chars"),
        F.col("_n_symbols").alias("n_symbols"), F.col("_n_dup_lines").alias("n_dup_lines"),
        F.col("_n_repeat_words").alias("n_repeat_words"), F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"), F.size("_removed").cast("long").alias("n_removed_lines"),
        F.col("_left_words").cast("long").alias("left_words")))))


def filtered(docs: DataFrame, min_docs: int = MIN_DOCS, by: str = "documents",
             min_words: int = MIN_WORDS, left_percent: int = LEFT_PERCENT) -> DataFrame:
    """The kept rows with all their columns; frequent lines are gone from ``text``."""
    # the row travels as one struct, so no column of it can clash with a helper; and rows are dropped by
    # a generator: a filter would be pushed below and repeat all that the verdict is made of
    d = _judged(docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text", "source"), min_docs, by, min_words, left_percent)
    clean = F.when(F.size("_removed") == 0, F.col("text")).otherwise(F.array_join(_hit_lines(F.split("text", "\n"), True), "\n"))
    keep = F.struct(*[F.col("_row")[c].alias(c) if c != "text" else clean.alias("text") for c in docs.columns])
    out = d.select(F.inline(F.when(F.col("_kept"), F.array(keep))))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
