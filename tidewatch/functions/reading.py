"""Reading texts: lists with parentheses, stated volumes, the text of an article page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: One element of a list may hold separators of its own; its parts are kept together (pattern, what it becomes; \x01 is a comma).
WHOLE_ELEMENTS = (
    (r"(?i)(account number)\W+(credit card account number)\W+(or debit card number)", "$1\x01 $2\x01 $3"),
    (r"(?i)(health insurance policy number)\W+(subscriber ID(?: number)?)", "$1\x01 $2"),
    (r"(?i)(username or email address),?\s*(in combination with password or security question)", "$1\x01 $2"),
)
_EDGES = " .'\"\t"


def masked(text: Column, elements: tuple = WHOLE_ELEMENTS) -> Column:
    for pattern, kept in elements:
        text = F.regexp_replace(text, pattern, kept)
    return text


def listed_items(texts: DataFrame, key: str, text: str, elements: tuple = WHOLE_ELEMENTS) -> DataFrame:
    """(key, place, item): the items that each text lists, in order, each once.

    A text is cut at commas, semicolons and line ends outside brackets, and at "and" or "&" before a capital letter; whole elements keep their
    own separators. A leading "and" or "or" goes; what begins with "in combination" belongs to the item before it; items have two letters at least. The
    depth of brackets is a running sum over the text's pieces that never falls below zero. Null and empty texts list nothing.
    """
    pieces = F.regexp_extract_all(masked(F.col(text), elements), F.lit(r"[^()\[\],;\n]+|[()\[\],;\n]"), F.lit(0))
    d = texts.select(key, F.posexplode(pieces).alias("pos", "piece"))
    so_far = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("piece").isin("(", "["), 1).when(F.col("piece").isin(")", "]"), -1).otherwise(0)
    d = d.withColumn("sum", F.sum(step).over(so_far))
    d = d.withColumn("depth", F.col("sum") - F.least(F.lit(0), F.min("sum").over(so_far)))
    ends = F.col("piece").isin(",", ";", "\n") & (F.col("depth") == 0)
    d = d.withColumn("ends", ends).withColumn("part", F.sum(ends.cast("int")).over(so_far)).where("not ends")
    parts = d.groupBy(key, "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"]), "").alias("s"))
    labels = F.split(F.regexp_replace("s", r"\s+(?:and|&)\s+([A-Z])", "\x03$1"), "\x03")
    d = parts.select(key, "part", F.posexplode(labels).alias("k", "s"))
    s = F.btrim(F.regexp_replace(F.translate("s", "\x01", ","), r"\s+", " "), F.lit(_EDGES))
    d = d.withColumn("s", F.trim(F.regexp_replace(s, r"^(?i:and/or|and|or)\s+", ""))).where(F.length(F.regexp_replace("s", r"[^\p{L}]", "")) >= 2)
    order = Window.partitionBy(key).orderBy("part", "k")
    goes_on = F.col("s").rlike(r"^(?i:in combination)\b") & (F.row_number().over(order) > 1)
    d = d.withColumn("goes_on", goes_on).withColumn("item", F.sum((~goes_on).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = d.groupBy(key, "item").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "k", "s"))), lambda x: x["s"]), ", ").alias("text"))
    first = whole.groupBy(key, F.col("text").alias("item")).agg(F.min("item").alias("at"))
    return first.select(key, F.row_number().over(Window.partitionBy(key).orderBy("at")).alias("place"), "item")


#: Qualifiers of a stated volume, and what they say.
QUALIFIERS = {"over": "over", "more than": "over", "above": "over", "about": "about", "around": "about", "approx": "about", "approximately": "about", "~": "about", "nearly": "about",
              "almost": "about", "up to": "up_to"}
#: Units of bytes and scales of numbers.
BYTES = {"kb": 1e3, "mb": 1e6, "megabyte": 1e6, "megabytes": 1e6, "gb": 1e9, "gigabyte": 1e9, "gigabytes": 1e9, "tb": 1e12, "terabyte": 1e12, "terabytes": 1e12, "pb": 1e15}
SCALES = {"k": 1e3, "thousand": 1e3, "m": 1e6, "mln": 1e6, "million": 1e6, "bn": 1e9, "billion": 1e9}
#: What is counted otherwise.
COUNTED = {"files": ("file", "files", "document", "documents"), "records": ("record", "records", "row", "rows", "entries"),
           "persons": ("customer", "customers", "patient", "patients", "employee", "employees", "user", "users", "client", "clients", "student", "students", "member", "members",
                       "person", "persons", "people", "individuals")}
_UNITS = "|".join(sorted([*BYTES, *(w for ws in COUNTED.values() for w in ws)], key=len, reverse=True))
_SCALED = "|".join(sorted(SCALES, key=len, reverse=True))
_QUALIFIED = "|".join(sorted([*QUALIFIERS, r"approx\."], key=len, reverse=True))
VOLUME = rf"(?i)(?:({_QUALIFIED})\s*)?(\d[\d,.]*)\s*({_SCALED})?\s*(\+)?\s*({_UNITS})\b(\+)?"


def _looked_up(word: Column, table: dict) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), word)


_KINDS = {w: k for k, ws in COUNTED.items() for w in ws}


def volumes(text: Column) -> Column:
    """Volumes stated in a text, in order: (span, qualifier, value, unit of bytes, files, records or persons).

    A plus behind number or unit says "over"; before a unit of bytes a comma with one or two digits is a decimal comma, other commas part thousands;
    nothing, zero and numbers that can't be read are left out.
    """
    def groups(span: Column) -> Column:
        return F.struct(span.alias("span"), *[F.lower(F.regexp_extract(span, VOLUME, k)).alias(f"g{k}") for k in range(1, 7)])

    def read(x: Column) -> Column:
        return F.struct(x["span"].alias("span"), x["g1"].alias("g1"), x["g3"].alias("g3"), (F.concat(x["g4"], x["g6"]) != "").alias("plus"), x["g2"].alias("digits"), _looked_up(x["g5"], BYTES).alias("size"),
                        _looked_up(x["g5"], _KINDS).alias("kind"))

    def one(x: Column) -> Column:
        decimal = x["size"].isNotNull() & x["digits"].rlike(r"^\d+,\d{1,2}$")
        digits = F.when(decimal, F.translate(x["digits"], ",", ".")).otherwise(F.translate(x["digits"], ",", ""))
        value = F.round(digits.try_cast("double") * F.coalesce(_looked_up(x["g3"], SCALES), F.lit(1.0)) * F.coalesce(x["size"], F.lit(1.0)))
        said = F.when(x["plus"], "over").otherwise(F.coalesce(_looked_up(F.rtrim(x["g1"], F.lit(".")), QUALIFIERS), F.lit("exact")))
        return F.struct(F.trim(x["span"]).alias("span"), said.alias("qualifier"), value.alias("value"), F.when(x["size"].isNotNull(), "bytes").otherwise(x["kind"]).alias("unit"))

    spans = F.regexp_extract_all(text, F.lit(VOLUME), F.lit(0))
    return F.filter(F.transform(F.transform(F.transform(spans, groups), read), one), lambda v: v["value"] > 0)


#: Elements of a page that hold no text of an article.
NO_TEXT = ("script", "style", "noscript", "figure", "aside", "nav", "footer", "header")
#: Named entities.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'"}
LONG_PARAGRAPH, LONG_ARTICLE = 40, 300


def unescaped(text: Column) -> Column:
    """Entities replaced once: decimal numbers, the named ones above, and the ampersand last."""
    codes = F.array_distinct(F.regexp_extract_all(text, F.lit("&#([0-9]{1,6});"), F.lit(1)))
    char = lambda n: F.decode(F.unhex(F.lpad(F.hex(n.cast("int")), 8, "0")), "UTF-32")
    text = F.aggregate(codes, text, lambda s, n: F.replace(s, F.concat(F.lit("&#"), n, F.lit(";")), char(n)))
    for k, v in ENTITIES.items():
        text = F.replace(text, F.lit(k), F.lit(v))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def plain_text(fragment: Column) -> Column:
    """A fragment of a page without elements that hold no text, without tags, on one line."""
    for tag in NO_TEXT:
        fragment = F.regexp_replace(fragment, rf"(?is)<{tag}\b.*?</{tag}>", " ")
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(fragment, r"<[^>]+>", " ")), r"\s+", " "))


def article_text(html: Column) -> Column:
    """The paragraphs of the page's first article element (else of the page) of more than 40 characters, a line each.

    If they make 300 characters or less, all text of the element is taken. Null gives null. A paragraph that never ends is text of the one that holds
    it; what a script writes is in no paragraph of an article.
    """
    scope = F.coalesce(F.nullif(F.regexp_extract(html, r"(?is)<article\b.*?</article>", 0), F.lit("")), html)

    def text_of(scope: Column) -> Column:
        paragraphs = F.filter(F.transform(F.regexp_extract_all(scope, F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), F.lit(1)), plain_text), lambda p: F.length(p) > LONG_PARAGRAPH)
        joined = F.array_join(paragraphs, "\n")
        return F.when(F.length(joined) > LONG_ARTICLE, joined).otherwise(plain_text(scope))

    return F.get(F.transform(F.array(scope), text_of), F.lit(0))


def phrase_runs(words: Column, longest: int = 4, shortest: int = 1, between: str = " ") -> Column:
    """Distinct runs of ``shortest`` to ``longest`` neighbouring words; ``words`` is computed once a row."""
    none = F.array().cast("array<string>")

    def runs(w: Column) -> Column:
        run = lambda n: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), between))).otherwise(none)
        return F.array_distinct(F.flatten(F.array(*[run(n) for n in range(shortest, longest + 1)])))

    return F.get(F.transform(F.array(words), runs), F.lit(0))


def norm_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def relevant(titles: DataFrame, names: DataFrame, terms: DataFrame, longest: int = 4) -> DataFrame:
    """(id, name): titles (id, title) that hold a name (name) as a whole phrase of up to ``longest`` words and, besides, one of the terms (term)."""
    runs = titles.select("id", phrase_runs(norm_words(F.col("title")), longest).alias("runs"))
    held = runs.select("id", F.explode("runs").alias("k"))
    key = F.array_join(norm_words(F.col("name")), " ")
    known = names.select("name", key.alias("k")).where("k <> ''").groupBy("k").agg(F.min("name").alias("name"))
    told = held.join(terms.select(F.array_join(norm_words(F.col("term")), " ").alias("k")).distinct(), "k").select("id", F.col("k").alias("term"))
    hits = held.join(known, "k").select("id", "name", "k")
    # the term must be more than the name itself
    return hits.join(told, "id").where(~F.concat(F.lit(" "), "k", F.lit(" ")).contains(F.concat(F.lit(" "), F.col("term"), F.lit(" ")))).select("id", "name").distinct()
