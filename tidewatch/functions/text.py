"""Text functions: names, domains, similarity, numbers, clauses. Columns first, vectorised UDFs for the rest."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

#: Legal forms that carry no identity, wherever they stand in a name.
LEGAL_FORMS = ("incorporated", "inc", "corp", "corporation", "co", "company", "llc", "l.l.c", "ltd", "limited", "plc", "gmbh", "ag", "sa", "s.a", "sas", "sarl",
               "srl", "spa", "s.p.a", "bv", "b.v", "nv", "n.v", "oy", "ab", "as", "a/s", "pty", "pvt", "kg", "kgaa", "se", "lp", "llp", "pc", "pllc", "the")
LEGAL_FORMS_RE = tuple(re.escape(w) for w in LEGAL_FORMS)
#: Japanese legal forms.
JAPANESE_FORMS = ("株式会社", "有限会社", "合同会社", "合資会社", "合名会社", "(株)", "(有)", "(合)", "(資)", "(名)", "一般社団法人", "公益社団法人", "一般財団法人",
                  "公益財団法人", "社会福祉法人", "社会医療法人", "医療法人社団", "医療法人財団", "医療法人", "学校法人", "特定非営利活動法人", "npo法人",
                  "地方独立行政法人", "独立行政法人", "国立研究開発法人", "国立大学法人", "公立大学法人", "宗教法人")
#: Words that qualify a name without telling organisations apart.
QUALIFIERS = ("of north america", "of america", "north america", "u s a", "u s", "usa", "us", "holdings", "holding", "group", "services")
#: Words that turn a clause around.
NEGATIONS = ("no", "not", "never", "none", "without", "denied", "denies", "neither")
#: Japanese endings and words that turn a clause around.
JAPANESE_NEGATIONS = ("ません", "なかった", "おらず", "否定")
#: Adjectives that end like a negation and negate nothing; what may follow a negation within a clause.
NOT_NEGATIONS, AFTER_NEGATION = ("少ない", "間もない", "危ない"), ("と", "こと", "もの", "よう")
#: Multipliers written after a number.
SCALES = {"thousand": 10**3, "k": 10**3, "million": 10**6, "m": 10**6, "billion": 10**9, "bn": 10**9, "千": 10**3, "万": 10**4, "億": 10**8}
#: Byte units.
SIZES = {"kb": 10**3, "mb": 10**6, "gb": 10**9, "tb": 10**12, "pb": 10**15}

#: Words that many organisations carry and that tell none apart.
GENERIC_WORDS = (
    "group", "services", "service", "health", "healthcare", "medical", "center", "centre", "hospital", "system", "systems", "school", "schools", "district",
    "university", "college", "bank", "insurance", "international", "national", "american", "america", "united", "states", "global", "solutions", "technologies",
    "technology", "associates", "partners", "care", "clinic", "county", "city", "department", "state", "community", "family", "first", "new", "north", "south",
    "east", "west", "general", "capital", "financial", "management", "consulting", "industries", "holdings", "corporation", "company", "association", "foundation",
    "church", "law", "firm", "office", "public", "credit", "union", "trust", "energy", "data", "network", "software", "cloud", "digital", "media", "enterprises",
    "enterprise", "pharmacy", "dental", "physicians", "practice", "government", "council", "police", "court", "museum", "library", "airlines", "airport", "motors",
    "auto", "construction", "engineering", "manufacturing", "logistics", "transport", "realty", "real", "estate")


_LEGAL = re.compile(r"(?<![a-z0-9])(?:" + "|".join(sorted(LEGAL_FORMS_RE, key=len, reverse=True)) + r")(?![a-z0-9])\.?")
_JAPANESE = re.compile("|".join(re.escape(w) for w in sorted(JAPANESE_FORMS, key=len, reverse=True)))


#: Code points of Han, hiragana, katakana and their repeat marks, first and last; the middle dot is none.
CJK = ((0x3005, 0x3007), (0x3041, 0x3096), (0x309D, 0x309F), (0x30A1, 0x30FA), (0x30FC, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F))


def is_cjk(c: str) -> bool:
    return any(first <= ord(c) <= last for first, last in CJK)


def normal_name(name: str | None) -> str | None:
    """Lower-case words without accents, punctuation and legal forms; Han and kana stay, unspaced among themselves."""
    if name is None:
        return None
    folded = unicodedata.normalize("NFKD", name)
    if not any(map(is_cjk, unicodedata.normalize("NFKC", name))):
        plain = folded.encode("ascii", "ignore").decode().lower().replace("&", " and ")
        return " ".join(re.findall(r"[a-z0-9]+", _LEGAL.sub(" ", plain)))
    bare = unicodedata.normalize("NFKC", "".join(c for c in folded if not "\u0300" <= c <= "\u036f")).replace("\u30fb", "").lower().replace("&", " and ")
    bare = "".join(c if c.isascii() or is_cjk(c) else " " for c in bare)
    bare = _LEGAL.sub(" ", _JAPANESE.sub(" ", bare))
    # runs of Latin letters and digits, and runs of Han and kana; the latter are one word across spaces
    out: list[str] = []
    for run in re.findall(r"[a-z0-9]+|[^\x00-\x7f]+", bare):
        if out and is_cjk(run[0]) and is_cjk(out[-1][-1]):
            out[-1] += run
        else:
            out.append(run)
    return " ".join(out)


def plain_name(name: Column) -> Column:
    """:func:`normal_name` for names in ASCII, as a column expression."""
    bare = F.regexp_replace(F.lower(name), "&", " and ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"\b(" + "|".join(LEGAL_FORMS_RE) + r")\b\.?", " "), r"[^a-z0-9]+", " "))


def link_key(normal: Column) -> Column:
    """A normal name without its qualifiers (longest first, whole words); the name itself if nothing is left."""
    short = F.concat(F.lit(" "), normal, F.lit(" "))
    for q in QUALIFIERS:
        for _ in range(2):  # neighbours share a space
            short = F.regexp_replace(short, f" {q} ", " ")
    return F.coalesce(F.nullif(F.trim(short), F.lit("")), normal)


def registrable_label(domain: Column) -> Column:
    """The registrant's label of a domain: acme of acme.com and of acme.co.uk."""
    parts = F.split(domain, r"\.")
    second = F.element_at(parts, -2).isin("co", "com", "org", "net", "ac", "gov", "edu", "ne", "or", "go") & (F.length(F.element_at(parts, -1)) == 2)
    return F.when(F.size(parts) >= 2, F.when((F.size(parts) >= 3) & second, F.element_at(parts, -3)).otherwise(F.element_at(parts, -2))).otherwise(domain)


def jaro_winkler(a: str, b: str) -> float:
    """Similarity of two strings by matching characters, whole transpositions and, above 0.7, a common start of up to four."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free = [True] * len(b)
    met = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                met.append((i, j))
                break
    m = len(met)
    if not m:
        return 0.0
    other = sorted(j for _, j in met)
    # characters out of place make a transposition by twos; a third one adds none
    swapped = sum(a[i] != b[j] for (i, _), j in zip(met, other)) // 2
    base = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    if base <= 0.7:
        return base
    start = 0
    while start < min(4, len(a), len(b)) and a[start] == b[start]:
        start += 1
    return base + start * 0.1 * (1 - base)


_NUMBER = re.compile(r"(\d{1,3}(?:,\d{3})+|\d+)(\.\d+)?\s*(thousand|million|billion|bn|k|m|万|億)?(?![a-z0-9])", re.I)
_SIZE = re.compile(r"(\d+(?:[.,]\d+)?)\s*([kmgtp])i?b\b", re.I)


_JAPANESE_NUMBER = re.compile(r"(?:\d[\d,]*(?:\.\d+)?\s*[億万千])+(?:\d[\d,]*)?")
_JAPANESE_PART = re.compile(r"(\d[\d,]*(?:\.\d+)?)\s*([億万千]?)")


def numbers_in(text: str | None) -> list[float]:
    """Numbers stated in a text, in order: thousands separators and scale words applied, Japanese parts added up (1億2000万)."""
    plain, out = text or "", []
    for m in _JAPANESE_NUMBER.finditer(plain):
        out.append((m.start(), sum(float(n.replace(",", "")) * SCALES.get(k, 1) for n, k in _JAPANESE_PART.findall(m[0]))))
    rest = _JAPANESE_NUMBER.sub(lambda m: " " * len(m[0]), plain)
    out += [(m.start(), float(m[1].replace(",", "") + (m[2] or "")) * SCALES.get((m[3] or "").lower(), 1)) for m in _NUMBER.finditer(rest)]
    return [n for _, n in sorted(out)]


def sizes_in(text: str | None) -> list[float]:
    """Byte sizes stated in a text."""
    return [float(m[1].replace(",", ".")) * SIZES[m[2].lower() + "b"] for m in _SIZE.finditer(text or "")]


def _denied(clause: str) -> bool:
    """Whether a Japanese clause ends in a negation, or holds one before a particle."""
    for word in NOT_NEGATIONS:
        clause = clause.replace(word, " ")
    return any(n in clause for n in JAPANESE_NEGATIONS) or clause.rstrip(" 」』)）").endswith("ない") or any("ない" + x in clause for x in AFTER_NEGATION)


def negated(text: str | None, cue: str) -> bool:
    """Whether the clause that holds ``cue`` also holds a negation, before or after it, in English or Japanese."""
    for clause in re.split(r"[.;:!?。！？、]|,\s+(?:but|while|although)\b", (text or "").lower()):
        if cue.lower() in clause and (set(re.findall(r"[a-z']+", clause.replace("n't", " not"))) & set(NEGATIONS) or _denied(clause)):
            return True
    return False


def grounded(quote: str | None, document: str | None, value: float | None, cue: str = "") -> str | None:
    """Why a claim with a quote is refused, or null: the quote must be in the text and the number in the quote."""
    squeeze = lambda s: " ".join((s or "").split())
    q = squeeze(quote)
    if len(q) < 12:
        return "quote too short"
    if q not in squeeze(document):
        return "quote not in document"
    if value is not None and not any(abs(n - value) < 1e-9 for n in numbers_in(q)):
        return "number not in quote"
    return "negated" if cue and negated(q, cue) else None


@F.pandas_udf(StringType())
def normal_name_udf(names: pd.Series) -> pd.Series:
    seen = {n: normal_name(n) for n in names.dropna().unique()}
    return names.map(seen)


@F.pandas_udf(DoubleType())
def jaro_winkler_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    seen: dict = {}
    return pd.Series([None if x is None or y is None else seen.setdefault((x, y), jaro_winkler(x, y)) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(ArrayType(DoubleType()))
def numbers_udf(texts: pd.Series) -> pd.Series:
    return texts.map(numbers_in)


@F.pandas_udf(StringType())
def grounded_udf(quote: pd.Series, document: pd.Series, value: pd.Series) -> pd.Series:
    return pd.Series([grounded(q, d, None if pd.isna(v) else float(v)) for q, d, v in zip(quote, document, value)], dtype=object)


@F.pandas_udf(StringType())
def refused_udf(quote: pd.Series, document: pd.Series, value: pd.Series, cue: pd.Series) -> pd.Series:
    """:func:`grounded` with the word whose clause must not be negated."""
    return pd.Series([grounded(q, d, None if pd.isna(v) else float(v), c or "") for q, d, v, c in zip(quote, document, value, cue)], dtype=object)


def domain_of(url: Column) -> Column:
    """Host of a url or bare domain: lower case, no scheme, port, path or leading www; null if it has no dot."""
    host = F.regexp_extract(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]+)", 1)
    host = F.regexp_replace(host, r"^www\.|\.$", "")
    return F.when(host.contains("."), host)


def sentences(text: Column) -> Column:
    """Trimmed, non-empty sentences: split after . ! ? and at line ends."""
    return F.filter(F.transform(F.split(text, r"[.!?]+|\n"), lambda s: F.trim(s)), lambda s: s != "")


def trigrams(s: Column) -> Column:
    """Distinct three-letter windows of a string; a shorter one is its own window."""
    wins = F.transform(F.sequence(F.lit(1), F.length(s) - 2), lambda i: F.substr(s, i, F.lit(3)))
    return F.array_distinct(F.when(F.length(s) >= 3, wins).otherwise(F.array(s)))


def padded(s: Column) -> Column:
    """A name for trigrams that also tell how it begins and ends: two blanks before it, one behind."""
    return F.concat(F.lit("  "), s, F.lit(" "))


def trigram_similarity(a: Column, b: Column) -> Column:
    x, y = trigrams(a), trigrams(b)
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def id_namespace(identifier: Column) -> Column:
    """cve, euvd, ghsa, gcve or other, by the whole identifier."""
    up = F.upper(F.trim(identifier))
    return (
        F.when(up.rlike(r"^CVE-\d{4}-\d{4,}$"), "cve").when(up.rlike(r"^EUVD-\d{4}-\d+$"), "euvd")
        .when(up.rlike(r"^GHSA(-[0-9A-Z]{4}){3}$"), "ghsa").when(up.rlike(r"^GCVE-\d+-\d{4}-\d+$"), "gcve").otherwise("other"))


def first_cve(*candidates: Column) -> Column:
    """The first identifier found in the candidates, in order, upper case."""
    found = [F.regexp_extract(F.upper(c), r"CVE-\d{4}-\d{4,}", 0) for c in candidates]
    return F.coalesce(*[F.when(x != "", x) for x in found])


def cve_year(identifier: Column) -> Column:
    """The year in the identifier, never the publication year."""
    y = F.regexp_extract(identifier, r"^CVE-(\d{4})-", 1)
    return F.when(y != "", y.cast("int"))


#: Words that add no initial to an acronym.
SMALL_WORDS = ("of", "the", "and", "for", "in", "at", "on", "to", "de", "la", "du")


def initials(name: str | None) -> str:
    """First letters of a name's words, without legal forms and small words."""
    return "".join(w[0] for w in (normal_name(name) or "").split() if w not in SMALL_WORDS)


def is_acronym(short: str | None, long: str | None) -> bool:
    """Whether one name of three letters or more is made of the other's initials."""
    squashed = (normal_name(short) or "").replace(" ", "")
    return len(squashed) >= 3 and len((normal_name(long) or "").split()) >= 3 and squashed == initials(long)


def is_masked(name: Column) -> Column:
    """Names that hide or stand for a victim: starred, without letters, or a placeholder word alone."""
    return name.rlike(r"\*{2,}|^[\W\d_]*$") | F.lower(F.trim(name)).rlike(r"^(redacted|undisclosed|unknown|confidential|n/?a|test|example|tba|tbd)\b.{0,3}$")
