"""Secret scan: fixed patterns, and guess-cost dynamic programming on credential values.

The fixed patterns (assign, access, hex) are always reported. Beside them, values that stand in
a credential context ("password is ...", "pwd: ...", "Authorization: Bearer ...") are priced: the
least base-2 logarithm of guesses over all segmentations of the value into dictionary words,
dates, repeats, keyboard walks and brute-force spans. A value that is at least as hard to
guess as ``MIN_BITS`` is reported with the kind ``guess``; prose after such a word is cheap and is not. A value made of
dictionary words and short numbers alone, bare or joined by one repeated sign ("enter-your-username-here"), is prose until it
costs ``WORDY_BITS``, its sign counted once.
Any run of spaces and tabs and one line break may stand before and after the separator. Values are words,
quoted runs of words, and after "passphrase:" all words up to the end of the clause or line; unquoted
words after "passphrase is" are priced one word only, as they can't be told from prose.

The dictionary is the list of whole words of a public vocabulary file; a word's place there is its rank.

Defined cases: null text counts as empty; an empty table gives an empty result; very long texts are read whole; equal
starts are ordered by kind; offsets are code points of the whole text, end
exclusive; repeated rows give repeated results; other columns are ignored by ``scan`` and kept by
``redacted``.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import store

KINDS = ("assign", "access", "hex", "guess")
VOCABULARY = "word_bpe_49k.json"
MIN_BITS, WORDY_BITS = 36.0, 72.0
MIN_VALUE, LONGEST_PIECE = 8, 40

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Blanks around a separator: any run of spaces and tabs, with one line break at most.
_GAP = r"[\x20\t]*+(?:\r?\n[\x20\t]*+)?"
_LINK = r"""["'`)\]]{0,2}""" + _GAP + r"""(?:[:=]{1,2}>?|->)"""
#: The words "pass", "pin" and the like start a word, or a hump of one (dbPass); those that end no other word may end a longer one.
_WORDS = (r"""(?:passphrase|passcode|passwd|password|(?:(?<![A-Za-z])|(?-i:(?<=[a-z])(?=[A-Z])))"""
          r"""(?:pass|pwd|pin|secret|token|api[_-]?key|access[_-]?key|private[_-]?key"""
          r"""|credentials?|bearer|auth(?:orization)?|login))""")
#: What may introduce a credential, and the value: the rest of that word.
_BEFORE = _WORDS + r"(?:" + _LINK + r"|[\x20\t]++(?:is|was|to|be|as)\b:?|[\x20\t]++(?=[^\x20]*[0-9]))" + _GAP
CONTEXT = re.compile(_BEFORE + r"""["'`]?([^\s"'`<>]{8,})""", re.I | re.A)
#: A quoted value of several words.
QUOTED = re.compile(_BEFORE + r"""(["'`])([^\n]{8,}?)\1""", re.I | re.A)
#: Words without quotes after a pass phrase's separator: to the end of the clause or line.
PHRASE = re.compile(r"pass[\x20_-]?phrase" + _LINK + _GAP + r"""([^\s"'`<>][^\r\n"'`<>]*)""", re.I | re.A)
_CLAUSE_END = re.compile(r"[.,;!?](?=\s|$)")
#: A text without any of these can match neither ASSIGN nor CONTEXT.
_HINTS = ("pass", "pwd", "pin", "secret", "token", "key", "credential", "bearer", "auth", "login")

#: Rows of a common keyboard.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
#: Usual replacements of letters.
LEET = {"4": "a", "@": "a", "8": "b", "3": "e", "6": "g", "1": "i", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t", "2": "z"}
_DATE = re.compile(r"(?:(?:19|20)\d\d)(?:[-/._]?(?:0?[1-9]|1[0-2])(?:[-/._]?(?:0?[1-9]|[12]\d|3[01]))?)?"
                   r"|(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:(?:19|20)\d\d|\d\d)")


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[str, int]:
    """Whole words of at least three letters of the vocabulary file, by place."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words = sorted((i, w[:-4]) for w, i in vocab.items() if w.endswith("</w>"))
    out: dict[str, int] = {}
    for _, w in words:
        if len(w) >= 3 and w.isascii() and w.isalpha():
            out.setdefault(w, len(out) + 1)
    return out


@lru_cache(maxsize=1)
def _beside() -> dict[str, str]:
    """The keys that touch each key, from the rows and their half-key shift."""
    out: dict[str, set[str]] = {}
    for r, row in enumerate(ROWS):
        for i, k in enumerate(row):
            near = {row[j] for j in (i - 1, i + 1) if 0 <= j < len(row)}
            for other, shift in ((r - 1, (0, 1)), (r + 1, (-1, 0))):
                if 0 <= other < len(ROWS):
                    near |= {ROWS[other][i + d] for d in shift if 0 <= i + d < len(ROWS[other])}
            out[k] = near
    return {k: "".join(sorted(v)) for k, v in out.items()}


def _char_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    if c.isascii() and c.isalpha():
        return math.log2(26)
    return math.log2(33) if c.isascii() else math.log2(100)


def _word_bits(piece: str, words: dict[str, int]) -> float | None:
    low = piece.lower()
    rank, changed = words.get(low), 0
    if rank is None:
        plain = "".join(LEET.get(c, c) for c in low)
        rank, changed = words.get(plain), sum(a != b for a, b in zip(low, plain))
        if rank is None:
            rank = words.get(low[::-1])
            if rank is None:
                return None
            changed = 1
    bits = math.log2(rank + 1) + changed
    upper = sum(c.isupper() for c in piece)
    if upper:
        bits += 1 if upper == len(piece) or (upper == 1 and piece[0].isupper()) else math.log2(math.comb(len(piece), upper) + 1)
    return bits


def guess_bits(value: str, words: dict[str, int]) -> float:
    """The least sum of piece costs over all segmentations of ``value`` (each piece adds one bit).

    Pieces are at most LONGEST_PIECE characters, but runs of one repeated unit have any length.
    """
    n, beside = len(value), _beside()
    low = value.lower()
    best = [0.0] + [math.inf] * n
    walk = [0] * (n + 1)
    for i in range(1, n):
        walk[i + 1] = walk[i] + 1 if low[i] in beside.get(low[i - 1], "") or abs(ord(low[i]) - ord(low[i - 1])) == 1 and low[i].isalnum() and low[i - 1].isalnum() else 0
    dates = [[] for _ in range(n + 1)]
    for i in range(n):
        if value[i].isdigit():
            m = _DATE.match(value, i)
            if m:
                dates[m.end()].append((i, math.log2(365 * 60) if m.end() - i > 4 else math.log2(120)))
    runs = [[] for _ in range(n + 1)]
    for unit in range(1, min(8, n // 2) + 1):
        i = 0
        while i + 2 * unit <= n:
            j = i + unit
            while j < n and value[j] == value[j - unit]:
                j += 1
            times = (j - i) // unit
            if times >= 2 and times * unit >= 3:
                end = i + times * unit
                runs[end].append((i, sum(map(_char_bits, value[i : i + unit])) + math.log2(times)))
                i = end - unit + 1
            else:
                i += 1
    for e in range(1, n + 1):
        # brute force, one character at a time; the piece cost is paid where a piece of another kind ends
        cost = best[e - 1] + _char_bits(value[e - 1])
        if walk[e] >= 2:
            length = walk[e] + 1
            for k in range(3, min(length, LONGEST_PIECE) + 1):
                cost = min(cost, best[e - k] + 1 + math.log2(47) + math.log2(k) + 0.5 * (k - 1))
        for s, bits in dates[e]:
            cost = min(cost, best[s] + 1 + bits)
        for s, bits in runs[e]:
            cost = min(cost, best[s] + 1 + bits)
        for s in range(max(0, e - LONGEST_PIECE), e - 2):
            if best[s] + 1 < cost and (bits := _word_bits(value[s:e], words)) is not None:
                cost = min(cost, best[s] + 1 + bits)
        best[e] = cost
    return best[n]


_JOINED = re.compile(r"([A-Za-z0-9]+)(?:([-_./+:~])[A-Za-z0-9]+(?:\2[A-Za-z0-9]+)*)?")


#: Endings of English words, and what stands there in the dictionary's form.
_ENDINGS = (("s", ""), ("es", ""), ("ed", ""), ("ed", "e"), ("ing", ""), ("ing", "e"), ("ly", ""), ("ily", "y"), ("able", ""), ("able", "e"), ("ness", ""))


def _rank_bits(word: str, words: dict[str, int]) -> float | None:
    """Bits of a dictionary word, or of one with a usual ending."""
    if word in words:
        return math.log2(words[word] + 1)
    stems = [words[x] for end, form in _ENDINGS if word.endswith(end) and (x := word[: len(word) - len(end)] + form) in words]
    return math.log2(min(stems) + 1) + math.log2(len(_ENDINGS)) if stems else None


def _word_sum(part: str, words: dict[str, int]) -> float | None:
    """The least bits of ``part`` as dictionary words in a row; a number of four digits at most and one or two letters count as words."""
    if part.isdigit():
        return len(part) * math.log2(10) if len(part) <= 4 else None
    if len(part) <= 2 and part.isalpha():
        return 1 + len(part) * math.log2(26) / 2
    if not part.isalpha():
        return None
    best = [0.0] + [math.inf] * len(part)
    for e in range(3, len(part) + 1):
        for s in range(max(0, e - LONGEST_PIECE), e - 2):
            if best[s] < math.inf and (bits := _rank_bits(part[s:e].lower(), words)) is not None:
                best[e] = min(best[e], best[s] + 1 + bits)
    return best[-1] if best[-1] < math.inf else None


def wordy_bits(value: str, words: dict[str, int]) -> float | None:
    """What a value made of words and short numbers costs, a repeated sign between them counted once; None for other values."""
    m = _JOINED.fullmatch(value)
    if not m:
        return None
    parts = [_word_sum(p, words) for p in (value.split(m[2]) if m[2] else [value])]
    return None if None in parts else sum(parts) + (math.log2(33) if m[2] else 0)


def is_secret(value: str, words: dict[str, int], min_bits: float = MIN_BITS) -> bool:
    """Whether a value of one word is too hard to guess to be prose."""
    if guess_bits(value, words) < min_bits:
        return False
    wordy = wordy_bits(value, words)
    return wordy is None or wordy >= max(min_bits, WORDY_BITS)


def _hinted(text: str) -> bool:
    low = text.lower()
    return any(h in low for h in _HINTS)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind as its place in KINDS, end) of the fixed patterns."""
    out = []
    if _hinted(text):
        out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _phrases(text: str) -> Iterator[tuple[int, str]]:
    """(start, value) of the values of several words."""
    for m in QUOTED.finditer(text):
        yield m.start(2), m[2]
    for m in PHRASE.finditer(text):
        end = _CLAUSE_END.search(m[1])
        yield m.start(1), (m[1][: end.start()] if end else m[1]).rstrip()


def guess_spans(text: str, words: dict[str, int], min_bits: float = MIN_BITS) -> list[tuple[int, int, int]]:
    """Values in a credential context that cost at least ``min_bits``; trailing punctuation is no part."""
    if not _hinted(text):
        return []
    # values of several words; a value of one word inside such a span is part of it
    out = sorted({(s, 3, s + len(v)) for s, v in _phrases(text)
                  if len(v) >= MIN_VALUE and len(v.split()) > 1 and guess_bits(v, words) >= min_bits})
    held, at = [], 0
    for s, k, e in out:
        if e > at:
            held.append((s, k, e))
            at = e
    out, at, j = [], 0, 0
    while m := CONTEXT.search(text, at):
        value, start = m[1].rstrip(".,;:!?)]}"), m.start(1)
        while j < len(held) and held[j][2] <= start:
            j += 1
        if j < len(held) and held[j][0] <= start:
            at = held[j][2]
        elif len(value) >= MIN_VALUE and not value.startswith(("http://", "https://")) and is_secret(value, words, min_bits):
            out.append((start, 3, start + len(value)))
            at = m.end()
        else:
            at = start  # the word may itself introduce a value
    return sorted(held + out)


def _coded(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _runner(path: str | None, min_bits: float):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        words = ranks(path or vocabulary_path())
        for batch in batches:
            rows = []
            for x in batch.column(1):
                base = base_spans(text := x.as_py() or "")
                spans = sorted(base + guess_spans(text, words, min_bits))
                counts = [sum(k == i for _, k, _ in spans) for i in range(4)]
                rows.append((*counts, hashlib.sha256(_coded(base).encode()).hexdigest(), _coded(spans)))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.record_batch(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:4]], *[pa.array(c, pa.string()) for c in cols[4:]]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"])

    return run


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def scan(docs: DataFrame, vocabulary: str | None = None, min_bits: float = MIN_BITS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts by kind, digest of the base spans, all spans."""
    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string"
    return store.spread(docs.select("doc_id", "text")).mapInArrow(_runner(vocabulary, min_bits), schema)


def redacted(docs: DataFrame, vocabulary: str | None = None, min_bits: float = MIN_BITS, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs``; every span (overlapping ones as one) in ``text`` is ``mark``."""
    path = vocabulary

    def clean(text: str, words) -> str:
        out, at = [], 0
        for s, _, e in sorted(base_spans(text) + guess_spans(text, words, min_bits)):
            if s >= at:
                out += [text[at:s], mark]
            at = max(at, e)
        return "".join([*out, text[at:]])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        words = ranks(path or vocabulary_path())
        for batch in batches:
            at = batch.schema.get_field_index("text")
            new = pa.array([None if (t := x.as_py()) is None else clean(t, words) for x in batch.column(at)], pa.string())
            yield batch.set_column(at, "text", new)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
