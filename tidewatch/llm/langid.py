"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary; each language has a probability for each piece.
A word's probability in a language is the sum over all its segmentations into pieces, by the forward
algorithm; pieces never cross white space, so a text's logarithm is the sum over its words.

Piece probabilities are fitted by expectation maximisation (forward and backward sums) on word
counts of at most ``FIT_DOCS`` documents a language, chosen by a hash of their id: that is the bound
on the labelled sample, every other document is only scored. Each fitting step runs on the
executors and returns a row per (language, piece), a table bounded by the vocabulary.

Words are scored many at a time: for all words of one length, pieces are found by hashes of
all substrings, and the forward sums run over the whole block. A worker keeps the scores of
words it has seen, and starts afresh beyond ``KEPT_WORDS``.

Words of any length count, in fitting and in scoring (scripts without spaces write sentences as one word).
Beyond ``STRETCH`` characters the forward sums run on stretch by stretch, which is exact; for fitting such
a word is cut into stretches, so only segmentations across a cut are not summed there.

Defined cases: a null text, one without letters, or nothing to learn from gives ``und`` with score 0;
a document with a null id or language teaches nothing; all other rows are scored, repeated ones alike, very
long texts and words whole; of languages with equal sums the first in alphabetical order wins; an empty table gives
an empty result; more than ``MOST_LANGUAGES`` learned languages are refused with an error, as the
probabilities are one table of the vocabulary's size per language; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import store, wordhash

VOCABULARY = "piece_bpe_32k.model"
FIT_DOCS, ROUNDS = 1500, 3
KEPT_WORDS = 500_000
LONGEST = 16
STRETCH = 4096
#: Places times languages that the forward sums hold at once, in each of their LONGEST + 1 tables.
HELD = 1 << 20
MOST_LANGUAGES = 500
FLOOR = 1e-9
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The pieces of a vocabulary file by the hash of their code points."""

    def __init__(self, path: str | None):
        from sentencepiece import SentencePieceProcessor

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        sp = SentencePieceProcessor(model_file=path)
        texts = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.texts = sorted({t for t in texts if len(t) <= LONGEST})
        h = np.array([self.hash_of(t) for t in self.texts], np.uint64)
        self.order = np.argsort(h)
        self.sorted = h[self.order]
        self.size = len(self.texts)

    @staticmethod
    def hash_of(text: str) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in text:
            h = h * _BASE + np.uint64(ord(c) + 1)
        return wordhash.mix(h)[0]

    def find(self, points: np.ndarray) -> list[np.ndarray]:
        """For lengths 1 to LONGEST: the piece at each (word, start) of a block, or size if none.

        One character that is no piece is the piece ``size + 1``, with a fixed small probability.
        """
        out, h = [], np.zeros(points.shape, np.uint64)
        for k in range(min(LONGEST, points.shape[1])):
            h = h[:, : points.shape[1] - k] * _BASE + points[:, k:]
            key = wordhash.mix(h)
            at = np.minimum(np.searchsorted(self.sorted, key), self.size - 1)
            out.append(np.where(self.sorted[at] == key, self.order[at], self.size + (k == 0)))
        return out


@lru_cache(maxsize=1)
def pieces_of(path: str | None) -> Pieces:
    """The vocabulary, loaded once a worker process."""
    return Pieces(path)


def _blocks(words: list[str], most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, code points + 1) of words of equal length, with the word mark before each."""
    length = np.array([len(w) for w in words]) + 1
    order = np.argsort(length, kind="stable")
    cuts = np.flatnonzero(np.diff(length[order])) + 1
    for part in np.split(order, cuts):
        n = int(length[part[0]])
        for i in range(0, len(part), max(1, most // n)):
            some = part[i : i + max(1, most // n)]
            text = "".join("▁" + words[k] for k in some)
            yield some, np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(some), n).astype(np.uint64) + np.uint64(1)


def _forward(found: list[np.ndarray], table: np.ndarray, n: int) -> np.ndarray:
    """Log-probabilities (words, columns of ``table``)."""
    words = found[0].shape[0]
    alpha = np.zeros((n + 1, words, table.shape[1]))
    alpha[0] = 1.0
    logs = np.zeros((words, table.shape[1]))
    steps = [table[f.T] for f in found]
    for e in range(1, n + 1):
        for k in range(min(len(found), e)):
            alpha[e] += alpha[e - k - 1] * steps[k][e - k - 1]
        if e % LONGEST == 0:
            top = np.maximum(alpha[e], 1e-290)
            alpha[max(0, e - LONGEST + 1) : e + 1] /= top
            logs += np.log(top)
    return np.log(np.maximum(alpha[n], 1e-300)) + logs


def _long_score(pieces: Pieces, table: np.ndarray, word: str) -> np.ndarray:
    """Log-probabilities of one word, in stretches that hand on the sums of their last characters."""
    points = np.frombuffer(("▁" + word).encode("utf-32-le"), np.uint32).astype(np.uint64)[None, :] + np.uint64(1)
    n = points.shape[1]
    past = np.zeros((LONGEST, table.shape[1]))  # sums at the last LONGEST places; the last one is the place reached
    past[-1] = 1.0
    log = np.zeros(table.shape[1])
    stretch = max(LONGEST, min(STRETCH, HELD // max(1, table.shape[1])))
    for start in range(0, n, stretch):
        end, back = min(start + stretch, n), min(start, LONGEST - 1)
        found = pieces.find(points[:, start - back : end])
        alpha = np.concatenate([past, np.zeros((end - start, table.shape[1]))])
        steps = [table[f[0]] for f in found]
        for e in range(1, end - start + 1):
            for k in range(min(len(found), start + e)):
                alpha[LONGEST - 1 + e] += alpha[LONGEST - 2 + e - k] * steps[k][back + e - k - 1]
            if e % LONGEST == 0 or e == end - start:
                top = np.maximum(alpha[LONGEST - 1 + e], 1e-290)
                alpha[e : LONGEST + e] /= top
                log += np.log(top)
        past = alpha[-LONGEST:]
    return np.log(np.maximum(past[-1], 1e-300)) + log


def word_scores(pieces: Pieces, table: np.ndarray, words: list[str]) -> np.ndarray:
    out = np.zeros((len(words), table.shape[1]))
    short = [k for k, w in enumerate(words) if len(w) < STRETCH]
    # fewer words at once where there are more languages: memory is bounded by HELD, not by their number
    for some, points in _blocks([words[k] for k in short], HELD // max(4, table.shape[1])) if short else ():
        out[np.array(short)[some]] = _forward(pieces.find(points), table, points.shape[1])
    if len(short) < len(words):
        for k, w in enumerate(words):
            if len(w) >= STRETCH:
                out[k] = _long_score(pieces, table, w)
    return out


def expected(pieces: Pieces, column: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in counted words under the probabilities ``column``."""
    total = np.zeros(len(column))
    for some, points in _blocks(words, 1 << 15):
        n, found = points.shape[1], pieces.find(points)
        steps = [column[f] for f in found]
        fwd, bwd, scale = np.zeros((n + 1, len(some))), np.zeros((n + 1, len(some))), np.ones((n + 1, len(some)))
        # all sums up to a place are divided by that place's scale, so they stay near one at any length
        fwd[0] = bwd[n] = 1.0
        for e in range(1, n + 1):
            reach = np.ones(len(some))
            for k in range(min(len(found), e)):
                if k:
                    reach = reach / scale[e - k]
                fwd[e] += fwd[e - k - 1] * steps[k][:, e - k - 1] * reach
            scale[e] = np.maximum(fwd[e], 1e-290)
            fwd[e] /= scale[e]
        for s in range(n - 1, -1, -1):
            reach = np.ones(len(some))
            for k in range(min(len(found), n - s)):
                reach = reach / scale[s + k + 1]
                step = steps[k][:, s] * reach
                total += np.bincount(found[k][:, s], fwd[s] * step * bwd[s + k + 1] * counts[some], len(column))
                bwd[s] += bwd[s + k + 1] * step
    return total


def _word_counts(batches: Iterator) -> Iterator:
    import pyarrow as pa
    from collections import Counter

    for batch in batches:
        count: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for raw in (text or "").encode().split():
                w = raw.decode("utf-8").lower()
                count.update((lang, w[i : i + STRETCH]) for i in range(0, len(w), STRETCH))
        yield pa.record_batch([pa.array([k[0] for k in count], pa.string()), pa.array([k[1] for k in count], pa.string()),
                               pa.array(list(count.values()), pa.int64())], names=["lang", "word", "n"])


def fit(docs: DataFrame, vocabulary: str | None = None, per_language: int = FIT_DOCS, rounds: int = ROUNDS):
    """(languages, probabilities by piece and language) from ``docs`` (doc_id, text, lang)."""
    docs = docs.where("doc_id is not null and lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    langs = sorted(sizes)
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"{len(langs)} languages to learn, at most {MOST_LANGUAGES}")
    pieces = pieces_of(vocabulary)
    size = pieces.size + 2
    table = np.zeros((size, len(langs)))
    if not langs:
        return langs, table
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, per_language / sizes[k])))])
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)
    words = store.saved(
        store.spread(chosen.select("lang", "text")).mapInArrow(_word_counts, "lang string, word string, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "language-words",
    )
    words = store.spread(words)
    column = {k: np.full(size, 1.0 / size) for k in langs}
    for _ in range(rounds):
        now = {k: _closed(v) for k, v in column.items()}

        def step(batches: Iterator) -> Iterator:
            import pyarrow as pa

            own = pieces_of(vocabulary)
            sums = {k: np.zeros(size) for k in langs}
            for batch in batches:
                lang = np.array(batch.column(0).to_pylist(), object)
                word, n = batch.column(1).to_pylist(), batch.column(2).to_numpy().astype(float)
                for k in set(lang.tolist()):
                    at = np.flatnonzero(lang == k)
                    sums[k] += expected(own, now[k], [word[i] for i in at], n[at])
            for k, v in sums.items():
                some = np.flatnonzero(v[: size - 2])
                yield pa.record_batch([pa.array([k] * len(some), pa.string()), pa.array(some, pa.int64()), pa.array(v[some])],
                                      names=["lang", "piece", "n"])

        got = words.mapInArrow(step, "lang string, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        for k in langs:
            part = got[got["lang"] == k]
            v = np.zeros(size)
            v[part["piece"].to_numpy(np.int64)] = part["n"].to_numpy()
            column[k] = v / max(v.sum(), 1e-300)
    mean = sum(column.values()) / len(langs)
    for i, k in enumerate(langs):
        table[:, i] = _closed(0.98 * column[k] + 0.02 * mean)
    return langs, table


def _closed(v: np.ndarray) -> np.ndarray:
    """Probabilities with a floor for every piece and for unknown characters; nothing for 'no piece'."""
    out = (v + FLOOR) / (v.sum() + FLOOR * len(v))
    out[-2], out[-1] = 0.0, FLOOR
    return out


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _scorer(vocabulary: str | None, langs: list[str], model):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = model.value
        pieces = pieces_of(vocabulary) if langs else None
        at: dict[int, int] = {}
        scores = np.zeros((1 << 14, len(langs)))
        ascii_letter = np.zeros(256, bool)
        ascii_letter[65:91] = ascii_letter[97:123] = True
        for batch in batches:
            data, offs = wordhash.string_buffers(batch.column(1))
            for i, j in wordhash.chunks(offs):
                part, local = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                pred, score = np.full(j - i, "und", object), np.zeros(j - i)
                h, first, starts, ends = wordhash.words(part, local)
                if langs and len(h):
                    keys, place, which = np.unique(h, return_index=True, return_inverse=True)
                    if len(at) + len(keys) > KEPT_WORDS:
                        at.clear()
                    listed = keys.tolist()
                    new = [k for k, key in enumerate(listed) if key not in at]
                    if new:
                        raw = part.tobytes()
                        got = word_scores(pieces, table, [raw[starts[place[k]] : ends[place[k]]].decode("utf-8", "replace").lower() for k in new])
                        base = len(at)
                        while base + len(new) > len(scores):
                            scores = np.concatenate([scores, np.zeros_like(scores)])
                        scores[base : base + len(new)] = got
                        at.update((listed[k], base + m) for m, k in enumerate(new))
                    rows = scores[np.array([at[key] for key in listed])[which]]
                    letters = np.zeros(len(part) + 1, np.int64)
                    np.cumsum(ascii_letter[part], out=letters[1:])
                    plain = letters[local[1:]] > letters[local[:-1]]
                    sums = np.zeros((len(h) + 1, len(langs)))
                    np.cumsum(rows, axis=0, out=sums[1:])
                    text_scores = sums[first[1:]] - sums[first[:-1]]
                    for k in np.flatnonzero(np.diff(first)):
                        if plain[k] or _has_letter(part[local[k] : local[k + 1]].tobytes().decode("utf-8", "replace")):
                            # summed again where the difference of long sums would be coarse
                            s = text_scores[k] if first[k + 1] - first[k] > 50 else rows[first[k] : first[k + 1]].sum(axis=0)
                            best = int(np.argmax(s))
                            pred[k], score[k] = langs[best], 1.0 / np.exp(np.maximum(s - s[best], -700)).sum()
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(pred, pa.string()), pa.array(score)],
                                      names=["doc_id", "lang_pred", "score"])

    return run


def predicted(docs: DataFrame, langs: list[str], table: np.ndarray, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs`` (doc_id, text)."""
    model = docs.sparkSession.sparkContext.broadcast(table)
    return store.spread(docs.select("doc_id", "text")).mapInArrow(_scorer(vocabulary, langs, model), "doc_id long, lang_pred string, score double")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identified(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Fit on the rows of ``docs`` that aren't held out, predict all: doc_id, held_out, lang_pred, score."""
    langs, table = fit(docs.where(~held_out()).select("doc_id", "text", "lang"), vocabulary)
    return predicted(docs, langs, table, vocabulary).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
