"""Cross-entropy difference between a target and a background bigram model over words.

Both models share one vocabulary, at most ``VOCABULARY`` words (A-Z in lower case, marks cut off) as frequent in all
documents as the least count that leaves no more of them, and one symbol for all other words; both have the same
smoothing and are matched in size: counts of the larger part are scaled down to the smaller one's total. The
target part are the documents named by the caller, the background all others. A document never
counts for itself: what it adds to its own part is taken off again. With c the scaled counts, N their total, V the symbols and
h the word before (a mark at the start of a text),

    p(w)     = (c(w) + 1) / (N + V)
    p(w | h) = (c(h w) + MU * p(w)) / (c(h) + MU)

Losses are bits a word over a whole text; the score is the target loss minus the background loss: low is like the
target.

What is gathered grows with the input: the counts of all distinct bigrams of all documents.

1. Words are counted by their hashes; the vocabulary is the one table that goes to the driver, with the single words' counts.
2. Texts become symbols, two bytes a word, in chunks of about ``CHUNK_BYTES`` of text; a chunk is a row.
3. A chunk posts its distinct bigrams and their counts to buckets, in sorted order; a row carries many of them as
   packed columns. A bigram that every text holds is posted once a chunk, never once a text.
4. A bucket sums its bigrams and answers each posting with the totals, in the order of its keys.
5. Each chunk makes the same order again and scores its texts with the answers.

No step holds more than a chunk or a bucket, and buckets grow in number with the words of the corpus.

Defined cases: null, empty and blank texts have no words and null losses; a null id is never in the target; rows that repeat
are documents each; an empty part gives the uniform distribution; an empty table gives an empty result; words tied at
the vocabulary's end stay out together; a very long text is a chunk of its own; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm import store, wordhash

MU = 4.0
VOCABULARY = 65_534
START = 65_535
CHUNK_BYTES = 4 << 20
CHUNK_TEXTS = 100_000
BUCKET_WORDS = 1_000_000


def _packed(x: np.ndarray, kind: str = "<u4") -> bytes:
    """A column of whole numbers as bytes: all lowest bytes first, then the next, compressed."""
    x = np.ascontiguousarray(x, kind)
    return zlib.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes(), 1)


def _unpacked(data: bytes, kind: str = "<u4") -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, -1).T).view(kind).ravel()


def _merged(parts: list):
    """(key, sums) of parts (key, counts) with equal keys added up."""
    u, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return u, *(np.bincount(which, np.concatenate([p[c] for p in parts]), len(u)).astype(np.int64) for c in range(1, len(parts[0])))


def _word_counter(batches: Iterator) -> Iterator:
    import pyarrow as pa

    held: list = []
    for batch in batches:
        data, offs = wordhash.string_buffers(batch.column(0))
        for i, j in wordhash.chunks(offs):
            h = wordhash.words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], stops=True)[0]
            held.append(np.unique(h, return_counts=True))
        if sum(len(p[0]) for p in held) > 2_000_000:
            held = [_merged(held)]
            if len(held[0][0]) > 1_000_000:
                yield pa.record_batch([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], names=["word", "n"])
                held = []
    if held:
        u, n = _merged(held)
        yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(n)], names=["word", "n"])


def _vocabulary(texts: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of at most ``size`` words, all that are as frequent as the least of them.

    If more words than that tie at the top count, those with the least hashes are taken.
    """
    words = store.saved(texts.select("text").mapInArrow(_word_counter, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    # a row per distinct count: a few thousand for any corpus
    sizes = words.groupBy("n").count().withColumn("upto", F.sum("count").over(Window.orderBy(F.desc("n"))))
    least = sizes.where(F.col("upto") <= size).agg(F.min("n")).first()[0]
    if least is None:
        first = words.orderBy(F.desc("n"), "word").limit(size)
        return np.sort(first.select("word").toPandas()["word"].to_numpy(np.int64).view(np.uint64))
    return np.sort(words.where(F.col("n") >= least).select("word").toPandas()["word"].to_numpy(np.int64).view(np.uint64))


def _encoder(shared, chunk_bytes: int):
    """Texts as symbols: a row per chunk with the ids, sides and lengths of its texts."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        vocabulary = shared.value
        ids, sides, lengths, symbols, size = [], [], [], [], 0

        def row():
            return pa.record_batch([
                pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())),
                pa.array([np.concatenate(sides)], pa.list_(pa.bool_())), pa.array([np.concatenate(lengths)], pa.list_(pa.int32())),
                pa.array([_packed(np.concatenate(symbols), "<u2")], pa.binary()),
            ], names=["ids", "target", "lengths", "symbols"])

        for batch in batches:
            data, offs = wordhash.string_buffers(batch.column(1))
            target = np.array(batch.column(2).to_pylist(), bool)
            for i, j in wordhash.chunks(offs):
                h, first, _, _ = wordhash.words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], stops=True)
                out = np.zeros(len(h), "<u2")
                if len(vocabulary):
                    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                    out = np.where(vocabulary[at] == h, at + 1, 0).astype("<u2")
                ids.append(batch.column(0).slice(i, j - i))
                sides.append(target[i:j])
                lengths.append(np.diff(first).astype(np.int32))
                symbols.append(out)
                size += int(offs[j] - offs[i])
                if size >= chunk_bytes or sum(map(len, ids)) >= CHUNK_TEXTS:
                    yield row()
                    ids, sides, lengths, symbols, size = [], [], [], [], 0
        if ids:
            yield row()

    return run


def _read(batch, r: int):
    """(lengths, targets, text of each word, word, history) of the chunk in row ``r``."""
    lengths, target = np.array(batch.column("lengths")[r].as_py(), np.int64), np.array(batch.column("target")[r].as_py(), bool)
    w = _unpacked(batch.column("symbols")[r].as_py(), "<u2").astype(np.uint32)
    text = np.repeat(np.arange(len(lengths)), lengths)
    h = np.roll(w, 1)
    h[(np.cumsum(lengths) - lengths)[lengths > 0]] = START
    return lengths, target, text, w, h


def _bigrams(w: np.ndarray, h: np.ndarray, buckets: int):
    """The distinct bigrams by bucket and key, where each bucket starts and its number, and the place of each word's bigram."""
    u, which = np.unique((h << np.uint32(16)) | w, return_inverse=True)
    bucket = (wordhash.mix(u.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    place = np.empty(len(u), np.int64)
    place[order] = np.arange(len(u))
    return u[order], np.r_[first, len(u)], names, place[which]


def _single_counts(batches: Iterator) -> Iterator:
    """How often each symbol is a word and a history in both parts."""
    import pyarrow as pa

    sums = np.zeros((4, START + 1), np.int64)
    for batch in batches:
        for r in range(batch.num_rows):
            _, target, text, w, h = _read(batch, r)
            side = target[text]
            for k, x in enumerate((w[side], w[~side], h[side], h[~side])):
                sums[k] += np.bincount(x, minlength=START + 1)
    some = np.flatnonzero(sums.any(axis=0))
    yield pa.record_batch([pa.array(some), *(pa.array(x[some]) for x in sums)], names=["symbol", "wt", "wb", "ht", "hb"])


def _poster(buckets: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for r in range(batch.num_rows):
                _, target, text, w, h = _read(batch, r)
                if not len(w):
                    continue
                u, first, names, place = _bigrams(w, h, buckets)
                side = target[text]
                t, b = np.bincount(place[side], minlength=len(u)), np.bincount(place[~side], minlength=len(u))
                spans = list(zip(first[:-1], first[1:]))
                yield pa.record_batch([
                    pa.array(names), pa.array(np.full(len(names), batch.column("part")[r].as_py())),
                    pa.array([_packed(np.diff(u[i:j], prepend=np.uint32(0))) for i, j in spans], pa.binary()),
                    *(pa.array([_packed(x[i:j]) for i, j in spans], pa.binary()) for x in (t, b)),
                ], names=["bucket", "part", "keys", "t", "b"])

    return run


_ANSWER = "part long, bucket long, t binary, b binary"


def _totals(key, table):
    """Each posting of a bucket with the totals of its bigrams, in the posting's order."""
    import pyarrow as pa

    keys, t, b = ([_unpacked(x.as_py()) for x in table.column(c)] for c in ("keys", "t", "b"))
    ends = np.cumsum([len(k) for k in keys])[:-1]
    u, which = np.unique(np.concatenate([np.cumsum(k, dtype=np.uint32) for k in keys]), return_inverse=True)
    sums = [np.bincount(which, np.concatenate(x), len(u)).astype(np.int64) for x in (t, b)]
    # sums beyond 32 bits would need a corpus of a third of 10**10 words of one pair: they travel as 64 bits
    out = (pa.array([_packed(x, "<i8") for x in np.split(s[which], ends)], pa.binary()) for s in sums)
    return pa.table([table.column("part"), table.column("bucket"), *out], names=["part", "bucket", "t", "b"])


def _own(text: np.ndarray, key: np.ndarray, bits: int) -> np.ndarray:
    """For each word: how often its key occurs in its own text."""
    _, which, n = np.unique((text.astype(np.uint64) << np.uint64(bits)) | key.astype(np.uint64), return_inverse=True, return_counts=True)
    return n[which]


_SCHEMA = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def _scorer(shared):
    def run(key, own, answers):
        import pyarrow as pa

        single, totals, size, buckets = shared.value
        order = np.argsort(answers.column("bucket").to_numpy())
        lengths, target, text, w, h = _read(own, 0)
        place = _bigrams(w, h, buckets)[3] if len(w) else np.zeros(0, np.int64)
        mine = {"w": _own(text, w, 16), "h": _own(text, h, 16), "p": _own(text, place, 32)}
        mean = np.full((len(lengths), 2), np.nan)
        some = np.flatnonzero(lengths)
        least = max(1, min(totals))
        for side, flag, column in ((0, target, "t"), (1, ~target, "b")):
            scale = least / max(totals[side], 1)
            pairs = np.concatenate([np.zeros(0, np.int64), *(_unpacked(answers.column(column)[int(k)].as_py(), "<i8") for k in order)])[place]
            leave = flag[text]
            c = {k: scale * (v - np.where(leave, mine[k], 0)) for k, v in (("w", single[side][w]), ("h", single[2 + side][h]), ("p", pairs))}
            n = scale * (totals[side] - np.where(flag, lengths, 0))[text]
            p = (c["p"] + MU * (c["w"] + 1) / (n + size)) / (c["h"] + MU)
            if len(some):
                mean[some, side] = np.add.reduceat(-np.log2(p), (np.cumsum(lengths) - lengths)[some]) / lengths[some]
        cols = [pa.array(v, pa.float64(), mask=np.isnan(v)) for v in (mean[:, 0], mean[:, 1], mean[:, 0] - mean[:, 1])]
        ids = own.column("ids").combine_chunks()[0].values
        return pa.table([ids, pa.array(lengths), *cols], names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return run


def scored(docs: DataFrame, target_ids: DataFrame, vocabulary: int = VOCABULARY, chunk_bytes: int = CHUNK_BYTES,
           bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) for every row of ``docs`` (doc_id, text).

    ``target_ids`` has the ids (doc_id) of the target part.
    """
    if vocabulary > VOCABULARY:
        raise ValueError(f"at most {VOCABULARY} words, a symbol has two bytes")
    context = docs.sparkSession.sparkContext
    texts = store.spread(docs.select("doc_id", "text"))
    ids = target_ids.select("doc_id").where("doc_id is not null").distinct().withColumn("target", F.lit(True))
    flagged = texts.join(store.hinted(ids), "doc_id", "left").select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    known = _vocabulary(texts, vocabulary)
    chunks = store.saved(
        flagged.mapInArrow(_encoder(context.broadcast(known), chunk_bytes), "ids array<long>, target array<boolean>, lengths array<int>, symbols binary")
        .withColumn("part", F.monotonically_increasing_id()),
        "symbols",
    )
    sums = np.zeros((4, START + 1), np.int64)
    for r in chunks.mapInArrow(_single_counts, "symbol long, wt long, wb long, ht long, hb long").groupBy("symbol").sum("wt", "wb", "ht", "hb").collect():
        sums[:, r[0]] = r[1:]
    totals = (int(sums[0].sum()), int(sums[1].sum()))
    buckets = max(1, -(-sum(totals) // bucket_words))
    model = context.broadcast((sums, totals, len(known) + 1, buckets))
    answers = (
        chunks.select("part", "target", "lengths", "symbols").mapInArrow(_poster(buckets), "bucket long, part long, keys binary, t binary, b binary")
        .groupBy("bucket").applyInArrow(_totals, _ANSWER)
    )
    return chunks.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_scorer(model), _SCHEMA)
