"""Document fingerprints: improbable features in chained Bloom filters.

Every window of ``WINDOW`` bytes has a score, its Shannon entropy in thousandths of the largest. How often each score
occurs in all windows of all documents gives its rank: the rarer, the better. In each run of ``POPULAR`` neighbouring
windows the best one (the first of equals) gets a vote; windows with ``VOTES`` votes are the text's features, in their order. A
feature is hashed to ``BITS`` places of a filter of ``FILTER_BYTES`` bytes; a filter takes ``MOST`` features, then
the next one of the chain begins. Windows that hardly vary (score below ``LEAST``) are never features.

Entropies come from counts: for each byte, how often it occurs in the window that it opens and in the one that it closes. The
sums of c log2 c are kept as whole numbers, so a window's score doesn't depend on what is scanned with it.

Two fingerprints are compared by their filters: the bits that two filters share, less what chance gives, in
proportion to the most they could share; a filter of the shorter chain counts with its best partner, and the mean over them is the
likeness.

Each document also gets an edited text, whose end is taken from the next document in descending order of ids. Neighbours
are brought together with one shuffle of the texts: ids alone are range partitioned, which gives the first id of each block; a row goes to
its block, and the first of a block also to the block before, as the successor of its last row. A task reads its
blocks in order and keeps one row.

Defined cases: a null text is an empty one; an empty text has no filter, its fingerprint is ``0:``, and it is like another empty one
only; a text shorter than a window is one feature; a text without a window that gets enough votes has its best window as
its only feature; equal fingerprints have likeness 1; rows with equal ids follow each other by text and stay in one
block, rows without an id come last; the only row follows itself; very long texts are scanned in pieces of bounded
size; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import bytescan, store

WINDOW, POPULAR, VOTES = 32, 32, 8
SCORES, LEAST = 1001, 100
FILTER_BYTES, BITS, MOST = 256, 5, 160
#: Of the range between chance and all, this part still counts as chance.
CUT = 0.3
#: Bytes of a text scanned at once; longer texts overlap by what a window's votes depend on.
PIECE = 1 << 20
MOST_BLOCKS = 4096
#: Bytes of texts that a task decodes and compares at once.
SLICE_BYTES = 4 << 20
NEVER = 1 << 62
_SCALE = 1 << 16
#: c log2 c, scaled to whole numbers.
_GAIN = np.array([0] + [round(c * np.log2(c) * _SCALE) for c in range(1, WINDOW + 1)], np.int64)
_STEP_GAIN = np.diff(_GAIN, prepend=0)
_FULL = WINDOW * int(np.log2(WINDOW)) * _SCALE
_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _counts(body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each byte occurs in the window that it opens, and in the window that it closes."""
    opens, closes = np.ones(len(body), np.uint8), np.ones(len(body), np.uint8)
    step = 1 << 16
    for lo in range(0, len(body), step):  # parts that stay in the processor's cache
        hi = min(len(body), lo + step)
        for d in range(1, WINDOW):
            same = (body[lo : min(hi, len(body) - d)] == body[lo + d : hi + d]).view(np.uint8)
            opens[lo : lo + len(same)] += same
            closes[lo + d : lo + d + len(same)] += same
    return opens, closes


def scores(body: np.ndarray) -> np.ndarray:
    """The entropy score of each window of ``body`` (one or many texts put together)."""
    n = len(body) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    opens, closes = _counts(body)
    sums = np.empty(n, np.int64)
    sums[0] = _GAIN[np.bincount(body[:WINDOW], minlength=256)].sum()
    np.cumsum(_STEP_GAIN[closes[WINDOW:]] - _STEP_GAIN[opens[: n - 1]], out=sums[1:])
    sums[1:] += sums[0]
    return (_FULL - sums) * (SCORES - 1) // _FULL


def _starts(at: np.ndarray) -> np.ndarray:
    """Which windows of texts put together lie within one text, as a mask over all windows."""
    fits = np.zeros(max(0, int(at[-1]) - WINDOW + 1), bool)
    for s, e in zip(at[:-1], at[1:]):
        fits[s : max(s, e - WINDOW + 1)] = True
    return fits


def _pieces(body: np.ndarray, at: np.ndarray, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of texts, and overlapping pieces of a text that is longer than a run."""
    for i, k in bytescan.runs(at, PIECE):
        if at[k] - at[i] <= PIECE:
            yield body[at[i] : at[k]], at[i : k + 1] - at[i]
        else:
            for lo in range(int(at[i]), int(at[k]), PIECE):
                own = body[lo : min(int(at[k]), lo + PIECE + overlap)]
                yield own, np.array([0, len(own)], np.int64)


def _score_counts(batches: Iterator) -> Iterator:
    import pyarrow as pa

    total = np.zeros(SCORES, np.int64)
    for batch in batches:
        body, at = bytescan.buffers(batch.column("text"))
        for own, ends in _pieces(body, at, WINDOW - 1):
            total += np.bincount(scores(own)[_starts(ends)], minlength=SCORES)
    yield pa.record_batch([pa.array(np.arange(SCORES)), pa.array(total)], names=["score", "n"])


def ranks(docs: DataFrame) -> np.ndarray:
    """The rank of each score, 0 the rarest in all windows of all documents (of equal counts the lower score first)."""
    seen = store.spread(docs.select("text")).mapInArrow(_score_counts, "score long, n long")
    counts = np.zeros(SCORES, np.int64)
    for score, n in seen.groupBy("score").agg(F.sum("n")).collect():  # one row a score, SCORES at most
        counts[score] = n
    out = np.empty(SCORES, np.int64)
    out[np.argsort(counts, kind="stable")] = np.arange(SCORES)
    return out


def _best_of_runs(keys: np.ndarray) -> np.ndarray:
    """The least key in each run of POPULAR neighbours."""
    width = 1
    while width < POPULAR:
        step = min(width, POPULAR - width)
        keys = np.minimum(keys[: len(keys) - step], keys[step:])
        width += step
    return keys


def _keys(body: np.ndarray, at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each window its rank and place as one number; NEVER where it can't be a feature."""
    found = scores(body)
    keys = (rank[found] << 32) | np.arange(len(found))
    keys[(found < LEAST) | ~_starts(at)] = NEVER
    return keys


def _voted(keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places of the windows with enough votes from the full runs of their text."""
    inside = np.zeros(max(0, len(keys) - POPULAR + 1), bool)
    for s, e in zip(at[:-1], at[1:]):
        inside[s : max(s, e - WINDOW - POPULAR + 2)] = True
    if not inside.any():
        return np.zeros(0, np.int64)
    best = _best_of_runs(keys)[inside]
    return np.flatnonzero(np.bincount(best[best < NEVER] & 0xFFFFFFFF) >= VOTES)


def _features(body: np.ndarray, at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, text) of the features of texts put together that are each at least a window long."""
    keys = _keys(body, at, rank)
    where = _voted(keys, at)
    which = np.searchsorted(at, where, "right") - 1
    for k in np.flatnonzero(np.bincount(which, minlength=len(at) - 1) == 0):
        best = keys[at[k] : at[k + 1] - WINDOW + 1].min()
        where, which = np.append(where, at[k] if best == NEVER else best & 0xFFFFFFFF), np.append(which, k)
    order = np.argsort(where, kind="stable")
    return where[order], which[order]


def _mixed(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of 64-bit words."""
    h = np.full(len(words), 0x243F6A8885A308D3, np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    h *= np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(29))


def _hashes(body: np.ndarray, places: np.ndarray) -> np.ndarray:
    return _mixed(np.lib.stride_tricks.sliding_window_view(body, WINDOW)[places].copy().view("<u8"))


def _short_hash(text: bytes) -> int:
    """The hash of a text shorter than a window, which is its only feature."""
    return int.from_bytes(hashlib.sha256(text).digest()[:8], "little")


def _long_features(body: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Hashes of the features of one text, scanned in pieces: a vote depends on less than WINDOW + 2 POPULAR bytes around."""
    margin = WINDOW + 2 * POPULAR
    out, best = [], (NEVER, 0)
    for lo in range(0, len(body) - WINDOW + 1, PIECE):
        s, e = max(0, lo - margin), min(len(body), lo + PIECE + margin)
        ends = np.array([0, e - s], np.int64)
        keys = _keys(body[s:e], ends, rank)
        places = _voted(keys, ends) + s
        out.append(_hashes(body, places[(places >= lo) & (places < lo + PIECE)]))
        top = int(keys.min())
        best = min(best, (top >> 32, s + (top & 0xFFFFFFFF))) if top != NEVER else best
    out = np.concatenate(out)
    return out if len(out) else _hashes(body, np.array([best[1]]))


def _chained(hashes: np.ndarray) -> bytes:
    """The chain of filters over the distinct hashes of one text, in their order."""
    first = np.unique(hashes, return_index=True)[1]
    own = hashes[np.sort(first)]
    width = (FILTER_BYTES * 8 - 1).bit_length()
    bits = np.zeros((-(-len(own) // MOST), FILTER_BYTES * 8), bool)
    link = np.arange(len(own)) // MOST
    for k in range(BITS):
        bits[link, (own >> np.uint64(k * width)).astype(np.int64) % (FILTER_BYTES * 8)] = True
    return np.packbits(bits, axis=1).tobytes()


def digests(texts: list[bytes], rank: np.ndarray) -> list[bytes]:
    """The chain of filters of each text."""
    out: list[bytes] = [b""] * len(texts)
    usual = []
    for k, t in enumerate(texts):
        if 0 < len(t) < WINDOW:
            out[k] = _chained(np.array([_short_hash(t)], np.uint64))
        elif len(t) > PIECE:
            out[k] = _chained(_long_features(np.frombuffer(t, np.uint8), rank))
        elif t:
            usual.append(k)
    body, at = bytescan.packed([texts[k] for k in usual])
    for i, j in bytescan.runs(at, PIECE):
        own = body[at[i] : at[j]]
        places, which = _features(own, at[i : j + 1] - at[i], rank)
        ends = np.searchsorted(which, np.arange(j - i + 1))
        hashed = _hashes(own, places)
        for k in range(j - i):
            out[usual[i + k]] = _chained(hashed[ends[k] : ends[k + 1]])
    return out


def likeness(one: bytes, two: bytes) -> float:
    """0 to 1: the mean, over the filters of the shorter chain, of the best normalised overlap with the other's."""
    if one == two:
        return 1.0
    if not one or not two:
        return 0.0
    if len(one) > len(two):
        one, two = two, one
    a, b = (np.frombuffer(x, np.uint64).reshape(-1, FILTER_BYTES // 8) for x in (one, two))
    size = np.bitwise_count(b).sum(1, dtype=np.int64)
    total = 0.0
    for row in a:
        own = int(np.bitwise_count(row).sum(dtype=np.int64))
        shared = np.bitwise_count(row & b).sum(1, dtype=np.int64)
        most = np.minimum(own, size)
        chance = own * size / (FILTER_BYTES * 8)
        least = chance + CUT * (most - chance)
        total += float(np.max(np.where(most > least, (shared - least) / np.maximum(most - least, 1e-9), 0.0)).clip(0.0, 1.0))
    return total / len(a)


def coded(digest: bytes) -> str:
    return f"{len(digest) // FILTER_BYTES}:{base64.b64encode(digest).decode()}"


def fingerprinted(docs: DataFrame, rank: np.ndarray | None = None) -> DataFrame:
    """(doc_id, fingerprint) of every row, in one scan after that of ``ranks``."""
    rank = ranks(docs) if rank is None else rank

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(map(coded, digests(texts, rank)), pa.string())], names=["doc_id", "fingerprint"])

    return store.spread(docs.select("doc_id", "text")).mapInArrow(run, "doc_id long, fingerprint string")


def _blocked(docs: DataFrame) -> DataFrame:
    """(block, ahead, doc_id, text): rows in their block; ``ahead`` rows are the first of the block that follows."""
    spark = docs.sparkSession
    n = max(1, min(MOST_BLOCKS, 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ids = docs.select("doc_id").where("doc_id is not null")
    parts = ids.repartitionByRange(n, F.desc("doc_id")).groupBy(F.spark_partition_id().alias("p")).agg(F.max("doc_id").alias("first"))
    firsts = [r["first"] for r in parts.orderBy(F.desc("first")).select("first").collect()]  # MOST_BLOCKS rows at most
    last = max(0, len(firsts) - 1)
    steps = [1 << k for k in range(len(firsts).bit_length() - 1, -1, -1)]
    table = F.split(F.lit(" ".join(map(str, firsts))), " ").cast("array<long>")

    # the last block whose first id is not below the row's: binary search in steps of powers of two
    def nearer(at, step):
        return F.when(F.get(table, at + step) >= F.col("doc_id"), at + step).otherwise(at)

    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), nearer) if last else F.lit(0)
    block = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(found)
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), block.cast("int").alias("own"))
    opens = F.get(table, F.col("own")) == F.col("doc_id") if firsts else F.lit(True)
    own = F.struct(F.col("own").alias("block"), F.lit(False).alias("ahead"))
    before = F.struct(((F.col("own") + last) % (last + 1)).alias("block"), F.lit(True).alias("ahead"))
    to = F.when(F.coalesce(opens, F.lit(False)), F.array(own, before)).otherwise(F.array(own))
    return d.select("doc_id", "text", F.inline(to))


def _compared(rank: np.ndarray):
    def results(rows: list[tuple]) -> list[tuple]:
        """``rows``: (block, ahead, doc_id, text, digest) in order; a result for each that is followed in its block."""
        pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[1]]
        edited = []
        for a, b in pairs:
            cut = len(a[3]) // 3
            edited.append((a[3][: len(a[3]) - cut] + b[3][:cut]).encode())
        marks = digests(edited, rank)
        return [(a[2], len(a[3]), hashlib.sha256(e).hexdigest(), coded(a[4]), coded(m), likeness(a[4], m), likeness(a[4], b[4]))
                for (a, b), e, m in zip(pairs, edited, marks)]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = [f.split()[0] for f in _OUT.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        held = None
        for batch in batches:
            at = bytescan.buffers(batch.column("text"))[1]
            for i, k in bytescan.runs(at, SLICE_BYTES):
                cols = [batch.column(c).slice(i, k - i).to_pylist() for c in ("block", "ahead", "doc_id", "text")]
                rows = list(zip(*cols, digests([t.encode() for t in cols[3]], rank)))
                if held is not None:
                    rows.insert(0, held)
                out = list(zip(*results(rows))) or [()] * len(names)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds)], names=names)
                held = rows[-1]

    return run


def compared(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``: fingerprints of its text and its edited text, and their likeness to it and to the next row."""
    rank = ranks(docs)
    dealt = _blocked(docs).repartition("block").sortWithinPartitions("block", "ahead", F.desc_nulls_last("doc_id"), "text")
    return dealt.mapInArrow(_compared(rank), _OUT)
