"""Filter interaction audit: what each of five filters removes, in every order of applying them.

Texts are scanned in Arrow buffers: a table gives each byte its classes, prefix sums of the classes give the words,
capitals, signs and code points of every text of a run at once. Words are hashed from prefix sums too; a
document's hashes are sorted, neighbours with equal hashes are compared byte by byte, and what differs counts as
another word (a document with such a clash is counted again from its words). Each text becomes a mask of the filters it
fails, and only masks go on: they are summed by part, and the orders are evaluated on one row of
32 sums a part.

A text is a copy if an equal text has a smaller ``doc_id`` anywhere in the table. Equality is that of SHA-256 digests;
digests held more than once are counted before the shuffle and joined back as a broadcast only within a counted
bound, else by an equi-join of two scanned tables, which the adaptive skew join can split.

Defined cases: a null text is an empty one (it fails A alone, and E if a smaller id is empty as well); a null or empty
language is the part ``''``; rows of one ``doc_id`` are separate documents, and none of them is a copy of the other; a row without an
id is never a copy and makes none; several labels of one id count as one that has what any of them has; labels that are null
count as 0; very long texts are scanned whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import bytescan, store

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
SIGNS = b"#$%&*|"
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
MASKS = 1 << len(FILTERS)
_SEEN = "doc_id long, part string, mask int, digest binary"


def _class_of(members) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_BLANK, _CAPITAL, _SIGN, _INNER = map(_class_of, (BLANKS, range(65, 91), SIGNS, range(0x80, 0xC0)))
_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_STEP, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set in each text, by prefix sums."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def _words(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; a word never crosses a text's end."""
    inside = np.zeros(len(body) + 2, bool)
    inside[1:-1] = ~_BLANK[body]
    cut = np.zeros(len(body) + 1, bool)
    cut[at] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return starts, ends


def _hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * _powers(_STEP, len(body)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _powers(_BACK, len(body) + 1)[starts]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _same_bytes(body, starts, ends, one, two) -> np.ndarray:
    """Whether the words ``one[k]`` and ``two[k]``, of equal lengths, are the same bytes."""
    size = ends[one] - starts[one]
    first = np.cumsum(size) - size
    step = np.arange(int(size.sum())) - np.repeat(first, size)
    differs = body[np.repeat(starts[one], size) + step] != body[np.repeat(starts[two], size) + step]
    return np.add.reduceat(differs, first) == 0 if len(size) else np.zeros(0, bool)


def distinct_words(body: np.ndarray, at: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Distinct words of each text: sorted hashes, each run of equal ones verified."""
    n = len(at) - 1
    text = np.searchsorted(at, starts, "right") - 1
    # the text in the upper bits, the hash in the lower ones: one sort for all texts of the run
    bits = max(1, n.bit_length())
    keys = (text.astype(np.uint64) << np.uint64(64 - bits)) | (hashes >> np.uint64(bits))
    order = np.argsort(keys)
    keys = keys[order]
    again = np.flatnonzero(keys[1:] == keys[:-1])
    one, two = order[again], order[again + 1]
    alike = ends[one] - starts[one] == ends[two] - starts[two]
    clash = set(text[one[~alike]].tolist())
    one, two = one[alike], two[alike]
    clash |= set(text[one[~_same_bytes(body, starts, ends, one, two)]].tolist())
    out = np.bincount(text, minlength=n) - np.bincount(text[order[again]], minlength=n)
    for k in clash:
        own = np.flatnonzero(text == k)
        out[k] = len({body[s:e].tobytes() for s, e in zip(starts[own], ends[own])})
    return out


def masks_of(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The filters A to D that each text fails, as bits 0 to 3."""
    starts, ends = _words(body, at)
    begins = np.zeros(len(body), bool)
    begins[starts] = True
    words = _per_text(begins, at)
    distinct = distinct_words(body, at, starts, ends, _hashes(body, starts, ends))
    points = np.diff(at) - _per_text(_INNER[body], at)
    capitals, signs = _per_text(_CAPITAL[body], at), _per_text(_SIGN[body], at)
    return ((words < MIN_WORDS) | (100 * distinct < DISTINCT_PERCENT * words) << 1
            | (100 * capitals > CAPITAL_PERCENT * points) << 2 | (signs > 0) << 3).astype(np.int32)


def _scanned(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        body, at = bytescan.buffers(batch.column("text"))
        masks = [masks_of(body[at[i] : at[k]], at[i : k + 1] - at[i]) for i, k in bytescan.runs(at)]
        digests = [hashlib.sha256(body[s:e]).digest() for s, e in zip(at[:-1], at[1:])]
        mask = np.concatenate(masks) if masks else np.zeros(0, np.int32)
        yield pa.record_batch([batch.column("doc_id"), batch.column("part"), pa.array(mask), pa.array(digests, pa.binary())],
                              names=[f.split()[0] for f in _SEEN.split(", ")])


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask): the filters that each document fails, A as bit 0 to E as bit 4."""
    d = docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("part"), "text")
    seen = store.saved(store.spread(d).mapInArrow(_scanned, _SEEN), "masks")
    firsts = store.saved(
        seen.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last").select("digest", "first"), "copied")
    d = seen.join(store.hinted(firsts), "digest", "left")
    copy = F.when(F.col("doc_id") > F.col("first"), 1 << 4).otherwise(0)
    return d.select("doc_id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


ORDERS = ["".join(p) for p in permutations(FILTERS)]


def _bit(letter):
    return F.pow(F.lit(2), F.ascii(letter) - ord(FILTERS[0])).cast("int")


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.expr("quality = 1"), F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.expr("toxic = 1"), F.lit(False)).cast("long")).alias("toxic")).where("good + toxic > 0")
    marks = store.saved(marks, "labels")
    d = failures(docs).join(store.hinted(marks), "doc_id", "left")
    sums = d.groupBy("part", "mask").agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                                         F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    # at most 32 rows a part
    cells = sums.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    orders = cells.select("part", "cells", F.explode(F.split(F.lit(" ".join(ORDERS)), " ")).alias("filter_order"))
    at = orders.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    letters = F.split(F.substring("filter_order", F.lit(1), F.col("step") - 1), "")
    at = at.withColumn("bit", _bit(F.substring("filter_order", F.col("step"), F.lit(1)))).withColumn(
        "earlier", F.aggregate(F.filter(letters, lambda x: x != ""), F.lit(0), lambda s, x: s + _bit(x)))
    bit, earlier = F.col("bit"), F.col("earlier")

    def total(what: str, held):
        return F.aggregate(F.filter("cells", lambda c: held(c["mask"])), F.lit(0).cast("long"), lambda s, c: s + c[what])

    def here(m):
        return (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(earlier) == 0)

    # of the orders, a filter comes first among the filters that a document fails in one of as many as it fails
    share = F.aggregate(F.filter("cells", lambda c: c["mask"].bitwiseAND(bit) != 0), F.lit(0).cast("long"),
                        lambda s, c: s + c["n"] * (len(ORDERS) / F.bit_count(c["mask"])).cast("long"))
    return at.select(
        "part", "filter_order", "step", total("n", lambda m: m.bitwiseAND(bit.bitwiseOR(earlier)) == 0).alias("kept"),
        total("n", here).alias("removed"), total("n", lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(earlier) != 0)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"), total("good", here).alias("good_lost"), total("toxic", here).alias("toxic_lost"),
        share.alias("shapley"))
