"""Packing of token sequences by linear grouping and best fit.

Texts are tokenised, closed with an end id and cut into pieces of at most ``capacity`` ids. All of
the planning happens on the histogram of piece lengths, which has at most ``capacity`` entries
whatever the number of documents:

1. Pieces longer than a quarter of the capacity are large. Sorted by length they fall into
   ``GROUPS`` groups of equal size; each is rounded up to its group's largest length.
2. Column generation finds how often to use each configuration of rounded lengths, so that a
   fractional number of sequences as small as possible holds all groups; whole uses are taken.
3. The actual lengths of a group go into its places in the chosen configurations.
4. The large pieces that are left and then all small pieces, longest first, go where the least
   room that is enough is left.

A plan is a list of slots: ``count`` pieces of one length, by rank among the pieces of that
length, go to consecutive sequences at one offset. A piece finds its rank from per-partition
counts (a prefix sum over partitions), so no length is sorted in one task.

Defined cases: a null or empty text is the end id alone; repeated rows and null ids are packed like
any other row; a very long text is tokenised whole and cut into as many pieces as it needs; pieces of one length are
interchangeable, so ties go by their place in the input; an empty table gives an empty result; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm import store, wordhash

CAPACITY = 4096
END_ID = 1
GROUPS = 256
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a worker keeps; beyond that it forgets the later half.
KEPT_WORDS = 200_000
#: Letters whose lower case and composed form are the same by any table: ASCII and Latin-1.
PLAIN_WORD = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00de\u00df-\u00f6\u00f8-\u00ff]+")


def _byte_alphabet() -> list[str]:
    """One visible character per byte: itself if it is printable Latin-1, else the next from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


BYTES = _byte_alphabet()


class WordEncoder:
    """Ids of texts by a tokenizer file that lower-cases and splits at white space and after words.

    No token of it crosses ASCII white space or joins an ASCII letter to a following mark; each
    distinct run between such places is encoded once by the tokenizer itself and then reused.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.at: dict[int, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def _room(self, new: int):
        """Before too many words are kept, forget all but those learned first, which are the common ones."""
        if len(self.at) + new > KEPT_WORDS:
            keep = KEPT_WORDS // 2
            self.at = {key: k for key, k in self.at.items() if k < keep}
            self.ends = self.ends[: len(self.at) + 1]
            self.flat = self.flat[: self.ends[-1]]

    def _learn(self, keys: list[int], words: list[bytes]):
        """Plain words go to the merges at once, in the byte alphabet; all others through the whole tokenizer."""
        merges, whole, plain, alphabet = self.tokenizer.model.tokenize, self.tokenizer.encode, PLAIN_WORD.fullmatch, BYTES
        flat: list[int] = []
        ends = []
        for w in words:
            text = w.decode("utf-8", "replace")
            if plain(text):
                text = text.lower()
                if not text.isascii():
                    text = "".join([alphabet[b] for b in text.encode()])
                flat += [t.id for t in merges(text)]
            else:
                flat += whole(text, add_special_tokens=False).ids
            ends.append(len(flat))
        base = len(self.at)
        self.at.update(zip(keys, range(base, base + len(keys))))
        self.ends = np.concatenate([self.ends, np.array(ends, np.int64) + self.ends[-1]])
        self.flat = np.concatenate([self.flat, np.array(flat, np.uint32)])

    def encode(self, data: np.ndarray, offs: np.ndarray):
        """(ids of all texts, offsets of the texts in them)."""
        # special tokens are the only place where case matters; all of them start alike
        table = wordhash.PLAIN if b"<|" in data.tobytes() else wordhash.LOWER
        h, first, starts, ends = wordhash.words(data, offs, table, stops=True)
        keys, place, which = np.unique(h, return_index=True, return_inverse=True)
        self._room(len(keys))
        listed = keys.tolist()
        at = list(map(self.at.get, listed))
        new = [k for k, v in enumerate(at) if v is None]
        if new:
            new.sort(key=place.tolist().__getitem__)
            raw = data.tobytes()
            lo, hi = starts[place[new]].tolist(), ends[place[new]].tolist()
            self._learn([listed[k] for k in new], [raw[a:b] for a, b in zip(lo, hi)])
            at = list(map(self.at.get, listed))
        at = np.array(at, np.int64)[which] if len(h) else np.zeros(0, np.int64)
        begin = self.ends[at]
        n = self.ends[at + 1] - begin
        to = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=to[1:])
        ids = self.flat[np.repeat(begin - to[:-1], n) + np.arange(to[-1])]
        return ids, to[first]


def _pieces(path: str | None, capacity: int, with_ids: bool):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        if path is None:
            import public_tokenizers

        encoder = WordEncoder(path or public_tokenizers.path(TOKENIZER))
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offs = wordhash.string_buffers(batch.column(1))
            for i, j in wordhash.chunks(offs):
                ids, at = encoder.encode(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                rows, texts = [], []
                for k in range(j - i):
                    own = np.append(ids[at[k] : at[k + 1]], np.uint32(END_ID)).astype("<u4")
                    for p, s in enumerate(range(0, len(own), capacity)):
                        cut = own[s : s + capacity]
                        rows.append((k, p, s, len(cut), zlib.crc32(cut.tobytes())))
                        if with_ids:
                            texts.append(cut)
                k, p, s, n, crc = (np.array(c, np.int64) for c in zip(*rows))
                cols = [batch.column(0).slice(i, j - i).take(pa.array(k)), pa.array(p.astype(np.int32)), pa.array(s), pa.array(n),
                        pa.array(crc), pa.array(np.full(len(k), part, np.int64)), pa.array(np.arange(seq, seq + len(k)))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "seq"]
                if with_ids:
                    ends = np.zeros(len(n) + 1, np.int32)
                    np.cumsum(n, out=ends[1:])
                    cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(texts).astype(np.int32))))
                    names.append("ids")
                seq += len(k)
                yield pa.record_batch(cols, names=names)

    return run


def _best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int):
    """The multiset of sizes within the capacity that is worth most, as counts."""
    most = int(capacity // sizes.min())
    value = np.full((most + 1, capacity + 1), -np.inf)
    value[0] = 0.0
    last = np.full((most + 1, capacity + 1), -1)
    for m in range(1, most + 1):
        for g, s in enumerate(sizes):
            got = value[m - 1, : capacity + 1 - s] + worth[g]
            better = got > value[m, s:]
            value[m, s:][better] = got[better]
            last[m, s:][better] = g
    m = int(np.argmax(value[:, capacity]))
    total, c = value[m, capacity], capacity
    counts = np.zeros(len(sizes), np.int64)
    while m:
        g = last[m, c]
        counts[g] += 1
        c -= sizes[g]
        m -= 1
    return counts, total


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 2000):
    """[(counts by group, uses)]: column generation for the fractional problem, uses rounded down."""
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    x = demand / np.diag(basis)
    for _ in range(rounds):
        worth = np.linalg.solve(basis.T, np.ones(k))
        column, total = _best_configuration(sizes, worth, capacity)
        if total <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, column.astype(float))
        can = step > 1e-12
        if not can.any():
            break
        ratio = np.where(can, x / np.where(can, step, 1), np.inf)
        out = int(np.argmin(ratio))
        x = np.maximum(x - ratio[out] * step, 0)
        x[out] = ratio[out]
        basis[:, out] = column
    uses = np.floor(x + 1e-9).astype(np.int64)
    return [(basis[:, p].round().astype(np.int64), int(uses[p])) for p in range(k) if uses[p] > 0]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS):
    """(slots, sequences). A slot is (length, first rank, first sequence, offset, count)."""
    left = {n: c for n, c in histogram.items() if c}
    slots: list[tuple[int, int, int, int, int]] = []
    ranks = dict.fromkeys(left, 0)
    made = 0
    rooms: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []

    def place(n, bins, offset, count):
        slots.append((n, ranks[n], bins, offset, count))
        ranks[n] += count
        left[n] -= count

    def open_room(room, bins, count):
        if count and room:
            if room not in rooms:
                rooms[room] = []
                insort(order, room)
            rooms[room].append((bins, count))

    if capacity in left:
        made = left[capacity]
        place(capacity, 0, 0, made)
    large = [n for n in sorted(left, reverse=True) if n > capacity // 4 and left[n]]
    total = sum(left[n] for n in large)
    if total:
        per = -(-total // groups)
        members: list[list[list[int]]] = [[]]
        free = per
        for n in large:
            c = left[n]
            while c:
                if not free:
                    members.append([])
                    free = per
                take = min(c, free)
                members[-1].append([n, take])
                c -= take
                free -= take
        # groups that round up to the same length are one size
        sizes: list[int] = []
        queues: list[list[list[int]]] = []
        for m in members:
            if sizes and sizes[-1] == m[0][0]:
                queues[-1] += m
            else:
                sizes.append(m[0][0])
                queues.append(list(m))
        demand = np.array([sum(c for _, c in q) for q in queues], float)
        for counts, uses in configurations(np.array(sizes), demand, capacity):
            places = [g for g in range(len(sizes)) for _ in range(counts[g])]
            uses = min([uses, *(sum(c for _, c in queues[g]) // counts[g] for g in set(places))])
            runs = []
            for g in places:
                need, got = uses, []
                while need:
                    n, c = queues[g][0]
                    take = min(n and c, need)
                    got.append([n, take])
                    need -= take
                    if take == c:
                        queues[g].pop(0)
                    else:
                        queues[g][0][1] -= take
                runs.append(got)
            rest = uses
            while rest:
                step = min(r[0][1] for r in runs)
                offset = 0
                for r in runs:
                    place(r[0][0], made, offset, step)
                    offset += r[0][0]
                    r[0][1] -= step
                    if not r[0][1]:
                        r.pop(0)
                open_room(capacity - offset, made, step)
                made += step
                rest -= step
    for n in sorted(left, reverse=True):
        while left[n]:
            k = bisect_left(order, n)
            if k == len(order):
                fresh = -(-left[n] // (capacity // n))
                open_room(capacity, made, fresh)
                made += fresh
                continue
            room = order[k]
            bins, count = rooms[room].pop()
            if not rooms[room]:
                del rooms[room], order[k]
            each = room // n
            full = min(count, left[n] // each)
            offset = capacity - room
            if full:
                for t in range(each):
                    place(n, bins, offset + t * n, full)
                open_room(room - each * n, bins, full)
            if full < count:
                some = left[n] if left[n] < each else 0
                for t in range(some):
                    place(n, bins + full, offset + t * n, 1)
                if some:
                    open_room(room - some * n, bins + full, 1)
                    full += 1
                open_room(room, bins + full, count - full)
    return slots, made


def _placed(slots):
    table = np.array(sorted(slots), np.int64).reshape(-1, 5)
    key = table[:, 0] << np.int64(48) | table[:, 1]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            names = batch.schema.names
            length, rank = (batch.column(names.index(c)).to_numpy() for c in ("length", "rank"))
            at = table[np.searchsorted(key, length << np.int64(48) | rank, side="right") - 1]
            cols = {c: batch.column(names.index(c)) for c in names if c != "rank"}
            cols["sequence_id"] = pa.array(at[:, 2] + rank - at[:, 1])
            cols["offset"] = pa.array(at[:, 3])
            yield pa.record_batch(list(cols.values()), names=list(cols))

    return run


def packed(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset."""
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, seq long"
    pieces = store.saved(
        store.spread(docs.select("doc_id", "text")).mapInArrow(_pieces(tokenizer, capacity, with_ids), fields + ", ids array<int>" * with_ids),
        "pieces",
    )
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    slots, _ = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("part", "length").orderBy("seq")) - 1
    ranked = (
        pieces.withColumn("within", within).join(base, ["part", "length"])
        .withColumn("rank", F.col("base") + F.col("within"))
    )
    keep = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return ranked.select(*keep, "rank").mapInArrow(_placed(slots), schema + ", sequence_id long, offset long")
