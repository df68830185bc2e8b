"""Levels of likeness for all pairs of names that share a key: tiles of names, compared as arrays.

The rules are those of :func:`tidewatch.operators.naming.level` and ``soft_likeness``; here each word of a tile is compared with each other once, and each
step is taken for all pairs of a tile together.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import naming

#: Fixed value: names of a block; a tile holds one or two of them, whatever the number of names that share a key.
TILE = 250


def words_alike(words: list[str]) -> np.ndarray:
    """``naming.token_similarity`` of each word (distinct, sorted) with each other."""
    out = np.eye(len(words))
    i, j = np.triu_indices(len(words), 1)
    plain = np.array([len(w) >= 4 and w.isascii() for w in words], bool)
    initial = np.array([ord(w[0]) if w else -1 for w in words])
    some = plain[i] & plain[j] & (initial[i] == initial[j])
    i, j = i[some], j[some]
    if not len(i):
        return out
    size, wide = np.array([len(w) for w in words]), max(map(len, words))
    codes = np.full((len(words), wide), -1)
    for k, w in enumerate(words):
        codes[k, : len(w)] = [ord(c) for c in w]
    a, b, la, lb = codes[i], codes[j], size[i], size[j]
    reach = np.maximum(0, np.maximum(la, lb) // 2 - 1)
    free, met = b >= 0, np.zeros(a.shape, bool)
    for x in range(wide):
        open_ = a[:, x] >= 0
        for y in range(wide):
            hit = open_ & free[:, y] & (a[:, x] == b[:, y]) & (abs(x - y) <= reach)
            open_ &= ~hit
            free[:, y] &= ~hit
            met[:, x] |= hit
    m = met.sum(1)
    order = lambda c, kept: np.take_along_axis(c, np.argsort(~kept, 1, kind="stable"), 1)
    swapped = ((order(a, met) != order(b, (b >= 0) & ~free)) & (np.arange(wide) < m[:, None])).sum(1) // 2
    base = np.where(m > 0, (m / la + m / lb + (m - swapped) / np.maximum(m, 1)) / 3, 0.0)
    start = np.cumprod((a[:, :4] == b[:, :4]) & (a[:, :4] >= 0), 1).sum(1)
    value = np.where(base > 0.7, base + start * 0.1 * (1 - base), base)
    out[i, j] = out[j, i] = np.where(value >= naming.WORDS_ALIKE, value, 0.0)
    return out


class Tile:
    """Names as arrays of their words' numbers, -1 behind the last word; words are numbered by their letters."""

    def __init__(self, sides: list[dict], n: int):
        names = [naming._Name(s, n) for s in sides]
        self.words = sorted({w for x in names for w in x.words})
        number = {w: k for k, w in enumerate(self.words)}
        wide = max([len(x.words) for x in names] + [1])

        def put(values, fill, kind):
            grid = np.full((len(names), wide), fill, kind)
            for k, row in enumerate(values):
                grid[k, : len(row)] = row
            return grid

        self.size = np.array([len(x.words) for x in names])
        self.word = put([[number[w] for w in x.words] for x in names], -1, np.int64)
        self.weight = put([[x.weight[w] for w in x.words] for x in names], 0.0, float)
        self.rare = put([[w in x.rare for w in x.words] for x in names], False, bool)
        self.telling = put([[w in x.telling for w in x.words] for x in names], False, bool)
        by_letters = np.argsort(np.where(self.word < 0, len(self.words), self.word), 1, kind="stable")
        self.sorted = np.take_along_axis(self.word, by_letters, 1)
        self.sorted_weight = np.take_along_axis(self.weight, by_letters, 1)
        self.norm = np.array([float(np.sqrt(sum(w * w for w in x.weight.values()))) for x in names])
        self.total = np.array([sum(x.weight.values()) for x in names], float)
        strings: dict = {}
        self.nn, self.lk = (np.array([strings.setdefault(s, len(strings)) if s else -1 - k for k, s in enumerate(col)]) for col in ([x.nn for x in names], [x.lk for x in names]))
        self.qualified = np.array([x.nn != x.lk for x in names])
        self.alike = words_alike(self.words)
        self._kin(number)
        self._runs(names, number)
        self._aliases(names)

    def _kin(self, number: dict) -> None:
        same = np.array([number.get(naming.ABBREVIATIONS.get(w, w), len(number) + hash(naming.ABBREVIATIONS[w]) % (1 << 40) if w in naming.ABBREVIATIONS else -1) for w in self.words], np.int64)
        kin = (self.alike > 0) | (same[:, None] == same[None, :])
        for k, w in enumerate(self.words):
            if len(w) >= 3 and w.isascii():
                x = k + 1
                while x < len(self.words) and self.words[x].startswith(w):
                    kin[k, x] |= self.words[x].isascii()
                    kin[x, k] = kin[k, x]
                    x += 1
        # what stands behind the last word is nothing's kin
        self.kin = np.zeros((len(kin) + 1,) * 2, bool)
        self.kin[:-1, :-1] = kin

    def _runs(self, names: list, number: dict) -> None:
        """Words that are the initials of a run: (name, word), and (name, word, a word of such runs)."""
        v = len(self.words) + 1
        held, of = [], []
        for k, x in enumerate(names):
            for initials, words in x.runs().items():
                if initials in number:
                    held.append(k * v + number[initials])
                    of += [(k * v + number[initials]) * v + number[w] for w in words]
        self.held, self.of, self.v = np.array(held, np.int64), np.array(of, np.int64), v

    def _aliases(self, names: list) -> None:
        """Pairs of names of which one has an alias that is the other's name, key or alias."""
        by, called = {}, {}
        for k, x in enumerate(names):
            for s in x.aliases:
                by.setdefault(s, []).append(k)
            for s in {x.nn, x.lk} | x.aliases:
                called.setdefault(s, []).append(k)
        met = {(min(a, b), max(a, b)) for s, xs in by.items() for a in xs for b in called.get(s, ()) if a != b}
        self.alias = np.array([a * len(names) + b for a, b in met], np.int64)
        self.n = len(names)

    def soft(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.zeros(len(a))
        for t in range(self.word.shape[1]):
            word = self.word[a, t]
            best, beside = np.zeros(len(a)), np.zeros(len(a))
            for u in range(self.word.shape[1]):
                other = self.sorted[b, u]
                s = np.where((word >= 0) & (other >= 0), self.alike[word, other], 0.0)
                more = s > best
                best, beside = np.where(more, s, best), np.where(more, self.sorted_weight[b, u], beside)
            total += self.weight[a, t] * beside * best
        norm = self.norm[a] * self.norm[b]
        return np.where(norm > 0, total / np.where(norm > 0, norm, 1.0), 0.0)

    def _common(self, a, b):
        """Per word of ``a``, whether ``b`` has it."""
        return (self.word[a] >= 0) & (self.word[a][:, :, None] == self.word[b][:, None, :]).any(2)

    def _lacked(self, x, y, common):
        """Per pair, whether a telling word of ``x`` that ``y`` has not is without a counterpart there."""
        out = np.zeros(len(x), bool)
        wide = self.word.shape[1]
        for t in range(wide):
            word = self.word[x, t]
            at = np.flatnonzero((word >= 0) & self.telling[x, t] & ~common[:, t])
            if not len(at):
                continue
            word, xs, ys = word[at], x[at], y[at]
            there = self.kin[word[:, None], self.word[ys]].any(1)
            if len(self.held):
                there |= np.isin(ys * self.v + word, self.held)
                for u in range(wide):
                    short = self.word[ys, u]
                    there |= (short >= 0) & self.telling[ys, u] & np.isin((xs * self.v + short) * self.v + word, self.of)
            out[at] |= ~there
        return out

    def levels(self, a: np.ndarray, b: np.ndarray, soft: np.ndarray) -> np.ndarray:
        """Places in ``naming.LEVELS``."""
        first = self.size[a] <= self.size[b]
        short, long = np.where(first, a, b), np.where(first, b, a)
        common, back = self._common(short, long), self._common(long, short)
        count = common.sum(1)
        within = count == self.size[short]
        held = within & (self.size[short] >= 2) & (self.total[short] >= naming.HELD_WEIGHT * self.total[long])
        more = self._lacked(long, short, back)
        apart = (count > 0) & more & self._lacked(short, long, common)
        seldom = (common & self.rare[short]).any(1) | (back & self.rare[long]).any(1)
        at = {k: i for i, k in enumerate(naming.LEVELS)}
        rules = [
            (self.nn[a] == self.nn[b], "exact"), (np.isin(np.minimum(a, b) * self.n + np.maximum(a, b), self.alias), "alias"), (self.lk[a] == self.lk[b], "linkkey"),
            (self.size[short] == 0, "none"), (held & self.qualified[short] & more, "conflict"), (held, "contain"), (apart, "conflict"), (soft >= naming.SOFT, "soft"),
            (within & (self.size[short] == 1) | seldom, "single")]
        return np.select([r for r, _ in rules], [at[k] for _, k in rules], at["none"])


def levels_within(names: DataFrame, key: Column) -> DataFrame:
    """(l, r, level, soft) for all pairs l < r of names with one ``key``; ``names`` as :func:`tidewatch.operators.naming.weighed` gives them.

    The names of a key are dealt into blocks, and each pair of blocks is a tile: names are sent once for each block beside theirs, pairs are made in the task.
    """
    d = names.select(key.alias("k"), F.struct("name", "nn", "lk", "toks", "aliases", "dfs").alias("s"), "n").where("k is not null")
    blocks = d.groupBy("k").agg(F.ceil(F.count("*") / TILE).cast("int").alias("m"))
    own = F.pmod(F.xxhash64("s.name"), F.col("m")).cast("int")
    d = d.join(blocks, "k").withColumn("own", own).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    d = d.select("k", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "own", "s", "n")

    def run(table):
        import pyarrow as pa

        rows = table.select(["s", "own", "i", "j", "n"]).to_pylist()
        rows.sort(key=lambda x: x["s"]["name"])
        name = [x["s"]["name"] for x in rows]
        own = np.array([x["own"] for x in rows])
        place = np.cumsum([k > 0 and name[k] != name[k - 1] for k in range(len(name))])  # equal names are no pair
        a, b = np.triu_indices(len(rows), 1)
        met = place[a] != place[b]
        if rows[0]["i"] != rows[0]["j"]:
            met &= own[a] != own[b]  # the others are in the tile of their block
        a, b = a[met], b[met]
        schema = pa.schema([("l", pa.string()), ("r", pa.string()), ("level", pa.string()), ("soft", pa.float64())])
        if not len(a):
            return schema.empty_table()
        tile = Tile([x["s"] for x in rows], rows[0]["n"])
        soft = tile.soft(a, b)
        column = pa.array(name, pa.string())
        return pa.table([column.take(pa.array(a)), column.take(pa.array(b)), pa.array(naming.LEVELS).take(pa.array(tile.levels(a, b, soft))), pa.array(soft)], schema=schema)

    return d.groupBy("k", "i", "j").applyInArrow(run, "l string, r string, level string, soft double")
