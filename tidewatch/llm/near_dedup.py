"""Near-duplicate documents by a signature-coordinate inverted join.

1. Each text becomes the set of hashes of its word windows and a MinHash signature. Texts with
   equal sets form one class, whatever their number; from here on a class counts once.
2. Every class is posted under each (coordinate, value) of its signature. Values that one class
   holds alone can bring no collision and go. A class left with fewer than ``matches`` shared
   values goes too.
3. Shared values are ordered by how many classes hold them. Two classes with at least
   ``matches`` equal coordinates must share one of their ``m - matches + 1`` rarest values, so
   only these are posted for the join (prefix filter) and the long lists are skipped; they are
   read again only inside the collision count of a pair that met in a short list.
4. A list never gives all its pairs. First each list pairs its members with one member, for a
   few different choices of that member; found links merge classes into components. What stays
   is compared across components only, so no link between components is lost. Members of one large
   component in a list have blocks of their own there, which are never compared with each other.
5. Pairs with enough collisions are confirmed on their full sets.

Defined cases: null or blank texts have empty sets and link with nothing; a null ``doc_id``
links with nothing and is not kept; rows that share a ``doc_id`` are one document, linked by any of
their texts, and rows without a set follow it; very long texts are read whole, in one task each; an
empty table gives an empty result; a component's name is its smallest ``doc_id``, so ties don't occur; other
columns of the input, whatever their names, are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import store, wordhash
from tidewatch.llm.components import components

SIGNATURE = 64
MISS = 1e-6
STAR_ROUNDS = 3
BLOCK_ROWS, BLOCK_GRAMS, SUB = 2048, 2_000_000, 256
KEY = ("n_shingles", "k1", "k2")
_MULT = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def match_threshold(percent: int, size: int = SIGNATURE, miss: float = MISS) -> int:
    """Largest count that a pair at the similarity limit stays below with probability ``miss`` at most."""
    p, below = percent / 100, 0.0
    for t in range(size + 1):
        below += comb(size, t) * p**t * (1 - p) ** (size - t)
        if below > miss:
            return max(1, t)
    return size


def _text_sets(data, offs, words: int):
    """(sorted distinct window hashes, their offsets) of a chunk of texts."""
    h, first, _, _ = wordhash.words(data, offs)
    g, where = wordhash.grams(h, first, words)
    sets = [np.unique(g[where[i] : where[i + 1]]) for i in range(len(where) - 1)]
    out = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=out[1:])
    return (np.concatenate(sets) if sets else g[:0]), out


def _signatures(words: int, size: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            data, offs = wordhash.string_buffers(batch.column(1))
            for i, j in wordhash.chunks(offs):
                flat, at = _text_sets(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], words)
                n = np.diff(at)
                some, k1, k2 = _keys_of(flat, at)
                sig = np.zeros((len(some), size), np.uint32)
                if len(some):
                    start = at[:-1][some]
                    for c in range(size):
                        sig[:, c] = np.minimum.reduceat(flat * _MULT[c], start) >> np.uint64(32)
                lists = np.zeros(len(n) + 1, np.int32)
                np.cumsum(np.where(n > 0, size, 0), out=lists[1:])
                yield pa.record_batch([
                    batch.column(0).slice(i, j - i),
                    pa.array(n, pa.int64()),
                    pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(lists), pa.array(sig.reshape(-1).view(np.int32))),
                ], names=["doc_id", *KEY, "sig"])

    return run


def _keys_of(flat: np.ndarray, at: np.ndarray):
    """Two sums over each set's hashes; with its size they name the set."""
    some = np.flatnonzero(np.diff(at))
    k1, k2 = np.zeros(len(at) - 1, np.uint64), np.zeros(len(at) - 1, np.uint64)
    if len(some):
        start = at[:-1][some]
        k1[some] = np.add.reduceat(wordhash.mix(flat + np.uint64(1)), start)
        k2[some] = np.add.reduceat(wordhash.mix(flat ^ np.uint64(0x5DEECE66D)), start)
    return some, k1, k2


def _sets(words: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            data, offs = wordhash.string_buffers(batch.column(1))
            for i, j in wordhash.chunks(offs):
                flat, at = _text_sets(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], words)
                _, k1, k2 = _keys_of(flat, at)
                yield pa.record_batch([
                    batch.column(0).slice(i, j - i), pa.array(np.diff(at), pa.int64()),
                    pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat.view(np.int64))),
                ], names=["low", *KEY, "grams"])

    return run


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, need: int) -> DataFrame:
    """The pairs (a, b) with enough collisions whose full sets are similar enough."""
    one = classes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("values").alias("va"))
    two = classes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("values").alias("vb"))
    met = (
        pairs.join(one, "a").join(two, "b")
        .where(F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)"))
        .where(F.expr(f"size(array_intersect(va, vb)) >= {need}"))
        .select("a", "b", "na", "nb")
    )
    both = F.size(F.array_intersect("ga", "gb"))
    return (
        met.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
        .where(100 * both >= percent * (F.col("na") + F.col("nb") - both))
        .select("a", "b")
    )


def _tile_links(percent: int, need: int):
    """Over rows sorted by (value, t, u): the links between labels that join local components."""

    def group(rows: dict) -> list[tuple[int, int]]:
        ids, label, block, sig, grams = (rows[c] for c in ("id", "label", "block", "sig", "grams"))
        t, u, value = rows["t"][0], rows["u"][0], rows["value"][0]
        order = np.argsort(block, kind="stable")
        n = np.array([len(g) for g in grams])
        parent: dict[int, int] = {}

        def root(x):
            while (y := parent.get(x, x)) != x:
                parent[x] = parent.get(y, y)
                x = y
            return x

        width = max(len(p) for p in rows["prefix"])
        prefix = np.full((len(ids), width), np.iinfo(np.int64).min)
        for k, p in enumerate(rows["prefix"]):
            prefix[k, : len(p)] = p
        blank, never = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        cut = int((block == t).sum()) if t != u else len(ids)
        out = []
        for a in range(0, cut, SUB):
            left = order[a : min(a + SUB, cut)]
            for b in range(a if t == u else cut, len(ids), SUB):
                right = order[b : b + SUB]
                same = np.zeros((len(left), len(right)), np.int16)
                for c in range(sig.shape[1]):
                    same += sig[left, c][:, None] == sig[right, c][None, :]
                ok = (same >= need) & (label[left][:, None] != label[right][None, :])
                lo = np.minimum(n[left][:, None], n[right][None, :])
                ok &= 100 * lo >= percent * np.maximum(n[left][:, None], n[right][None, :])
                i, j = np.nonzero(ok)
                if a == b and t == u:
                    i, j = i[j > i], j[j > i]
                for k in range(0, len(i), 4096):
                    x, y = left[i[k : k + 4096]], right[j[k : k + 4096]]
                    both = (prefix[x][:, :, None] == prefix[y][:, None, :]).any(axis=2) & (prefix[x] != blank)
                    here = np.where(both, prefix[x], never).min(axis=1) == value
                    for p, q in zip(x[here].tolist(), y[here].tolist()):
                        rp, rq = root(int(label[p])), root(int(label[q]))
                        if rp == rq:
                            continue
                        common = len(np.intersect1d(grams[p], grams[q], assume_unique=True))
                        if 100 * common >= percent * (n[p] + n[q] - common):
                            parent[max(rp, rq)] = min(rp, rq)
                            out.append((int(min(ids[p], ids[q])), int(max(ids[p], ids[q]))))
        return out

    def rows_of(batch, a: int, b: int) -> dict:
        out = {c: batch.column(c)[a:b] for c in ("value", "t", "u", "block", "id", "label")}
        out = {c: v.to_numpy() for c, v in out.items()}
        out["sig"] = batch.column("sig")[a:b].flatten().to_numpy().reshape(b - a, -1)
        for c in ("prefix", "grams"):
            col = batch.column(c)[a:b]
            flat = col.flatten().to_numpy()
            ends = np.cumsum(np.diff(col.offsets.to_numpy()))
            out[c] = np.split(flat, ends[:-1])
        return out

    def joined(parts: list[dict]) -> dict:
        if len(parts) == 1:
            return parts[0]
        return {c: sum((p[c] for p in parts), []) if isinstance(parts[0][c], list) else np.concatenate([p[c] for p in parts])
                for c in parts[0]}

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, key = [], None

        def finish():
            got = group(joined(held)) if held else []
            return pa.record_batch([pa.array([x for x, _ in got], pa.int64()), pa.array([y for _, y in got], pa.int64())],
                                   names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("value", "t", "u")])
            at = np.r_[0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, batch.num_rows]
            for a, b in zip(at[:-1], at[1:]):
                now = tuple(keys[:, a])
                if now != key and held:
                    yield finish()
                    held = []
                key = now
                held.append(rows_of(batch, int(a), int(b)))
        yield finish()

    return run


def _blocks(g: str, grams: str):
    return F.greatest(F.ceil(F.col(g) / BLOCK_ROWS), F.ceil(F.col(grams) / BLOCK_GRAMS), F.lit(1))


def _across(now: DataFrame, hubs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, need: int) -> DataFrame:
    """Links between members of a list that are in different components, all of them compared.

    A list is cut into blocks of at most BLOCK_ROWS members and about BLOCK_GRAMS windows; two
    blocks are one unit of work. A component that fills more than one block has blocks of its own, and
    two of these are no unit: its members go to the blocks of the others only. A pair is compared in the
    first of its common lists only, and only links that join components come out, so the output is no
    longer than the members.
    """
    held = now.join(hubs.select("value"), "value")
    shares = held.groupBy("value", "label").agg(F.count("*").alias("g"), F.sum("n").alias("grams")).withColumn("blocks", _blocks("g", "grams"))
    large = shares.where("blocks > 1").select("value", F.col("label").alias("only"), "blocks")
    pool = (
        shares.where("blocks = 1").groupBy("value").agg(F.sum("g").alias("g"), F.sum("grams").alias("grams"))
        .select("value", F.lit(None).cast("long").alias("only"), _blocks("g", "grams").alias("blocks"))
    )
    parts = store.saved(large.unionByName(pool), "blocks")
    name = F.xxhash64("only", "k")
    others = (
        parts.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .groupBy("value").agg(F.collect_list(F.struct(name.alias("block"), "only")).alias("others"))
    )
    own = (
        held.join(parts.where("only is not null").withColumnRenamed("only", "label").withColumnRenamed("blocks", "own"), ["value", "label"], "left")
        .join(parts.where("only is null").select("value", F.col("blocks").alias("pooled")), "value", "left")
        .withColumn("only", F.when(F.col("own").isNotNull(), F.col("label")))
        .withColumn("k", F.pmod(F.xxhash64("id"), F.coalesce("own", "pooled")))
        .select("value", "id", "label", "only", name.alias("block"))
    )
    tiles = (
        own.join(others, "value").select("value", "id", "label", "only", "block", F.explode("others").alias("o"))
        .where("only is null or o.only is null or only <> o.only")
        .select("value", F.least("block", "o.block").alias("t"), F.greatest("block", "o.block").alias("u"), "block", "id", "label")
        .join(classes.select("id", "sig", F.slice("values", F.lit(1), F.size("values") - need + 1).alias("prefix")), "id")
        .join(sets, "id")
    )
    return (
        tiles.repartition("value", "t", "u").sortWithinPartitions("value", "t", "u")
        .mapInArrow(_tile_links(percent, need), "a long, b long")
    )


def _labelled(posted: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return posted.withColumn("label", F.col("id"))
    return posted.join(labels, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")


def similar_classes(signed: DataFrame, docs: DataFrame, words: int, percent: int, bridges: DataFrame | None = None) -> DataFrame:
    """(id, component) of the classes of ``signed`` (id, low, n, the key, sig) that are linked to a smaller id.

    ``low`` is the doc_id of one member; ``bridges`` (a, b) are pairs of classes that belong together anyway.
    """
    need = match_threshold(percent)
    value = F.transform("sig", lambda v, i: F.shiftleft(i.cast("long"), 32).bitwiseOR(v.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))
    held = signed.select("id", "n", F.explode(value).alias("value"))
    shared = signed.select(F.explode(value).alias("value")).groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    classes = store.saved(
        held.join(shared, "value").groupBy("id", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("v"))
        .where(F.size("v") >= need)
        .select("id", "n", F.col("v.value").alias("values")).join(signed.select("id", "n", "sig"), ["id", "n"]),
        "classes",
    )
    posted = store.saved(
        classes.select("id", "n", F.explode(F.slice("values", F.lit(1), F.size("values") - need + 1)).alias("value")),
        "postings",
    )
    some = store.saved(signed.select("id", "low", *KEY).join(classes.select("id"), "id", "left_semi"), "some")
    n_some = some.count()
    sets = store.saved(
        docs.select(F.col("doc_id").alias("low"), "text").join(store.hinted(some.select("low").distinct(), n_some), "low", "left_semi")
        .mapInArrow(_sets(words), "low long, n_shingles long, k1 long, k2 long, grams array<long>")
        .dropDuplicates(["low", *KEY]).join(store.hinted(some, n_some), ["low", *KEY]).select("id", "grams"),
        "sets",
    )
    links = bridges
    labels = None if links is None else components(links)
    for turn in range(STAR_ROUNDS + 1):
        now = _labelled(posted, labels)
        first = F.min("id") if turn == 0 else F.min_by("id", F.xxhash64("id", F.lit(turn)))
        hubs = (
            now.groupBy("value")
            .agg(first.alias("hub"), F.min("label").alias("low"), F.max("label").alias("high"))
            .where("low < high")
        )
        if turn < STAR_ROUNDS:
            tags = now.select(F.col("id").alias("hub"), F.col("label").alias("hub_label")).distinct()
            pairs = (
                now.join(hubs.select("value", "hub").join(tags, "hub"), "value").where("label <> hub_label")
                .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
            )
            found = store.saved(_confirmed(pairs, classes, sets, percent, need), "links")
        else:
            found = store.saved(_across(now, hubs, classes, sets, percent, need), "links")
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            labels = components(links)
        elif turn < STAR_ROUNDS and labels is not None and hubs.isEmpty():
            break
    if labels is None:
        labels = posted.select("id", F.col("id").alias("component")).limit(0)
    return labels


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text)."""
    signed = store.saved(
        store.spread(docs.select("doc_id", "text")).mapInArrow(
            _signatures(words, SIGNATURE), "doc_id long, n_shingles long, k1 long, k2 long, sig array<int>"
        ),
        "signatures",
    )
    key = list(KEY)
    classes = store.saved(
        signed.where("n_shingles > 0 and doc_id is not null").groupBy(*key)
        .agg(F.min("doc_id").alias("low"), F.first("sig").alias("sig"))
        .withColumn("n", F.col("n_shingles")).withColumn("id", F.monotonically_increasing_id()),
        "sets-by-key",
    )
    # ids of rows with different texts: their classes belong together
    several = store.saved(
        signed.where("doc_id is not null").groupBy("doc_id").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in key for f in (F.min, F.max)])
        .where(" or ".join(f"min_{c} <> max_{c}" for c in key)).select("doc_id"),
        "several-texts",
    )
    n_several = several.count()
    held, bridges = None, None
    if n_several:
        held = store.saved(
            signed.select("doc_id", *key).join(store.hinted(several, n_several), "doc_id", "left_semi").distinct()
            .join(classes.select("id", *key), key).select("doc_id", "id"),
            "held",
        )
        firsts = held.groupBy("doc_id").agg(F.min("id").alias("a"))
        bridges = held.join(firsts, "doc_id").where("a <> id").select("a", F.col("id").alias("b"))
    labels = similar_classes(classes, docs, words, percent, bridges)
    # a component's name: the smallest doc_id of its classes
    members = labels.unionByName(labels.select(F.col("component").alias("id"), "component").distinct())
    lows = members.join(classes.select("id", "low"), "id").groupBy("component").agg(F.min("low").alias("name"))
    by_key = (
        classes.select(*key, "id", "low").join(members.join(lows, "component").select("id", "name"), "id", "left")
        .select(*key, "id", F.coalesce("name", "low").alias("own"))
    )
    out = signed.select("doc_id", *key).join(by_key.drop("id"), key, "left")
    if n_several:
        alike = held.join(by_key, "id").groupBy("doc_id").agg(F.min("own").alias("other"))
        out = out.join(store.hinted(alike, n_several), "doc_id", "left").withColumn("own", F.coalesce("own", "other"))
    return (
        out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("own", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def keep_one_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without all but the smallest doc_id of each group of near copies.

    Of rows that share a ``doc_id`` the one whose text hashes lowest stays. Rows with a null ``doc_id`` stay as they are.
    """
    found = store.saved(near_duplicates(docs, words, percent).where("doc_id is not null"), "near")
    gone = found.where("not kept").select("doc_id").distinct()
    again = found.groupBy("doc_id").count().where("count > 1").select("doc_id")
    left = docs.join(store.hinted(gone), "doc_id", "left_anti").select(*docs.columns)
    n_again = again.count()
    if n_again:
        again = store.hinted(again, n_again)
        one = left.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(
            F.min_by(F.struct(*docs.columns), F.struct(F.xxhash64("text"), F.length("text"))).alias("row"))
        left = left.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(one.select("row.*"))
    return left
