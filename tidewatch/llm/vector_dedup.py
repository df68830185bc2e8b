"""Near-duplicate vectors by int8 tile products with error bounds.

Equal vectors form a class. Every class's vector v (scaled to length 1) is rounded once to int8 codes q with scale s, and
e = |v - s q| is kept. Classes are dealt into tiles of about ``TILE`` vectors; each pair of tiles is one group of bounded
size, and only codes, scales and errors are sent there, a byte a dimension. For two vectors

    |v.w - s_v s_w (q_v.q_w)|  <=  e_v + (1 + e_v) e_w  (+ a slack for rounding),

so a code product below the limit minus that bound cannot be a link, one above the limit plus
it must be, and only what lies between is computed again in double precision: the pair of tiles names the vectors that are in
such a pair, and a second pass gets these in full, groups them by pair of tiles and decides. The code products
are run as float32 matrix products: codes are at most 127, so sums stay exact integers there up to
1,040 dimensions; more dimensions are cut into parts of 1,024 and summed as float64.

A group returns, per vector, how many other vectors it links to, and a spanning set of links, never
all pairs. All comparisons are made (the number of tile pairs grows with the square of the number
of vectors; tile size and memory don't).

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with
nothing; vectors of different lengths never link; rows that share a ``vec_id`` are one vertex, with the links of all
its vectors, and ``n_links`` counts distinct other ids; a null ``vec_id`` links with nothing and is not kept; a
component's name is its smallest id, so ties don't occur; an empty table gives an empty result; other columns of
the input, whatever their names, are neither read nor returned. Of ids with several different vectors (none in a sound
table) the tiles list all linked classes; of all others they only count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import store
from tidewatch.llm.components import components

TILE = 8192
_SUB = 1024
_PART = 1024
_SLACK = 1e-9
COUNT, EDGE, NAMED, ASK = range(4)


def _unit(flat: np.ndarray, dim: int) -> np.ndarray:
    """Rows scaled by the largest component first, so that no square over- or underflows, then to length 1."""
    v = flat.reshape(-1, dim).astype(np.float64)
    v /= np.abs(v).max(axis=1)[:, None]
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def _codes(v: np.ndarray):
    """(int8 codes, scales, error bounds) of unit rows."""
    top = np.abs(v).max(axis=1)
    scale = top / 127.0
    q = np.rint(v / scale[:, None])
    err = np.sqrt(((v - q * scale[:, None]) ** 2).sum(axis=1)) + _SLACK
    return q.astype(np.int8), scale, err


def _quantised(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        codes, scales, errors = [], [], []
        for x in batch.column("vector"):
            one = np.array(x.as_py(), np.float64)
            q, s, e = _codes(_unit(one, len(one)))
            codes.append(q.tobytes())
            scales.append(float(s[0]))
            errors.append(float(e[0]))
        kept = [batch.column(c) for c in ("id", "copies", "listed", "vector")]
        sizes = pa.array([len(c) for c in codes], pa.int32())
        yield pa.record_batch([*kept, sizes, pa.array(codes, pa.binary()), pa.array(scales, pa.float64()), pa.array(errors, pa.float64())],
                              names=["id", "copies", "listed", "vector", "dim", "codes", "scale", "error"])


def _code_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(np.float32), b.astype(np.float32)
    if a.shape[1] <= _PART:
        return a @ b.T
    return sum((a[:, k : k + _PART] @ b[:, k : k + _PART].T).astype(np.float64) for k in range(0, a.shape[1], _PART))


def _exact(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    for k in range(0, len(i), 1 << 16):
        out[k : k + (1 << 16)] = np.einsum("ij,ij->i", a[i[k : k + (1 << 16)]], b[j[k : k + (1 << 16)]])
    return out


def _find(parent: np.ndarray, i: np.ndarray) -> np.ndarray:
    while True:
        p = parent[i]
        if (p == i).all():
            return i
        i = p


def _merge(parent: np.ndarray, i: np.ndarray, j: np.ndarray):
    """Union all links (i, j); returns the roots that were joined."""
    joined = []
    while len(i):
        a, b = _find(parent, i), _find(parent, j)
        on = a != b
        i, j, a, b = i[on], j[on], a[on], b[on]
        if not len(i):
            break
        hi, lo = np.maximum(a, b), np.minimum(a, b)
        order = np.lexsort((lo, hi))
        hi, lo = hi[order], lo[order]
        one = np.flatnonzero(np.r_[True, hi[1:] != hi[:-1]])
        parent[hi[one]] = lo[one]
        joined.append(np.stack([hi[one], lo[one]]))
    return np.concatenate(joined, axis=1) if joined else np.zeros((2, 0), np.int64)


def _tile_pair(limit: float, in_full: bool):
    """Links of a pair of tiles: those the codes prove, and the vectors of pairs they leave open; or, ``in_full``, the open pairs."""

    def run(key, table):
        import pyarrow as pa

        t, u, dim = (k.as_py() for k in key)
        column = {c: table.column(c).combine_chunks() for c in table.column_names}
        order = np.lexsort((column["id"].to_numpy(), column["tile"].to_numpy()))
        ids, tile, weight, scale, err = (column[c].to_numpy()[order] for c in ("id", "tile", "copies", "scale", "error"))
        listed = column["listed"].to_numpy(zero_copy_only=False)[order]
        q = np.frombuffer(b"".join(column["codes"].to_pylist()), np.int8).reshape(len(ids), dim)[order]
        exact = _unit(column["vector"].flatten().to_numpy(zero_copy_only=False), dim)[order] if in_full else None
        n = len(ids)
        links, parent, asked = np.zeros(n, np.int64), np.arange(n), np.zeros(n, bool)
        edges, named = [], []
        cut = int(np.searchsorted(tile, u)) if t != u else n
        for a in range(0, cut, _SUB):
            ae = min(a + _SUB, cut)
            for b in range(a if t == u else cut, n, _SUB):
                be = min(b + _SUB, n)
                near = _code_product(q[a:ae], q[b:be]) * (scale[a:ae, None] * scale[None, b:be])
                bound = err[a:ae, None] + (1 + err[a:ae, None]) * err[None, b:be] + _SLACK
                i, j = np.nonzero(near >= limit - bound)
                if a == b:
                    up = j > i
                    i, j = i[up], j[up]
                if not len(i):
                    continue
                sure = near[i, j] >= limit + bound[i, j]
                if in_full:
                    i, j = i[~sure], j[~sure]
                    sure = _exact(exact[a:ae], exact[b:be], i, j) >= limit
                else:
                    asked[i[~sure] + a] = asked[j[~sure] + b] = True
                i, j = i[sure] + a, j[sure] + b
                links += np.bincount(i, weight[j], n).astype(np.int64) + np.bincount(j, weight[i], n).astype(np.int64)
                edges.append(_merge(parent, i, j))
                tell = listed[i] | listed[j]
                named += [np.stack([i[tell], j[tell]]), np.stack([j[tell], i[tell]])]
        hit, ask = np.flatnonzero(links), np.flatnonzero(asked)
        e, m = (np.concatenate(x, axis=1) if x else np.zeros((2, 0), np.int64) for x in (edges, named))
        size = len(hit) + e.shape[1] + m.shape[1] + len(ask)
        return pa.table({
            "kind": pa.array(np.repeat([COUNT, EDGE, NAMED, ASK], [len(hit), e.shape[1], m.shape[1], len(ask)]), pa.int32()),
            "id": pa.array(ids[np.r_[hit, e[0], m[0], ask]], pa.int64()),
            "other": pa.array(ids[np.r_[hit, e[1], m[1], ask]], pa.int64()),
            "links": pa.array(np.r_[links[hit], np.zeros(size - len(hit), np.int64)], pa.int64()),
            "t": pa.array(np.full(size, t), pa.int64()), "u": pa.array(np.full(size, u), pa.int64()),
        })

    return run


def linked_vectors(vectors: DataFrame, limit: float = 0.9, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding)."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", "embedding", sound.alias("sound"))
    members = store.saved(rows.where("sound").select("vec_id", "embedding").distinct(), "members")
    several = store.saved(members.groupBy("vec_id").count().where("count > 1").select("vec_id"), "several-vectors")
    n_several = several.count()
    flagged = members.join(store.hinted(several, n_several).withColumn("many", F.lit(True)), "vec_id", "left") if n_several else (
        members.withColumn("many", F.lit(None).cast("boolean")))
    # a class: equal vectors; ``copies`` counts its members with one vector only, ``listed`` tells that there are others
    grouped = (
        flagged.groupBy("embedding")
        .agg(F.min("vec_id").alias("low"), F.count_if(F.col("many").isNull()).alias("copies"), (F.count_if("many") > 0).alias("listed"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    classes = store.saved(grouped, "vectors")
    n = classes.count()
    tiles = max(1, -(-n // tile))
    own = F.pmod(F.xxhash64("id"), F.lit(tiles))
    schema = "id long, copies long, listed boolean, vector array<float>, dim int, codes binary, scale double, error double".replace(
        "array<float>", classes.schema["embedding"].dataType.simpleString())
    coded = store.saved(classes.select("id", "copies", "listed", F.col("embedding").alias("vector")).mapInArrow(_quantised, schema), "codes")
    tiled = coded.select("id", "copies", "listed", "dim", "codes", "scale", "error", own.alias("tile"))
    dealt = (
        tiled.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
        .withColumn("t", F.least("tile", "other")).withColumn("u", F.greatest("tile", "other")).drop("other")
    )
    parts = min(tiles * (tiles + 1) // 2, 4096)
    out = "kind int, id long, other long, links long, t long, u long"
    proved = store.saved(dealt.repartition(parts, "t", "u").groupBy("t", "u", "dim").applyInArrow(_tile_pair(limit, False), out), "vector-links")
    found = proved.where(f"kind <> {ASK}")
    if not (open_ := proved.where(f"kind = {ASK}").select("id", "t", "u")).isEmpty():
        in_full = open_.join(coded.withColumn("tile", own), "id")
        decided = in_full.repartition(parts, "t", "u").groupBy("t", "u", "dim").applyInArrow(_tile_pair(limit, True), out)
        found = found.unionByName(store.saved(decided, "vector-links-in-full"))
    edges = found.where(f"kind = {EDGE}").select("id", "other")
    again = None
    if n_several:
        again = store.saved(
            members.join(store.hinted(several, n_several), "vec_id", "left_semi").join(classes.select("embedding", "id", "copies"), "embedding")
            .select("vec_id", "id", "copies"), "several-classes")
        firsts = again.groupBy("vec_id").agg(F.min("id").alias("other"))
        edges = edges.unionByName(again.join(firsts, "vec_id").where("id <> other").select("id", "other"))
    labels = components(edges, "id", "other")
    joined = labels.unionByName(labels.select(F.col("component").alias("id"), "component").distinct())
    lows = joined.join(classes.select("id", "low"), "id").groupBy("component").agg(F.min("low").alias("name"))
    names = joined.join(lows, "component").select("id", "name")
    counts = found.where(f"kind = {COUNT}").groupBy("id").agg(F.sum("links").alias("links"))
    done = classes.join(names, "id", "left").join(counts, "id", "left")
    links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    if n_several:
        # distinct ids with several vectors in a class or its links
        near = found.where(f"kind = {NAMED}").select("id", "other").unionByName(again.select("id", F.col("id").alias("other"))).distinct()
        guests = near.join(again.select(F.col("id").alias("other"), "vec_id"), "other").groupBy("id").agg(F.count_distinct("vec_id").alias("guests"))
        done, links = done.join(guests, "id", "left"), links + F.coalesce("guests", F.lit(0))
    done = done.select("embedding", F.coalesce("name", "low").alias("component_id"), links.alias("n_links"))
    lost = rows.where("not sound").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.where("sound").join(done, "embedding")
    if n_several:
        reach = again.select("vec_id", "id").join(near, "id").select("vec_id", "other").distinct()
        alone = reach.join(classes.select(F.col("id").alias("other"), "copies"), "other").groupBy("vec_id").agg(F.sum("copies").alias("alone"))
        guests = (
            reach.join(again.select(F.col("id").alias("other"), F.col("vec_id").alias("guest")), "other")
            .groupBy("vec_id").agg((F.count_distinct("guest") - 1).alias("guests"))
        )
        whole = alone.join(guests, "vec_id").select("vec_id", (F.col("alone") + F.col("guests")).alias("whole"))
        linked = linked.join(store.hinted(whole, n_several), "vec_id", "left").withColumn("n_links", F.coalesce("whole", "n_links"))
    return linked.select("vec_id", "n_links", "component_id").unionByName(lost).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
