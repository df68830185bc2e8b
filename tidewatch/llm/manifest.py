"""Merkle manifest of a table: a node store on disk, level by level, and a proof for each document.

Leaves are hashed in one scan of the texts and stored. They are range partitioned and sorted by language and id, so that
each file of level 0 is a sorted run; a level's nodes are read from the files of the level below, summed by runs of ``FAN``
(combined before the shuffle, a group never holds more than ``FAN`` nodes) and written sorted by coordinate,
as the partition ``level=k`` of the store. The roots of the languages are the leaves of a second tree of the same kind.

Proofs are extracted by merging sorted scans: the leaves of a block of ``FAN ** BLOCK`` places, the inner nodes over
them, and one row with the siblings above the block come to one task in that order, and the task keeps one block's
inner nodes at a time. What is above a block is joined level by level on the run's coordinate, so nothing that grows with
the table is broadcast or collected.

The hash H of a sequence is the lower-case hexadecimal SHA-256 of its strings put together; a value is its length in UTF-8
bytes, a colon and its text, or ``-`` if it is null.

Defined cases: a null or repeated id, and any null column, is a leaf like others (null ids come first, equal ids are ordered by
leaf); equal rows are separate leaves; a null language is a group of its own, before all others; an empty text is ``0:``; very
long texts are hashed whole where they are read and not moved; a single leaf is its language's root, a single language's
root is the root, and a proof without siblings is H of nothing; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import ordering, store

FAN_BITS = 3
FAN = 1 << FAN_BITS
#: A block is FAN ** BLOCK leaves.
BLOCK = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of siblings that may be broadcast (eight digests each).
BROADCAST_RUNS = 20_000
_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def coded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(row: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[coded(row[c]) for c in FIELDS]), 256)


def tampered(docs: DataFrame) -> Column:
    """The contract's tampering: capitals A to Z of the text become small letters where 3 divides crc32 of the id."""
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", UPPER, LOWER))


def leaves(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """(doc_id, lang, leaf, altered): each row's leaf, and the leaf with ``changed`` as its text where that is not null."""
    row = {c: F.col(c) for c in FIELDS}
    # an altered text that is the same has the same leaf, so only texts that differ are hashed again
    altered = F.lit(None).cast("string") if changed is None else F.when(
        changed.isNotNull() & ~changed.eqNullSafe(F.col("text")), leaf_of(row | {"text": changed}))
    return docs.select("doc_id", "lang", leaf_of(row).alias("leaf"), altered.alias("altered"))


class NodeStore:
    """The levels of one tree per group, each a folder of Parquet files sorted by (group, pos)."""

    def __init__(self, spark, name: str):
        self.spark, self.path, self.kinds = spark, store.new_path(spark, name), {}

    def write(self, level: int, nodes: DataFrame) -> None:
        nodes.write.parquet(f"{self.path}/level={level}")
        self.kinds[level] = nodes.schema

    def read(self, level: int) -> DataFrame:
        return self.spark.read.schema(self.kinds[level]).parquet(f"{self.path}/level={level}")

    @property
    def height(self) -> int:
        return max(self.kinds)


def _parents(nodes: DataFrame) -> DataFrame:
    """H of each run of FAN nodes; a group with one node only has no parent."""
    child = [F.max(F.when(F.col("pos") % FAN == k, F.col("node"))).alias(f"c{k}") for k in range(FAN)]
    runs = nodes.groupBy("grp", F.shiftright("pos", FAN_BITS).alias("run")).agg(*child, F.first("n").alias("n"))
    h = F.sha2(F.concat(*[F.coalesce(f"c{k}", F.lit("")) for k in range(FAN)]), 256)
    return runs.select("grp", F.col("run").alias("pos"), h.alias("node"), F.shiftright(F.col("n") + (FAN - 1), FAN_BITS).alias("n"))


def built(ordered: DataFrame, totals: DataFrame, name: str) -> NodeStore:
    """The node store over ``ordered`` (grp, pos, node); ``totals`` are the leaves (grp, n) of each group.

    Each row of a level also states ``n``, the nodes that its group has on that level.
    """
    nodes = NodeStore(ordered.sparkSession, name)
    most = totals.agg(F.max("n")).first()[0] or 0
    counts = store.hinted(totals.select(F.col("grp").alias("_grp"), "n"))
    first = ordered.join(counts, ordered["grp"].eqNullSafe(counts["_grp"])).drop("_grp")
    nodes.write(0, first)
    level = 0
    while most > 1:
        above = _parents(nodes.read(level).where("n > 1"))
        # runs are named in the order of the level below: coordinates stay sorted in every file
        nodes.write(level + 1, above.repartitionByRange(F.col("grp").asc_nulls_first(), "pos").sortWithinPartitions(F.col("grp").asc_nulls_first(), "pos"))
        level, most = level + 1, -(-most // FAN)
    return nodes


def _roots(nodes: NodeStore) -> DataFrame:
    """(grp, node) of the node that remains in each group."""
    out = None
    for level in range(nodes.height + 1):
        one = nodes.read(level).where("n = 1").select("grp", "node")
        out = one if out is None else out.unionByName(one)
    return out


def _runs(nodes: NodeStore, level: int) -> DataFrame:
    """(grp, run, siblings): the digests of each run of a level, in order; what remains alone is not in a run."""
    d = nodes.read(level).where("n > 1").groupBy("grp", F.shiftright("pos", FAN_BITS).alias("run"))
    return d.agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "node"))), lambda x: x["node"]).alias("siblings"))


def _above(blocks: DataFrame, nodes: NodeStore, start: int) -> DataFrame:
    """``blocks`` (grp, block) with ``path``: for each level from ``start`` up the place in its run and the run's digests."""
    keep = blocks.columns
    d = blocks.withColumn("path", F.expr("cast(array() as array<struct<place:int,siblings:array<string>>>)"))
    for level in range(start, nodes.height):
        runs = store.saved(_runs(nodes, level), "runs").select(F.col("grp").alias("_grp"), F.col("run").alias("_run"), "siblings")
        runs = F.broadcast(runs) if runs.count() <= BROADCAST_RUNS else runs
        at = F.shiftright("block", FAN_BITS * (level - start))
        d = d.withColumn("_at", at)
        d = d.join(runs, d["grp"].eqNullSafe(runs["_grp"]) & (F.shiftright("_at", FAN_BITS) == runs["_run"]), "left")
        step = F.struct((F.col("_at") % FAN).cast("int").alias("place"), "siblings")
        d = d.select(*keep, F.when(F.col("siblings").isNull(), F.col("path")).otherwise(F.concat("path", F.array(step))).alias("path"))
    return d


def _h(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


class _Block:
    """What a task keeps of one block: its inner nodes, the path above it, and the roots of its group."""

    def __init__(self, key, n: int, path: list, subroot: bytes, root: bytes):
        self.key, self.n, self.subroot, self.root, self.inner = key, n, subroot, root, {}
        digests = [(p["place"], [d.encode() for d in p["siblings"]]) for p in path]
        self.path = [(b"".join(d[:k]), b"".join(d[k + 1 :])) for k, d in digests]

    def _steps(self, run: int) -> list[tuple[bytes, bytes]]:
        """(siblings on the left, on the right) of the node over leaf run ``run``, level by level to the root."""
        out, at, left = [], run, -(-self.n // FAN)
        for level in range(1, BLOCK):
            if left <= 1:
                break
            place, first = at % FAN, at - at % FAN
            own = [self.inner.get((level, p), b"") for p in range(first, first + FAN)]
            out.append((b"".join(own[:place]), b"".join(own[place + 1 :])))
            at, left = at >> FAN_BITS, -(-left // FAN)
        return out + self.path

    def proofs(self, run: int, rows: list) -> Iterator[tuple]:
        """The results for one run of leaves (doc_id, leaf, altered), in order."""
        own, steps, plain = [r[1] for r in rows], self._steps(run), None
        higher = b"".join(a + b for a, b in steps)

        def folded(k: int, leaf: bytes) -> bytes:
            at = _h(*own[:k], leaf, *own[k + 1 :]) if self.n > 1 else leaf
            for left, right in steps:
                at = _h(left, at, right)
            return at

        for k, (doc, leaf, altered) in enumerate(rows):
            if altered is None:
                root = plain = plain or folded(k, leaf)
            else:
                root = folded(k, altered)
            yield doc, leaf, self.subroot, self.root, _h(*own[:k], *own[k + 1 :], higher), root, root == self.root


def _merged(batches: Iterator) -> Iterator:
    """Merge of the sorted scans: a block's head, its inner nodes from the top down, its leaves by place."""
    import pyarrow as pa

    names = [f.split()[0] for f in _PROOF.split(", ")]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]

    def batch_of(rows):
        cols = list(zip(*rows)) or [()] * len(names)
        text = [[x.decode() for x in c] if t == pa.string() else c for c, t in zip(cols, kinds)]
        return pa.record_batch([pa.array(c, t) for c, t in zip(text, kinds)], names=names)

    block, run, held = None, None, []
    for batch in batches:
        out = []
        cols = [batch.column(c).to_pylist() for c in ("grp", "block", "level", "pos", "node", "altered", "doc_id", "n", "path", "subroot", "root")]
        for grp, number, level, pos, node, altered, doc, n, path, subroot, root in zip(*cols):
            if held and (level or pos >> FAN_BITS != run):
                out += block.proofs(run, held)
                held = []
            if level == BLOCK:
                block = _Block((grp, number), n, path, subroot.encode(), root.encode())
            elif level:
                block.inner[level, pos] = node.encode()
            else:
                run = pos >> FAN_BITS
                held.append((doc, node.encode(), altered.encode() if altered is not None else None))
        yield batch_of(out)
    if held:
        yield batch_of(list(block.proofs(run, held)))


def manifest(docs: DataFrame, name: str = "manifest") -> tuple[NodeStore, NodeStore, DataFrame]:
    """(the store of the languages' trees, the store over their roots, (grp, n, subroot, root, path) of each language)."""
    return _manifest(store.saved(leaves(docs).select(F.col("lang").alias("grp"), "doc_id", F.col("leaf").alias("node"), "altered"), f"{name}-leaves"), name)


def _manifest(own: DataFrame, name: str) -> tuple[NodeStore, NodeStore, DataFrame]:
    ordered, totals = ordering.numbered(own, "grp", [F.col("doc_id").asc_nulls_first(), F.col("node").asc()], f"{name}-runs")
    tree = built(ordered, totals, f"{name}-nodes")
    subroots = store.saved(_roots(tree).select(F.lit(0).alias("grp"), F.col("grp").alias("lang"), "node"), f"{name}-subroots")
    ranked, one = ordering.numbered(subroots, "grp", [F.col("lang").asc_nulls_first()], f"{name}-ranked")
    top = built(ranked, one, f"{name}-top")
    root = _roots(top).select("grp", F.col("node").alias("root"))
    langs = top.read(0).select("grp", F.col("pos").alias("block"), "lang", F.col("node").alias("subroot"))
    paths = _above(langs, top, 0).join(root, "grp")
    sizes = totals.select(F.col("grp").alias("_grp"), "n")
    known = paths.join(sizes, paths["lang"].eqNullSafe(sizes["_grp"])).select(F.col("lang").alias("grp"), "n", "subroot", "root", "path")
    return tree, top, store.saved(known, f"{name}-langs")


def proofs(docs: DataFrame, changed: Column | None = None, name: str = "manifest") -> DataFrame:
    """A row per row of ``docs``: its leaf, roots and hashed proof, and the root to which its leaf folds with ``changed`` as text."""
    own = leaves(docs, changed).select(F.col("lang").alias("grp"), "doc_id", F.col("leaf").alias("node"), "altered")
    tree, _, langs = _manifest(store.saved(own, f"{name}-leaves"), name)
    few = store.hinted(langs).select(F.col("grp").alias("_lang"), F.col("n").alias("_n"), "subroot", "root", F.col("path").alias("_top"))
    blocks = tree.read(0).where(F.col("pos") % (FAN ** BLOCK) == 0).select("grp", F.shiftright("pos", FAN_BITS * BLOCK).alias("block"))
    above = _above(blocks, tree, BLOCK)
    heads = above.join(few, above["grp"].eqNullSafe(few["_lang"])).select(
        "grp", "block", F.lit(BLOCK).alias("level"), F.lit(0).cast("long").alias("pos"), F.col("_n").alias("n"),
        F.concat("path", "_top").alias("path"), "subroot", "root")
    rows = heads
    for level in range(min(BLOCK, tree.height + 1)):
        nodes = tree.read(level).select("grp", F.shiftright("pos", FAN_BITS * (BLOCK - level)).alias("block"), F.lit(level).alias("level"),
                                        "pos", "node", *(["altered", "doc_id"] if level == 0 else []))
        rows = rows.unionByName(nodes, allowMissingColumns=True)
    dealt = rows.repartition("grp", "block").sortWithinPartitions("grp", "block", F.desc("level"), "pos")
    return dealt.mapInArrow(_merged, _PROOF)
