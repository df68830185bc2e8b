"""Mixing sources to target weights, in DataFrame functions only.

The corpus is a tree: domain, language, source. A node's weight is shared out from its parent's
budget in proportion to the weights of the children; a child never gets more than its tokens times
``max_epochs``. What a child can't take goes to its siblings, in proportion again, and only what a
whole subtree can't take reaches the ancestors' other children: each level fills its children
to a common level of budget per weight, capped by what they hold. All amounts are whole tokens;
shares are rounded down, so at most one token a node stays unspent.

A leaf whose budget is e epochs and r tokens takes all its documents e times and a prefix of r
tokens of one more epoch, in the order of a hash seeded with the epoch. The prefix is found without
sorting a leaf: tokens are summed per hash bucket, buckets before the cut are taken whole,
buckets after it not at all, and only the one bucket with the cut is ordered by hash. The last
document is cut to the tokens that are left.

Tables of the tree have a row per node; documents meet them by a join on the leaf. A level is filled over the distinct
pairs of capacity and weight under a parent, not over its nodes, so hosts by the million don't sort in one task. Buckets
per leaf: 4,096, so a leaf of a third of 10**10 documents orders under 10**6 rows.

Weights are a table (domain, lang, source, weight) of whole numbers: null source and language for a domain's own weight,
null source for a language's within its domain. Nodes that it doesn't name have the weight 1. Without a table English weighs 4
and all else 1.

Defined cases: texts without tokens (null ones too) add nothing and are in no mixture; null language or source is a leaf of its
own; a null id is drawn by its text; leaves without tokens or weight get nothing; rows that repeat are drawn one by one, in any
order among equals; very long texts are cut only where the budget ends; an empty table gives an empty result; other columns are ignored by
``budgeted`` and kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm import store
from tidewatch.llm.quality import words_of

LEVELS = ("domain", "lang", "source")
SEED = 17


def domain_of(source: Column) -> Column:
    """The domain of a source: the remainder of its trailing number by four, else 'other'."""
    n = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    return F.when(n == "", "other").otherwise(F.concat(F.lit("domain"), (n.cast("int") % 4).cast("string")))


def _weighted(nodes: DataFrame, names: list[str], weights: DataFrame | None) -> DataFrame:
    """``nodes`` with the target weight of each among its siblings, before shortages."""
    if weights is None:
        return nodes.withColumn("weight", (F.when(F.col("lang") == "en", 4).otherwise(1) if names[-1] == "lang" else F.lit(1)).cast("long"))
    own = weights.where(" and ".join([f"{c} is not null" for c in names] + [f"{c} is null" for c in LEVELS[len(names):]]))
    own = own.groupBy(*names).agg(F.max("weight").cast("long").alias("weight"))
    return nodes.join(store.hinted(own), names, "left").withColumn("weight", F.greatest(F.coalesce("weight", F.lit(1)), F.lit(0)))


def _filled(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """``nodes`` (budget of the parent as ``budget``; cap, weight above 0) with ``got``.

    Sizes sorted by cap per weight: children of a size are full if filling all up to their own level
    costs no more than the budget; the others share what the full ones leave.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(1))
    upto = by.orderBy(F.col("cap") / F.col("weight"), "cap").rowsBetween(Window.unboundedPreceding, 0)
    d = (
        nodes.groupBy(*parent, "budget", "cap", "weight").agg(F.count("*").alias("m"))
        .withColumn("c_upto", F.sum(F.col("cap") * F.col("m")).over(upto)).withColumn("w_upto", F.sum(F.col("weight") * F.col("m")).over(upto))
        .withColumn("w_all", F.sum(F.col("weight") * F.col("m")).over(by))
    )
    big = "decimal(38,0)"
    level = F.col("c_upto").cast(big) * F.col("weight") + F.col("cap").cast(big) * (F.col("w_all") - F.col("w_upto"))
    d = d.withColumn("full", level <= F.col("budget").cast(big) * F.col("weight"))
    d = (
        d.withColumn("c_full", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap") * F.col("m"))).over(by), F.lit(0)))
        .withColumn("w_open", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight") * F.col("m"))).over(by), F.lit(0)))
    )
    share = F.expr("cast(floor((cast(budget - c_full as decimal(28,0)) * cast(weight as decimal(10,0))) div greatest(w_open, 1)) as bigint)")
    sizes = d.withColumn("got", F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", share))).select(*parent, "cap", "weight", "got")
    return nodes.join(sizes, [*parent, "cap", "weight"])


def leaf_budgets(leaves: DataFrame, budget_percent: int, max_epochs: int, weights: DataFrame | None = None) -> DataFrame:
    """(domain, lang, source, tokens, got) for ``leaves`` (domain, lang, source, tokens)."""
    d = leaves.where("tokens > 0").withColumn("cap", F.col("tokens") * max_epochs)
    total = d.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * budget_percent / 100).cast("long").alias("budget"))
    above = None
    for k in range(len(LEVELS)):
        names = list(LEVELS[: k + 1])
        nodes = _weighted(d.groupBy(*names).agg(F.sum("cap").alias("cap")), names, weights).where("weight > 0")
        nodes = nodes.crossJoin(F.broadcast(total)) if above is None else nodes.join(above, names[:-1])
        above = _filled(nodes, names[:-1]).select(*names, F.col("got").alias("budget"))
    return d.join(above, list(LEVELS)).select(*LEVELS, "tokens", F.col("budget").alias("got"))


def _leafed(docs: DataFrame) -> DataFrame:
    return (
        docs.withColumn("_lang", F.coalesce("lang", F.lit(""))).withColumn("_source", F.coalesce("source", F.lit("")))
        .withColumn("_domain", domain_of(F.col("_source")))
        .withColumn("_id", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce("text", F.lit(""))))))
        .withColumn("_tokens", F.size(words_of(F.coalesce("text", F.lit("")))).cast("long"))
    )


def _drawn(docs: DataFrame, budget_percent: int, max_epochs: int, seed: int, weights: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(token rows, one row per leaf: epochs, tail, the hash bucket with the cut, tokens before it)."""
    rows = store.saved(_leafed(docs.select("doc_id", "text", "lang", "source")).drop("text", "lang", "source"), "tokens")
    named = [F.col(f"_{c}").alias(c) for c in LEVELS]
    leaves = rows.groupBy(*named).agg(F.sum("_tokens").alias("tokens"))
    spent = leaf_budgets(leaves, budget_percent, max_epochs, weights).select(
        *[F.col(c).alias(f"_{c}") for c in LEVELS], F.expr("got div tokens").alias("_epochs"), F.expr("got % tokens").alias("_tail"))
    spent = store.saved(spent, "budgets")
    nodes = spent.count()
    leaf = [f"_{c}" for c in LEVELS]
    sums = (
        _hashed(rows.join(store.hinted(spent, nodes), leaf), seed).where("_tail > 0")
        .groupBy(*leaf, "_bucket").agg(F.sum("_tokens").alias("t"), F.first("_tail").alias("tail"))
    )
    upto = Window.partitionBy(*leaf).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        sums.withColumn("upto", F.sum("t").over(upto)).where("upto > tail")
        .groupBy(*leaf).agg(F.min(F.struct("_bucket", (F.col("upto") - F.col("t")).alias("before"))).alias("c"))
        .select(*leaf, F.col("c._bucket").alias("_cut"), F.col("c.before").alias("_before"))
    )
    return rows, store.saved(spent.join(cut, leaf, "left"), "draw")


def _hashed(d: DataFrame, seed: int) -> DataFrame:
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_epochs").cast("string"), "_id"))
    return d.withColumn("_h", h).withColumn("_bucket", F.substring("_h", 1, 3))


def _given(d: DataFrame, draw: DataFrame, seed: int) -> DataFrame:
    """``d`` with ``_full`` and ``_part``; only rows of the buckets with a cut are shuffled."""
    leaf = [f"_{c}" for c in LEVELS]
    d = _hashed(d.join(store.hinted(draw), leaf, "left"), seed).withColumn("_full", F.coalesce("_epochs", F.lit(0)).cast("long"))
    cuts = F.coalesce((F.col("_tail") > 0) & (F.col("_bucket") == F.col("_cut")), F.lit(False))
    before = F.coalesce((F.col("_tail") > 0) & (F.col("_bucket") < F.col("_cut")), F.lit(False))
    within = Window.partitionBy(*leaf).orderBy("_h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("_tail") - F.col("_before") - F.coalesce(F.sum("_tokens").over(within), F.lit(0))
    whole = d.where(~cuts).withColumn("_part", F.when(before, F.col("_tokens")).otherwise(0).cast("long"))
    return whole.unionByName(d.where(cuts).withColumn("_part", F.greatest(F.lit(0), F.least("_tokens", room)).cast("long")))


def budgeted(docs: DataFrame, budget_percent: int = 80, max_epochs: int = 2, seed: int = SEED,
             weights: DataFrame | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang, source): its leaf and what it gives.

    (doc_id, domain, lang, source, n_tokens, full_epochs, tail_tokens): the row is taken
    ``full_epochs`` times whole and then once more with its first ``tail_tokens`` tokens.
    """
    rows, draw = _drawn(docs, budget_percent, max_epochs, seed, weights)
    return _given(rows, draw, seed).select(
        "doc_id", *[F.col(f"_{c}").alias(c) for c in LEVELS], F.col("_tokens").alias("n_tokens"),
        F.col("_full").alias("full_epochs"), F.col("_part").alias("tail_tokens"))


def mixed(docs: DataFrame, budget_percent: int = 80, max_epochs: int = 1, seed: int = SEED,
          weights: DataFrame | None = None) -> DataFrame:
    """The rows of the mixture with the columns of ``docs``: one per epoch, the cut one shortened."""
    _, draw = _drawn(docs, budget_percent, max_epochs, seed, weights)
    takes = F.concat(F.array_repeat("_tokens", F.col("_full").cast("int")),
                     F.when(F.col("_part") > 0, F.array("_part")).otherwise(F.array().cast("array<bigint>")))
    # the row travels as one struct, so no column of it can clash with a helper
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text", "lang", "source")
    d = _given(_leafed(rows), draw, seed).where("_tokens > 0").withColumn("_take", F.explode(takes))
    head = F.array_join(F.slice(
        F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0), F.lit(1), F.col("_take").cast("int")), "")
    clean = F.when(F.col("_take") < F.col("_tokens"), head).otherwise(F.col("text"))
    out = d.select(*[F.col("_row")[c].alias(c) if c != "text" else clean.alias("text") for c in docs.columns])
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
