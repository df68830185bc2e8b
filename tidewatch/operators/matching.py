"""Comparison of record pairs by feature levels: u from random pairs, weighted m, scores with caps, bands, decisions.

Pairs carry structs ``l`` and ``r`` of one record each: iid, org, nn (normal name), lk (link key), toks (its tokens),
domain, country, sector, people, ev (event day), pub (public day), cls (source class).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.graph import components
from tidewatch.operators.linkage import by_component
from tidewatch.operators.scratch import stored

#: The levels of each feature.
LEVELS = {
    "name": ("exact", "linkkey", "contain", "conflict", "single", "none"),
    "domain": ("equal", "missing", "different"),
    "event": ("d0", "d3", "d14", "d45", "d120", "gt120", "md_match_year_off", "missing"),
    "public": ("p14", "p45", "p120", "p365", "gt365"),
    "impossible": ("impossible", "ok", "na"),
    "source": ("diff_reg", "same_reg", "other"),
    "country": ("agree", "missing", "conflict"),
    "sector": ("agree", "missing", "differ"),
    "people": ("same", "other"),
}
#: Classes of source pairs; the event's levels are counted for each of them.
DATE_CLASSES = ("reg_reg", "reg_hibp", "reg_press", "press_press", "sec_any", "other")
CLASS_RANK = ("reg", "sec", "hibp", "press", "other")
CANNOT_DAYS = 180
#: Limits of the exact-name adjustment, pseudo-matches that pull m towards u.
TF_CLAMP, SMOOTH = (-6.0, 4.0), 4.0


#: What levels are counted by: a feature, or the event beside the class of the pair.
KEYS = {k: vs for f, vs in LEVELS.items() for k in ([f"event:{c}" for c in DATE_CLASSES] if f == "event" else [f])}


def date_class(a: Column, b: Column) -> Column:
    """The class of a pair of sources, the better one first; a filing of the second kind beside anything is sec_any."""
    rank = lambda c: F.array_position(F.array(*[F.lit(x) for x in CLASS_RANK]), c)
    both = F.when(rank(a) <= rank(b), F.concat_ws("_", a, b)).otherwise(F.concat_ws("_", b, a))
    return F.when((a == "sec") | (b == "sec"), "sec_any").when(both.isin(*DATE_CLASSES), both).otherwise("other")


def _key(feature: str) -> Column:
    return F.concat(F.lit("event:"), "date_class") if feature == "event" else F.lit(feature)


def _steps(days: Column, limits: list[tuple[int, str]], beyond: str) -> Column:
    out = F
    for limit, name in limits:
        out = out.when(days <= limit, name)
    return out.otherwise(beyond)


def compared(pairs: DataFrame) -> DataFrame:
    """``pairs`` (l, r) with a level column per feature, and ``cannot``, the reasons against any link."""
    l, r = (lambda c: F.col(f"l.{c}")), (lambda c: F.col(f"r.{c}"))
    common = F.array_intersect(l("toks"), r("toks"))
    small = F.least(F.size(l("toks")), F.size(r("toks")))
    name = (
        F.when(l("nn") == r("nn"), "exact").when(l("lk") == r("lk"), "linkkey").when((small >= 2) & (F.size(common) == small), "contain")
        .when((F.size(common) > 0) & (F.size(common) < small), "conflict").when(F.size(common) > 0, "single").otherwise("none"))
    gap = F.abs(F.datediff(l("ev"), r("ev")))
    year_off = (F.date_format(l("ev"), "MM-dd") == F.date_format(r("ev"), "MM-dd")) & (F.abs(F.year(l("ev")) - F.year(r("ev"))) == 1)
    event = F.when(gap.isNull(), "missing").when(year_off, "md_match_year_off").otherwise(
        _steps(gap, [(0, "d0"), (3, "d3"), (14, "d14"), (45, "d45"), (120, "d120")], "gt120"))
    public = _steps(F.abs(F.datediff(l("pub"), r("pub"))), [(14, "p14"), (45, "p45"), (120, "p120"), (365, "p365")], "gt365")
    late = F.coalesce(l("ev") > r("pub"), F.lit(False)) | F.coalesce(r("ev") > l("pub"), F.lit(False))
    reg = l("cls").isin("reg", "sec") & r("cls").isin("reg", "sec")
    three = lambda c, same, other: F.when(l(c).isNull() | r(c).isNull(), "missing").when(l(c) == r(c), same).otherwise(other)
    levels = {
        "name": name, "domain": three("domain", "equal", "different"), "event": event, "public": public,
        "impossible": F.when(l("ev").isNull() & r("ev").isNull(), "na").when(late, "impossible").otherwise("ok"),
        "source": F.when(reg & (l("cls") == r("cls")), "same_reg").when(reg, "diff_reg").otherwise("other"),
        "country": three("country", "agree", "conflict"), "sector": three("sector", "agree", "differ"),
        "people": F.when(l("people") == r("people"), "same").otherwise("other"),
    }
    out = pairs.select("*", *[c.alias(k) for k, c in levels.items()])
    reasons = F.array_compact(F.array(
        F.when(F.col("domain") == "different", "domain_differs"), F.when(F.col("name") == "conflict", "tokens_conflict"),
        F.when((gap > CANNOT_DAYS) & ~year_off, "event_dates_gt_180d"), F.when(F.col("country") == "conflict", "country_differs")))
    return out.withColumn("date_class", date_class(l("cls"), r("cls"))).withColumn("cannot", reasons)


def level_counts(pairs: DataFrame, weight: Column | None = None) -> DataFrame:
    """(feature, level, n, w, w2) over compared pairs: one pass, a row per level that occurs."""
    w = F.lit(1.0) if weight is None else weight
    stack = F.explode(F.array(*[F.struct(_key(f).alias("feature"), F.col(f).alias("level")) for f in LEVELS]))
    return pairs.select(w.alias("w"), stack.alias("x")).groupBy("x.feature", "x.level").agg(
        F.count("*").alias("n"), F.sum("w").alias("w"), F.sum(F.col("w") * F.col("w")).alias("w2"))


def _all_levels(spark) -> DataFrame:
    return spark.createDataFrame([(f, v, len(vs)) for f, vs in KEYS.items() for v in vs], "feature string, level string, levels int")


def packed(records: DataFrame) -> DataFrame:
    """Records for pairing: without what follows from the link key (its tokens, and the normal name where it is the same)."""
    return records.select("iid", "org", F.when(~F.col("nn").eqNullSafe(F.col("lk")), F.col("nn")).alias("nn"), "lk", "domain", "country", "sector", "people", "ev", "pub", "cls")


def unpacked(pairs: DataFrame) -> DataFrame:
    """Pairs (l, r) of :func:`packed` records as whole ones."""
    def side(x: str) -> Column:
        c = F.col(x)
        return F.struct(c["iid"].alias("iid"), c["org"].alias("org"), F.coalesce(c["nn"], c["lk"]).alias("nn"), c["lk"].alias("lk"), F.array_distinct(F.split(c["lk"], " ")).alias("toks"),
                        *[c[k].alias(k) for k in ("domain", "country", "sector", "people", "ev", "pub", "cls")]).alias(x)

    return pairs.select(side("l"), side("r"))


def short(pairs: DataFrame) -> DataFrame:
    """Compared pairs with what :func:`level_counts` and :func:`scored` need of their records: ids, the first name, two tokens."""
    side = lambda x, *more: F.struct(F.col(f"{x}.iid"), F.col(f"{x}.org"), F.slice(F.col(f"{x}.toks"), 1, 2).alias("toks"), *more).alias(x)
    return pairs.select(side("l", F.col("l.nn")), side("r"), *LEVELS, "date_class", "cannot")


#: Fixed value: dealt records per task.
DEALT = 200_000


def random_pairs(records: DataFrame, draws: int, seed: str) -> DataFrame:
    """(l, r): each record is dealt into ``draws`` hashed buckets; those that meet in one are uniformly random pairs.

    There is a bucket for every two records (they are counted once), so pairs are as many as records times draws at every size. Records are shuffled
    to their buckets, once for each draw; pairs are made there and not shuffled.
    """
    n = records.count()
    number = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.col("k").cast("string"), F.lit(":"), F.col("l.iid").cast("string"))), 1, 8), 16, 10).cast("long")
    dealt = records.select(F.struct(*records.columns).alias("l"), F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("k"))
    tasks = max(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n * draws // DEALT))
    dealt = dealt.select("l", (F.pmod(number, F.lit(max(1, -(-n // 2)))) * draws + F.col("k")).alias("slot")).repartition(tasks, "slot")
    # a bucket has two records on average
    met = dealt.groupBy("slot").agg(F.collect_list("l").alias("of")).where("size(of) > 1")
    pairs = F.flatten(F.transform("of", lambda x: F.transform(F.filter("of", lambda y: y["iid"] > x["iid"]), lambda y: F.struct(x.alias("l"), y.alias("r")))))
    return met.select(F.explode(pairs).alias("p")).select("p.l", "p.r")


def estimate_u(pairs: DataFrame) -> DataFrame:
    """(feature, level, u): shares of levels among random compared pairs, one pair added to each level."""
    n = _all_levels(pairs.sparkSession).join(level_counts(pairs), ["feature", "level"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = n.groupBy("feature").agg(F.sum("n").alias("t"))
    return n.join(total, "feature").select("feature", "level", ((F.col("n") + 1) / (F.col("t") + F.col("levels"))).alias("u"))


def estimate_m(matches: DataFrame, weight: Column, u: DataFrame) -> DataFrame:
    """(feature, level, m, u, bf): weighted shares among matches, pulled towards u by four pseudo-matches of the effective size."""
    c = level_counts(matches, weight)
    total = c.groupBy("feature").agg(F.sum("w").alias("tw"), F.sum("w2").alias("tw2")).withColumn("n_eff", F.col("tw") * F.col("tw") / F.col("tw2"))
    d = u.join(c.select("feature", "level", "w"), ["feature", "level"], "left").join(total, "feature", "left")
    share, n_eff = F.coalesce("w", F.lit(0.0)) / F.col("tw"), F.coalesce("n_eff", F.lit(0.0))
    m = (n_eff * F.coalesce(share, F.lit(0.0)) + SMOOTH * F.col("u")) / (n_eff + SMOOTH)
    return d.select("feature", "level", m.alias("m"), "u").withColumn("bf", F.log2(F.col("m") / F.col("u")))


def scored(pairs: DataFrame, model: DataFrame, name_share: DataFrame, prior: float, auto: float, review: float) -> DataFrame:
    """(a, b, weight, p, caps, band): sum of the levels' factors, the exact-name adjustment and the prior.

    ``name_share`` (nn, share): how often a name occurs among records; an exact match of a common name says less. Caps hold a
    pair at review: one-word names without a near event or equal domain, and undated pairs published far apart.
    """
    # a row per level: some dozens, whatever the number of pairs
    rows = {(r["feature"], r["level"]): r for r in model.collect()}
    table, u_exact = {k: r["bf"] for k, r in rows.items()}, rows["name", "exact"]["u"]
    w = F.lit(float(np.log2(prior / (1 - prior))))
    for f, levels in LEVELS.items():
        step = F
        for k in [k for k in KEYS if k.split(":")[0] == f]:
            for v in levels:
                step = step.when((F.col(f) == v) & (_key(f) == k), float(table[k, v]))
        w = w + step.otherwise(0.0)
    d = pairs.withColumn("nn", F.col("l.nn")).join(name_share, "nn", "left")
    tf = F.greatest(F.lit(TF_CLAMP[0]), F.least(F.lit(TF_CLAMP[1]), F.log2(F.lit(u_exact) / F.col("share"))))
    w = w + F.when(F.col("name") == "exact", F.coalesce(tf, F.lit(0.0))).otherwise(0.0)
    single = (F.size("l.toks") == 1) | (F.size("r.toks") == 1)
    caps = F.array_compact(F.array(
        F.when(single & ~F.col("event").isin("d0", "d3", "d14") & (F.col("domain") != "equal"), "single_token"),
        F.when((F.col("event") == "missing") & ~F.col("public").isin("p14", "p45"), "undated")))
    p = 1 / (1 + F.pow(F.lit(2.0), -F.col("weight")))
    d = d.select(F.col("l.iid").alias("a"), F.col("r.iid").alias("b"), w.alias("weight"), caps.alias("caps"), "cannot").withColumn("p", p)
    band = F.when((F.col("p") >= auto) & (F.size("caps") == 0), "auto").when(F.col("p") >= review, "review").otherwise("none")
    return d.withColumn("band", band)


def decided(scores: DataFrame, notes: DataFrame) -> DataFrame:
    """(a, b, decision): what is stored for a pair; an automatic edge that clustering refused waits for review."""
    d = scores.join(notes.select("a", "b", "note"), ["a", "b"], "left")
    decision = (
        F.when(F.size("cannot") > 0, "cannot_link").when((F.col("band") == "auto") & F.col("note").isNull(), "auto_link")
        .when(F.col("band").isin("auto", "review"), "review_pending").otherwise("none"))
    return d.select("a", "b", decision.alias("decision"))


def level_em(patterns: DataFrame, known_u: dict | None = None, rounds: int = 50, match: float = 0.1) -> DataFrame:
    """(feature, level, m, u) estimated without labels from counts of level patterns (features..., n).

    With ``known_u`` (by feature and level, as from random pairs) u stays as it is; else it is estimated as well. Patterns are summed up first: their number is bounded by the product of the levels, whatever the number of pairs.
    """
    names = list(LEVELS)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(names, ignore_index=True)
        n = pdf["n"].to_numpy(float)
        codes = {f: pd.Categorical(pdf[f], LEVELS[f]).codes for f in names}
        start = lambda vs: np.linspace(2, 1, len(vs)) / np.linspace(2, 1, len(vs)).sum()
        m, u, share = {f: start(LEVELS[f]) for f in names}, {f: start(LEVELS[f])[::-1] for f in names}, match
        if known_u:
            u = {f: np.array([known_u[f, v] for v in LEVELS[f]]) for f in names}
        for _ in range(rounds):
            log = np.log(share) - np.log(1 - share) + sum(np.log(m[f][codes[f]]) - np.log(u[f][codes[f]]) for f in names)
            post = 1 / (1 + np.exp(-np.clip(log, -500, 500)))
            share = float(np.clip((n @ post) / n.sum(), 1e-6, 1 - 1e-6))
            for f in names:
                for side, w in ((m, n * post), (u, n * (1 - post)))[: 1 if known_u else 2]:
                    c = np.bincount(codes[f], w, len(LEVELS[f])) + 1e-3
                    side[f] = c / c.sum()
        return pd.DataFrame([(f, v, m[f][k], u[f][k]) for f in names for k, v in enumerate(LEVELS[f])], columns=["feature", "level", "m", "u"])

    counts = patterns.groupBy(*names).agg(F.sum("n").alias("n"))
    return counts.groupBy(F.lit(0).alias("g")).applyInPandas(lambda pdf: fit(pdf[[*names, "n"]]), "feature string, level string, m double, u double")


def clusters_noted(scores: DataFrame, published: DataFrame, review: float, size: int = 10, score: Callable[[DataFrame], DataFrame] | None = None,
                   max_rounds: int = 40) -> tuple[DataFrame, DataFrame]:
    """((id, cluster), (a, b, note)): complete-linkage clusters over scored pairs (a, b, p, band, cannot).

    Automatic edges merge from the most probable down, if every pair across reaches ``review`` and none is barred. What
    would outgrow ``size`` leaves its smaller side for review; a member that also reaches review level in a rival
    cluster, one that a barred pair keeps apart, leaves too, until nobody leaves (ten passes at most). The name of a cluster is its
    earliest published member (``published``: id, pub; ids without a pair are clusters of their own). Notes tell why an automatic edge was not taken.

    A pair across that is in no block is scored on demand: a component that needs such pairs names those of all merges that can be
    tried by then, ``score`` ((a, b) to (a, b, p, cannot)) scores them for all components at once, and only these components are worked on
    again. Without ``score`` such a pair counts as 0. A component's pairs at review level are in one task, its clusters are at most ``size``.
    """
    scores = stored(scores)
    label = components(scores.where(F.col("p") >= review), "a", "b")
    at_b = label.select(F.col("id").alias("b"), F.col("component").alias("_cb"))
    days = published.select(F.col("id"), F.col("pub").cast("string").alias("pub"))
    work = stored(
        scores.select("a", "b", "p", "band", (F.size("cannot") > 0).alias("barred")).join(label.select(F.col("id").alias("a"), "component"), "a")
        .join(at_b, "b").where("component = _cb").drop("_cb")
        .join(days.select(F.col("id").alias("a"), F.col("pub").alias("pa")), "a").join(days.select(F.col("id").alias("b"), F.col("pub").alias("pb")), "b")
    )
    on_demand = score is not None

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        blocked = pdf["band"].notna().tolist()
        p = {(x, y): v for x, y, v in zip(pdf["a"], pdf["b"], pdf["p"])}
        barred = {(x, y) for x, y, v in zip(pdf["a"], pdf["b"], pdf["barred"]) if v}
        auto = sorted(((x, y) for x, y, v in zip(pdf["a"], pdf["b"], pdf["band"]) if v == "auto" and (x, y) not in barred), key=lambda e: (-p[e], e))
        pub = {k: v for k, v in [*zip(pdf["a"], pdf["pa"]), *zip(pdf["b"], pdf["pb"])] if v is not None}
        group = {x: {x} for x in pub}
        near: dict = {x: set() for x in pub}
        for (x, y), here in zip(zip(pdf["a"], pdf["b"]), blocked):
            if here and p[x, y] >= review and (x, y) not in barred:
                near[x].add(y)
                near[y].add(x)
        notes: dict = {}
        missing: set = set()
        pair = lambda x, y: (min(x, y), max(x, y))

        def against(one_, two_):
            cross = [pair(x, y) for x in one_ for y in two_]
            if any(c in barred for c in cross):
                return "barred"
            unknown = [c for c in cross if c not in p]
            if unknown and on_demand:
                missing.update(unknown)
                return "unknown"
            return "complete_linkage" if any(p.get(c, 0.0) < review for c in cross) else None

        def leave(x, note):
            rest = group[x] - {x}
            for y in rest:
                group[y] = rest
            group[x] = {x}
            for y in near[x]:
                if pair(x, y) in auto_set:
                    notes[pair(x, y)] = note

        auto_set, over, held = set(auto), set(), set()
        for x, y in auto:
            one_, two_ = group[x], group[y]
            if one_ is two_:
                continue
            if held & one_ or held & two_:
                held |= one_ | two_  # what comes after an open merge is open as well
                continue
            if len(one_) + len(two_) > size:
                notes[x, y] = "cluster_size_cap"
                over |= min(one_, two_, key=lambda s: (len(s), min(s)))
                continue
            why = against(one_, two_)
            if why == "unknown":
                held |= one_ | two_
            elif why:
                notes[x, y] = why
            else:
                both = one_ | two_
                for z in both:
                    group[z] = both
        if not held:
            for x in sorted(over):
                if len(group[x]) > 1:
                    leave(x, "cluster_size_cap")
            for _ in range(10):
                going = False
                for x in sorted(group):
                    rivals = {id(group[y]): group[y] for y in near[x] if group[y] is not group[x]} if len(group[x]) > 1 else {}
                    if any([against(group[x], g) == "barred" for g in rivals.values()]):
                        leave(x, "ambiguous")
                        going = True
                if not going or missing:
                    break
        if missing:
            rows = [(None, None, x, y, None, True) for x, y in sorted(missing)]
        else:
            rows = [(x, min(g, key=lambda z: (pub[z], z)), None, None, None, False) for x, g in group.items()]
            rows += [(None, None, x, y, n, False) for (x, y), n in notes.items()]
        out = pd.DataFrame(rows, columns=["id", "cluster", "a", "b", "note", "asked"], dtype=object)
        return out.assign(component=pdf["component"].iloc[0])

    done = None
    for _ in range(max_rounds):
        out = stored(by_component(work, one, "id long, cluster long, a long, b long, note string, asked boolean, component long"))
        settled = out.where("not asked")
        done = settled if done is None else done.unionByName(settled)
        asked = out.where("asked").select("a", "b", "component")
        if not on_demand or asked.isEmpty():
            break
        fresh = score(asked.select("a", "b")).select("a", "b", "p", F.lit(None).cast("string").alias("band"), (F.size("cannot") > 0).alias("barred"))
        none = F.lit(None).cast("string")
        again = work.join(asked.select("component").distinct(), "component", "left_semi")
        work = stored(again.unionByName(asked.join(fresh, ["a", "b"]).select(*[c for c in again.columns if c not in ("pa", "pb")], none.alias("pa"), none.alias("pb"))))
    else:
        raise RuntimeError("clusters did not settle")
    named = published.select("id").join(done.where("id is not null").select("id", "cluster"), "id", "left").select("id", F.coalesce("cluster", "id").alias("cluster"))
    return named, done.where("note is not null").select("a", "b", "note")
