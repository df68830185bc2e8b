"""Linkage, incidents and book-keeping against plain versions on small tables."""

import collections
import datetime as dt
import gzip
import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import text as T
from tidewatch.operators import export, gates, incidents, joins, ledger, linkage, matching, stats

D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)


def clusters_of(spark, rows, review=0.5, size=10):
    scores = spark.createDataFrame(rows, "a long, b long, p double, band string, cannot array<string>")
    ids = sorted({i for r in rows for i in r[:2]})
    got, notes = matching.clusters_noted(scores, spark.createDataFrame([(i, D(-i)) for i in ids], "id long, pub date"), review, size)
    groups = collections.defaultdict(set)
    for r in got.collect():
        groups[r["cluster"]].add(r["id"])
    return sorted(map(sorted, groups.values())), {(r["a"], r["b"]): r["note"] for r in notes.collect()}, dict(groups)


def test_clusters_complete_linkage_bars_and_caps(spark):
    auto = lambda a, b, p=0.97: (a, b, p, "auto", [])
    got, notes, named = clusters_of(spark, [auto(1, 2), auto(2, 3), (1, 3, 0.6, "review", []), auto(3, 4), (1, 4, 0.1, "none", []), (2, 4, 0.7, "review", [])])
    assert got == [[1, 2, 3], [4]] and notes == {(3, 4): "complete_linkage"} and set(named) == {3, 4}  # 3 is published first
    got, notes, _ = clusters_of(spark, [auto(1, 2), auto(2, 3, 0.96), (1, 3, 0.9, "review", ["domain_differs"])])
    # 2 reaches review level in the rival of 3, which a barred pair keeps apart: it leaves
    assert got == [[1], [2], [3]] and notes[2, 3] == "ambiguous" or notes[2, 3] == "barred"
    pairs = [auto(a, b, 0.999 - (a + b) / 1000) for a, b in itertools.combinations(range(1, 6), 2)]
    got, notes, _ = clusters_of(spark, pairs, size=3)
    assert max(map(len, got)) <= 3 and "cluster_size_cap" in notes.values()
    assert all(len(g) == 1 for g in got if 5 in g)


def test_decisions(spark):
    s = spark.createDataFrame([(1, 2, "auto", []), (1, 3, "auto", []), (2, 3, "review", []), (1, 4, "none", []), (2, 4, "auto", ["country_differs"])], "a long, b long, band string, cannot array<string>")
    notes = spark.createDataFrame([(1, 3, "complete_linkage")], "a long, b long, note string")
    got = {(r["a"], r["b"]): r["decision"] for r in matching.decided(s, notes).collect()}
    assert got == {(1, 2): "auto_link", (1, 3): "review_pending", (2, 3): "review_pending", (1, 4): "none", (2, 4): "cannot_link"}


def test_em_tells_matches_from_others(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(4000):
        match = rng.random() < 0.2
        pick = lambda f: matching.LEVELS[f][0 if rng.random() < (0.9 if match else 0.1) else -1]  # noqa: E731, B023
        rows.append((*[pick(f) for f in matching.LEVELS], 1))
    df = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in matching.LEVELS) + ", n long")
    got = {(r["feature"], r["level"]): (r["m"], r["u"]) for r in matching.level_em(df).collect()}
    for f, levels in matching.LEVELS.items():
        assert got[f, levels[0]][0] > 0.8 and got[f, levels[0]][1] < 0.2


def test_incidents_as_plain_fold(spark):
    rng = random.Random(4)
    rows = []
    for k in range(400):
        pub = rng.randrange(900)
        rows.append((k, rng.randrange(12), rng.random() < 0.4, D(pub - rng.randrange(40)) if rng.random() < 0.5 else None, D(pub)))
    want, known = {}, collections.defaultdict(dict)
    for row, org, hard, event, public in sorted(rows, key=lambda r: (r[1], r[4], r[0])):
        near, twin = None, None
        for i, (e, p) in known[org].items():
            if not (abs((e - event).days) <= 30 if e and event else abs((p - public).days) <= 90):
                continue
            if hard or (e and event and e == event):
                near = i
                break
            twin = twin or (i,)
        if near is None:
            known[org][row] = (event, public)
            want[row] = (row, twin and twin[0])
        else:
            e, p = known[org][near]
            known[org][near] = (e or event, min(p, public))
            want[row] = (near, None)
    df = spark.createDataFrame(rows, "row long, org long, hard boolean, event date, public date").repartition(3)
    got = {r["row"]: (r["incident"], r["duplicate_of"]) for r in incidents.identified(df).collect()}
    assert got == want and len({v for v, _ in got.values()}) < 390


def test_names_alike_in_columns_and_python(spark):
    names = ["ACME, Inc.", "The Smith & Sons Co. Ltd", "US Holdings Group", "Bank of America Services", "Co", "A/S Nordic", "L.L.C. Partners", "x  y--z"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("n", T.plain_name(F.col("n")).alias("p"), T.link_key(T.plain_name(F.col("n"))).alias("k")).collect()
    for r in rows:
        assert r["p"] == T.normal_name(r["n"]), r
    keys = {r["n"]: r["k"] for r in rows}
    assert keys["Bank of America Services"] == "bank" and keys["US Holdings Group"] == "us holdings group" and keys["ACME, Inc."] == "acme"


def test_trigram_pairs_as_all_pairs(spark):
    rng = random.Random(7)
    names = sorted({"".join(rng.choices("abcd", k=rng.randrange(2, 9))) for _ in range(120)})
    grams = lambda s: {s[i:i + 3] for i in range(len(s) - 2)} if len(s) >= 3 else {s}
    want = {(a, b) for a, b in itertools.combinations(names, 2) if len(grams(a) & grams(b)) >= 0.5 * len(grams(a) | grams(b))}
    got = linkage.trigram_pairs(spark.createDataFrame([(n,) for n in names], "n string"), "n", 0.5).collect()
    assert {(r["t"], r["u"]) for r in got} == want and len(got) == len(want) > 10


def test_lookups_as_scans(spark):
    rng = random.Random(8)
    points = [(k, rng.randrange(300) if k else None) for k in range(200)]
    prefixes = []
    for k in range(60):
        size = 2 ** rng.randrange(6)
        lo = rng.randrange(256) // size * size
        prefixes.append((lo, lo + size - 1, k))
    got = joins.prefix_lookup(spark.createDataFrame(points, "id long, ip long"), spark.createDataFrame(prefixes, "lo long, hi long, name long"), "ip", "lo", "hi", [F.col("hi") - F.col("lo"), F.col("name")])
    want = {k: min(((hi - lo, n) for lo, hi, n in prefixes if ip is not None and lo <= ip <= hi), default=(0, None))[1] for k, ip in points}
    assert {r["id"]: r["name"] for r in got.collect()} == want
    with pytest.raises(ValueError):
        joins.prefix_lookup(got.select("ip"), spark.createDataFrame([(0, 2, 1)], "lo long, hi long, name long"), "ip", "lo", "hi", [F.col("name")])
    rates = [("x", D(n), float(n)) for n in (0, 3, 20)] + [("y", D(5), 50.0)]
    asks = [(k, c, D(n)) for k, (c, n) in enumerate([("x", 0), ("x", 2), ("x", 12), ("x", 13), ("y", 4), ("y", 14), ("y", 15), ("z", 1), (None, 3)])]
    out = joins.asof_backward(spark.createDataFrame(asks, "id long, c string, d date"), spark.createDataFrame(rates, "c string, d date, rate double"), ["c"], "d", "rate", 9)
    assert {r["id"]: r["rate"] for r in out.collect()} == {0: 0.0, 1: 0.0, 2: 3.0, 3: None, 4: None, 5: 50.0, 6: None, 7: None, 8: None}


def test_prefix_rule_in_ranges(spark):
    rng = random.Random(9)
    rows = [(k, "ab"[k % 2], rng.choice([round(rng.random(), 3), 0.5, 1.0])) for k in range(300)]
    got = {r["id"]: r["selected"] for r in stats.fdr_prefix(spark.createDataFrame(rows, "id long, g string, p double"), "p", ["g"], "id", 0.2, buckets=16).collect()}
    for g in "ab":
        order = sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0]))
        best, total = 0, 0.0
        for n, r in enumerate(order, 1):
            total += 1 - r[2]
            best = n if total / n <= 0.2 else best
        assert [got[r[0]] for r in order] == [n < best for n in range(len(order))]


def test_ledger_cases(spark):
    runs = spark.createDataFrame([("a", D(0), True), ("a", D(1), False), ("a", D(2), False), ("b", D(0), False), ("c", D(4), True)], "source string, day date, ok boolean")
    got = {r["source"]: (r["last_run"], r["last_success"], r["failures"]) for r in ledger.source_state(runs, "source", "day", "ok").collect()}
    assert got == {"a": (D(2), D(0), 2), "b": (D(0), None, 1), "c": (D(4), D(4), 0)}
    windows = runs.withColumn("hi", F.date_add("day", 1))
    assert {r["source"]: r["resume_at"] for r in ledger.resume_points(windows, "source", "day", "hi", "ok").collect()} == {"a": D(1), "b": D(0), "c": D(5)}
    latest, batch = spark.createDataFrame([(1, "x"), (2, "y")], "k long, h string"), spark.createDataFrame([(1, "x"), (2, "z"), (3, "n"), (4, None)], "k long, h string")
    assert {r["k"]: r["outcome"] for r in ledger.append_capped(latest, batch, "k", "h", 2).collect()} == {2: "appended", 3: "appended", 4: "deferred"}


def test_export_is_the_same_bytes_twice(spark, tmp_path):
    df = spark.createDataFrame([(k, f"v{k % 7}", None if k % 5 else 1.5) for k in range(500)], "k long, v string, x double").repartition(4)
    digests = []
    for name in ("one", "two"):
        m = export.exported({"t": (df.repartition(3), ["k"])}, f"{tmp_path}/{name}", "2024-01-01", {"t": "2"}).collect()
        parts = sorted((tmp_path / name / "t").glob("part-*.csv.gz"))
        text = [gzip.decompress(p.read_bytes()).decode().splitlines() for p in parts]
        assert [int(x.split(",")[0]) for t in text for x in t[1:]] == list(range(500)) and m[0]["rows"] == 500
        digests.append((m[0]["digest"], [p.read_bytes() for p in parts]))
        assert json.loads(m[0]["methods"]) == {"t": "2"}
    assert digests[0] == digests[1]
    with pytest.raises(gates.GateFailed, match="key is unique"):
        export.exported({"t": (df.unionByName(df.limit(1)), ["k"])}, f"{tmp_path}/three", "2024-01-01", {})
    assert not (tmp_path / "three").exists()


def test_jaro_winkler_of_known_pairs():
    for a, b, want in (("dwayne", "duane", 0.84), ("dixon", "dicksonx", 0.813333), ("martha", "marhta", 0.961111), ("jones", "johnson", 0.832381), ("abc", "xyz", 0.0)):
        assert abs(T.jaro_winkler(a, b) - want) < 1e-5 and T.jaro_winkler(a, b) == T.jaro_winkler(b, a)


def plain_clusters(pairs, every, review, size):
    """Complete linkage with every pair known beforehand."""
    band = {(a, b): x for a, b, _, x, _ in pairs}
    group = {k: frozenset([k]) for e in every for k in e}
    key = lambda x, y: (min(x, y), max(x, y))
    bad = lambda g, h: any(every[key(x, y)][1] for x in g for y in h)
    ok = lambda g, h: not bad(g, h) and all(every[key(x, y)][0] >= review for x in g for y in h)
    over = set()
    for a, b in sorted((e for e in band if band[e] == "auto" and not every[e][1]), key=lambda e: (-every[e][0], e)):
        g, h = group[a], group[b]
        if g == h:
            continue
        if len(g) + len(h) > size:
            over |= min(g, h, key=lambda s: (len(s), min(s)))
        elif ok(g, h):
            for x in g | h:
                group[x] = g | h

    def leave(x):
        rest = group[x] - {x}
        group.update({y: rest for y in rest})
        group[x] = frozenset([x])

    for x in sorted(over):
        if len(group[x]) > 1:
            leave(x)
    near = {x: {y for y in group if key(x, y) in band and every[key(x, y)][0] >= review and not every[key(x, y)][1]} for x in group}
    for _ in range(10):
        before = dict(group)
        for x in sorted(group):
            if len(group[x]) > 1 and any(bad(group[x], group[y]) for y in near[x] if group[y] != group[x]):
                leave(x)
        if before == group:
            break
    return {frozenset(g) for g in group.values()}


def test_pairs_outside_blocks_are_scored_on_demand(spark):
    rng = random.Random(21)
    every, pairs = {}, []
    for c in range(40):
        ids = range(10 * c, 10 * c + rng.randrange(2, 10))
        for a, b in itertools.combinations(ids, 2):
            p = rng.choice([0.2, 0.6, 0.97, 0.98, 0.99, 0.999])
            every[a, b] = (p, rng.random() < 0.04)
            if rng.random() < 0.5:
                pairs.append((a, b, p, "auto" if p >= 0.95 else "review" if p >= 0.5 else "none", ["domain_differs"] if every[a, b][1] else []))
    scores = spark.createDataFrame(pairs, "a long, b long, p double, band string, cannot array<string>")
    ids = sorted({k for e in every for k in e})
    published = spark.createDataFrame([(i, D(i % 7)) for i in [*ids, 9999]], "id long, pub date")
    table = spark.createDataFrame([(a, b, p, ["x"] if bar else []) for (a, b), (p, bar) in every.items()], "a long, b long, p double, cannot array<string>")
    asked = []

    def score(d):
        asked.append(d.count())
        return d.join(table, ["a", "b"])

    got, _ = matching.clusters_noted(scores, published, 0.5, 6, score)
    groups = collections.defaultdict(set)
    for r in got.collect():
        groups[r["cluster"]].add(r["id"])
    want = plain_clusters(pairs, every, 0.5, 6)
    assert {frozenset(g) for g in groups.values()} == want | {frozenset([9999])}
    assert sum(asked) > 20 and len(asked) >= 2
    strict, _ = matching.clusters_noted(scores, published, 0.5, 6)
    assert len({r["cluster"] for r in strict.collect()}) > len(groups)  # without scores on demand fewer merge


def test_random_pairs_grow_with_the_records(spark):
    pairs = lambda n: matching.random_pairs(spark.range(n).select(F.col("id").alias("iid")), 8, "u").count()
    few, many = pairs(1_500), pairs(15_000)
    assert 8 < many / few < 12 and 6 * 15_000 < many < 10 * 15_000
