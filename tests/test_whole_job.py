"""Queries that must take in every row: nothing is left out by date, id or place."""

import collections
import datetime as dt
import itertools
import random

from tidewatch import plans

Q = plans.queries()
ORDERS = "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate timestamp, o_orderstatus string, o_totalprice double"


def orders(spark, path, rows):
    """rows of (entry, customer, list, day)."""
    spark.createDataFrame([(e, c, p, dt.datetime.combine(d, dt.time()), "O", 100.0 + e % 7) for e, c, p, d in rows], ORDERS).write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_linkage_takes_all_dates_and_lists_dropped_blocks(spark, tmp_path):
    day = lambda n: dt.date(1998, 2, 1) + dt.timedelta(days=n)
    rows = [(k, k // 2, "1-URGENT", day(k % 2)) for k in range(20)] + [(100 + k, 99, "2-HIGH", day(k)) for k in range(30)]
    sf = orders(spark, tmp_path, rows)
    assert {tuple(r) for r in Q["blocked_pairs"](spark, sf).collect()} == {(2 * k, 2 * k + 1) for k in range(10)}
    assert {(r["rule"], r["block"], r["n"]) for r in Q["blocks_dropped"](spark, sf).collect()} == {
        ("pairs", "s|99|2-HIGH", 30), ("pairs", "q|99|1998-01-01", 30), ("weights", "99|1998-01-01", 30)}
    assert {r["level"] for r in Q["linkage_weights"](spark, sf).collect()} == {"near", "same"}
    assert {r["id"] for r in Q["linkage_clusters"](spark, sf).collect()} == set(range(20))


def test_rates_come_from_all_entries(spark, tmp_path):
    day = dt.date(1995, 5, 1)
    sf = orders(spark, tmp_path, [(1, 1, "1-URGENT", day), (3, 2, "1-URGENT", day), (8, 3, "2-HIGH", day), (9, 3, "5-LOW", day)])
    assert {r["entry"]: r["rate"] for r in Q["asof_rate"](spark, sf).collect()} == {1: 103.0, 3: 103.0, 8: 101.0, 9: 1.0}


def test_event_units_as_brute_force(spark, tmp_path):
    start, rng = dt.date(1995, 1, 31), random.Random(3)
    fixed = [(1, 0), (1, 80), (51, 1), (51, 40), (101, 500), (151, 590), (2, 0), (52, 20), (52, 5), (7, 9)]
    fixed += [(rng.choice((3, 53, 103, 153, 203)), rng.randrange(3000)) for _ in range(90)]
    sf = orders(spark, tmp_path, [(k, c, "1-URGENT", start + dt.timedelta(days=n)) for k, (c, n) in enumerate(fixed)])
    units, of = [], collections.defaultdict(set)
    for c, n in fixed:
        of[c].add(n)
    for c, ns in of.items():
        spans = []
        for n in sorted(ns):
            if spans and n - spans[-1][0] <= 90:
                spans[-1][1] = n
            else:
                spans.append([n, n])
        units += [(c * 1000 + k, c % 50, *s) for k, s in enumerate(spans, 1)]
    label = {u[0]: u[0] for u in units}
    for _ in units:
        for x, y in itertools.combinations(units, 2):
            if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3]:
                label[x[0]] = label[y[0]] = min(label[x[0]], label[y[0]])
    assert {r["id"]: r["component"] for r in Q["event_units"](spark, sf).collect()} == label
    assert label[51001] == 1001 and label[101001] == 101001 and len(set(label.values())) > 8
