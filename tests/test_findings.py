"""Cases that the findings of a review named: each would have failed before its change."""

import collections
import datetime as dt
import hashlib
import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewatch import plans
from tidewatch.functions import text as T
from tidewatch.operators import likeness, matching, runs
from tidewatch.operators import naming as N
from tidewatch.plans import incidents
from tidewatch.plans.matching import CLASSES

Q = plans.queries()


def test_jaro_winkler_as_the_sql_has_it():
    """three characters out of place are one transposition, and a common start counts above 0.7 only."""
    rng, words = random.Random(7), {"vcfgcff", "vcgcff", "vcaede", "vceda", "vgdhaj", "vhdhab"}
    while len(words) < 300:
        words.add("v" + "".join(rng.choice("abcd") for _ in range(rng.randint(3, 6))))
    pairs = [tuple(sorted(p)) for p in itertools.combinations(sorted(words), 2)]
    c = duckdb.connect()
    c.execute("CREATE TABLE w AS SELECT unnest($1) AS t", [sorted(words)])
    want = {(a, b): s for a, b, s in c.execute("SELECT a.t, b.t, jaro_winkler_similarity(a.t, b.t) FROM w a JOIN w b ON a.t < b.t").fetchall()}
    assert all(abs(T.jaro_winkler(*p) - want[p]) < 1e-12 and (T.jaro_winkler(*p) >= 0.9) == (want[p] >= 0.9) for p in pairs)


def star(spark, path, customers, rows):
    """customers of (key, nation, part name, brand), each with its part; orders of (key, customer, day, price), every third with a returned line."""
    def put(name, data, schema):
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")

    at = lambda n: dt.datetime(1995, 1, 1) + dt.timedelta(days=n)
    put("customer", [(k, n, 100.0 if b else -1.0, "BUILDING") for k, n, _, b in customers], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string")
    put("part", [(k, p, f"Brand#{b}") for k, _, p, b in customers], "p_partkey long, p_name string, p_brand string")
    put("orders", [(k, c, at(n), float(x), list(CLASSES)[k % 5]) for k, c, n, x in rows], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double, o_orderpriority string")
    put("lineitem", [(k, at(n - 20), "R" if k % 3 == 0 else "N", 1, 1, 5.0, "F") for k, c, n, x in rows],
        "l_orderkey long, l_shipdate timestamp, l_returnflag string, l_partkey long, l_suppkey long, l_quantity double, l_linestatus string")
    return str(path)


def by_sql(sf, name):
    c = duckdb.connect()
    for t in ("customer", "part", "orders", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet/*.parquet')")
    return collections.Counter(c.execute(plans.oracle_sql()[name]).fetchall())


def shuffled_rows(spark, run):
    """Rows that the stages of ``run`` wrote to shuffles."""
    sc = spark.sparkContext
    status, none, empty = sc._jsc.sc().statusStore(), sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList()

    def written():
        sc._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        stages = status.stageList(None, False, False, none, empty)
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    before = written()
    run()
    return written() - before


def one_domain(spark, path, n=40, each=30):
    """``n`` organisations of one domain, and as many without one, of which neighbours have names alike."""
    rng = random.Random(5)
    customers = [(k, k % 25, "red ring" if k < n else f"{('old', 'new')[k % 2]} bolt", 7 if k < n else 0) for k in range(2 * n)]
    return star(spark, path, customers, [(k, k % (n if k % 4 else 2 * n), rng.randrange(1500), rng.choice((4000, 20000, 90000))) for k in range(n * each)])


def test_pairs_of_a_domain_are_not_shuffled(spark, tmp_path, monkeypatch):
    """all pairs of a domain, in slices of its records, none of them written to a shuffle."""
    monkeypatch.setattr(incidents, "SLICE", 100, raising=False)
    sf = one_domain(spark, tmp_path)
    got = collections.Counter(tuple(r) for r in Q["unit_links"](spark, sf).select("a", "b", "link", "agree").collect())
    assert got == by_sql(sf, "unit_links") and len(got) > 100_000 and {r[2] for r in got} >= {"org", "domain", "trigram"}
    assert shuffled_rows(spark, lambda: Q["unit_links"](spark, sf).write.format("noop").mode("overwrite").save()) < 100_000


def test_gates_count_pairs_where_they_are_made(spark, tmp_path):
    """the checks on pairs neither store nor shuffle them; pairs of records that are there twice are found in any group."""
    sf = one_domain(spark, tmp_path / "once", each=15)
    gates = Q["breach_gates"]
    assert collections.Counter(tuple(r) for r in gates(spark, sf).select("name", "severity", "passed", "measured").collect()) == by_sql(sf, "breach_gates")
    pairs = Q["unit_links"](spark, sf).count()
    assert pairs > 25_000 and shuffled_rows(spark, lambda: gates(spark, sf).collect()) < pairs
    rows = [(k, k % 4, k, 20000) for k in range(8)] + [(1, 2, 1, 20000), (3, 3, 3, 20000), (6, 0, 6, 20000)]
    sf = star(spark, tmp_path / "twice", [(0, 1, "red ring", 7), (1, 2, "red ring", 7), (2, 1, "red ring", 0), (3, 1, "red bolt", 7)], rows)
    measured = lambda rows_: next((p, m) for n, _, p, m in rows_ if n == "one_row_a_pair")
    assert measured([tuple(r) for r in gates(spark, sf).select("name", "severity", "passed", "measured").collect()]) == measured(by_sql(sf, "breach_gates"))


def test_a_checked_plan_keeps_a_plain_size(spark):
    """the size that Spark reckons with does not square in each round of following links (it had megabytes of digits after twenty)."""
    current = spark.range(100).selectExpr("id AS row", "CASE WHEN id = 0 THEN 1 ELSE id - 1 END AS dup_of")
    plan = spark.createDataFrame([(200, "duplicate", 5), (7, "duplicate", 50)], "row long, action string, target long")
    done = runs.checked_plan(plan, current)
    assert {r["row"]: r["refused"] for r in done.collect()} == {200: "row is gone", 7: "linked meanwhile"}
    assert int(done._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()).bit_length() < 400


def test_runs_of_words_stay_with_their_text(spark):
    """a gazetteer of few names goes to the texts, whose word runs are not shuffled; a larger one gives the same."""
    rng = random.Random(4)
    words = ["alpha", "bravo", "delta", "omega", "sigma", "kappa", "gamma", "theta"]
    posts = spark.createDataFrame([(k, "g", "We have something", " ".join(rng.choice(words) for _ in range(200)) + " Red Ring Motors " * (k % 3), "x", None) for k in range(60)],
                                  "post long, grp string, title string, body string, actor string, domain string")
    names = spark.createDataFrame([("Red Ring Motors",), ("alpha bravo delta omega",), ("Other Name",)], "name string")
    run = lambda: sorted(tuple(r) for r in N.offered(posts, names).select("post", "place", "name", "places").collect())
    few, shuffled = run(), shuffled_rows(spark, run)
    assert shuffled < 1000 and any("gazetteer" in p for *_, p in few)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(N, "FEW", 2)
        assert run() == few


def test_levels_of_tiles_as_pair_by_pair(spark, monkeypatch):
    """names that share a key are compared as arrays, tile by tile, with the levels and values of the comparison of one pair."""
    monkeypatch.setattr(likeness, "TILE", 15)
    rng = random.Random(11)
    words = ["acme", "acne", "acmes", "saint", "st", "mary", "marry", "hosp", "hospital", "hospitals", "sm", "smh", "ah", "group", "vabcd", "vabdc", "vabcde", "müller", "u", "no", "north", "norths"]
    rows = {}
    for _ in range(150):
        toks = [rng.choice(words) for _ in range(rng.choice((1, 2, 2, 3, 3, 4)))] + ["".join(rng.choice("xyzw") for _ in range(4))] * (rng.random() < 0.4)
        nn = " ".join(toks + ["group"] * rng.choice((0, 0, 1)))
        rows[nn] = (nn, nn, " ".join(toks), toks, [rng.choice(words)] if rng.random() < 0.2 else [], rng.choice((1, 1, 40, 90)))
    rows["none"] = ("none", "", "", [], [], 3)
    d = N.weighed(spark.createDataFrame(list(rows.values()), "name string, nn string, lk string, toks array<string>, aliases array<string>, orgs long"))
    got = {(r["l"], r["r"]): (r["level"], r["soft"]) for r in likeness.levels_within(d, F.lit("k")).collect()}
    side = {r["name"]: N._Name(r.asDict(), r["n"]) for r in d.collect()}
    want = {(a, b): (N.level(side[a], side[b]), N.soft_likeness(side[a].weight, side[b].weight)) for a, b in itertools.combinations(sorted(side), 2)}
    assert got.keys() == want.keys() and [(p, got[p], want[p]) for p in want if got[p][0] != want[p][0] or abs(got[p][1] - want[p][1]) > 1e-12] == []
    assert {v for v, _ in got.values()} == set(N.LEVELS) - {"exact"}


def test_random_pairs_are_made_in_their_buckets(spark):
    """F9 to F12: records are shuffled once for each draw, pairs never; what is left out of a record for that comes back."""
    n, draws = 2000, 8
    ids = spark.range(n).select(F.col("id").alias("iid"), F.repeat(F.lit("x"), 20).alias("name"))
    made = lambda: matching.random_pairs(ids, draws, "u")
    assert shuffled_rows(spark, lambda: made().write.format("noop").mode("overwrite").save()) <= n * draws + 10
    got, pairs = made().collect(), collections.Counter()
    slots = collections.defaultdict(list)
    for k, i in itertools.product(range(1, draws + 1), range(n)):
        slots[k, int(hashlib.md5(f"u:{k}:{i}".encode()).hexdigest()[:8], 16) % (n // 2)].append(i)
    for of in slots.values():
        pairs.update(itertools.combinations(sorted(of), 2))
    assert collections.Counter((r["l"]["iid"], r["r"]["iid"]) for r in got) == pairs
    rows = [(1, 1, "red ring group", "red ring"), (2, 1, "old old bolt", "old old bolt"), (3, 2, None, None)]
    whole = spark.createDataFrame([(*x, "d.com", 3, "s", 5, dt.date(1999, 1, 1), dt.date(1999, 2, 1), "reg") for x in rows],
                                  "iid long, org long, nn string, lk string, domain string, country int, sector string, people long, ev date, pub date, cls string").withColumn("toks", F.array_distinct(F.split("lk", " ")))
    part = matching.packed(whole)
    back = matching.unpacked(part.select(F.struct(*part.columns).alias("l"), F.struct(*part.columns).alias("r"))).select("r.*").select(*whole.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, whole.collect()))
