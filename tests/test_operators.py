"""Pure helpers, seeded defects for gates, statistics, linkage and streams."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import dates, special
from tidewatch.functions import text as T
from tidewatch.operators import gates, graph, linkage, stats, windows
from tidewatch.streaming import feeds

D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_special_functions():
    for x in (0.3, 1.0, 4.5, 100.0):
        assert math.isclose(float(special.gammaln(x)), math.lgamma(x), rel_tol=1e-10, abs_tol=1e-10)
    assert math.isclose(float(special.digamma(1.0)), -0.5772156649015329, rel_tol=1e-9)
    assert math.isclose(float(special.poisson_cdf(2, 1.5)), math.exp(-1.5) * (1 + 1.5 + 1.125), rel_tol=1e-12)
    assert math.isclose(float(special.gamma_quantile(1, 2.0, 0.5)), math.log(2) / 2, rel_tol=1e-6)
    y = np.arange(400)
    assert math.isclose(np.exp(special.nb_logpmf(y, 5.0, 2.0)).sum(), 1.0, rel_tol=1e-9)


def test_text_functions(spark):
    assert T.normal_name("Société Générale & Fils Co. Ltd") == "societe generale and fils"
    assert T.normal_name("ACME, Inc.") == "acme" and T.normal_name(None) is None
    assert T.normal_name("株式会社 テスト") == "テスト" and T.normal_name("アスクル株式会社") == "アスクル" and T.normal_name("(株)ABC Co日本 航空") == "abc 日本航空"
    assert T.normal_name("NTTデータ") == T.normal_name("NTT データ") == "ntt データ" and T.normal_name("ソフトバンク・テクノロジー") == "ソフトバンクテクノロジー"
    assert T.normal_name("The Smith KG PLLC of Köln") == "smith of koln" and T.normal_name("L.L.C. Partners") == "partners"
    assert math.isclose(T.jaro_winkler("martha", "marhta"), 0.9611111, rel_tol=1e-6) and T.jaro_winkler("a", "") == 0 and T.jaro_winkler("x", "x") == 1
    assert T.numbers_in("about 1,200 people, 3.5 million and 12万") == [1200, 3.5e6, 120000] and T.sizes_in("2.5 TB of 300GB") == [2.5e12, 3e11]
    assert T.negated("They said data was not stolen.", "stolen") and not T.negated("It was not us. Data was stolen.", "stolen")
    assert T.numbers_in("1億2000万人、2万5千件と3,000件、1.5万") == [120_000_000, 25_000, 3000, 15_000] and T.numbers_in("") == []
    assert T.negated("データの流出は確認されていません。", "流出") and not T.negated("流出しました。影響はありません。", "流出") and T.negated("Stolen data it was never", "stolen") and T.negated("It wasn't stolen", "stolen")
    for t, denied in (("流出件数は少ない", False), ("間もない時期に流出した", False), ("流出は危ない", False), ("流出していない", True), ("流出はないと発表した", True), ("流出は確認されておらず、調査中", True), ("「流出は無かった、ない」", False), ("流出の事実はない」", True)):
        assert T.negated(t, "流出") is denied, t
    assert T.grounded("affected 1,200 people", "It affected 1,200   people.", 1200) is None
    assert T.grounded("affected 1,200 people", "nothing", 1200) == "quote not in document" and T.grounded("affected some people", "affected some people", 5) == "number not in quote"
    assert T.is_acronym("U.C.L.A.", "University of California Los Angeles") and not T.is_acronym("IT", "Italian Trade")
    masked = spark.createDataFrame([("A***e Corp", True), ("12-34", True), ("Redacted", True), ("Test Valley Council", False), ("Acme", False)], "n string, want boolean")
    assert masked.where(T.is_masked(F.col("n")) != F.col("want")).isEmpty()
    row = spark.range(1).select(
        T.domain_of(F.lit("HTTPS://user@www.Example.org:8443/x?y")).alias("d"), T.id_namespace(F.lit("ghsa-abcd-1234-efgh")).alias("g"),
        T.first_cve(F.lit("x"), F.lit("see cve-2024-12345!")).alias("c"), T.cve_year(F.lit("CVE-1999-0001")).alias("y"),
        T.trigram_similarity(F.lit("abcd"), F.lit("abce")).alias("s"), F.size(T.sentences(F.lit("One. Two!\nThree?"))).alias("n"),
        dates.any_date(F.lit("Jul 29, 2025, 11:29:31 PM")).alias("e"), dates.coarse_window(F.lit("2024-02")).alias("w"), dates.half_year(F.lit("2024-07-01").cast("date")).alias("h"),
        dates.last_complete_month(F.lit("2024-02-29").cast("date")).alias("m"), F.size(dates.date_chunks(F.lit("2024-01-01").cast("date"), F.lit("2024-12-31").cast("date"))).alias("k")).first()
    assert (row["d"], row["g"], row["c"], row["y"], row["n"]) == ("example.org", "ghsa", "CVE-2024-12345", 1999, 3) and math.isclose(row["s"], 1 / 3)
    assert str(row["e"]) == "2025-07-29" and (str(row["w"]["lo"]), str(row["w"]["hi"])) == ("2024-01-01", "2024-03-31")
    assert (row["h"], str(row["m"]), row["k"]) == ("2024H2", "2024-02-01", 4)


def test_life_cycle_cases(spark):
    def run(scores, models=None, begin=True):
        rows = [("c", D(k), float(s), (models or {}).get(k, "v1")) for k, s in enumerate(scores) if s is not None] + [("z", D(0 if begin else -5), 0.0, "v1")]
        out = windows.score_life_cycle(spark.createDataFrame(rows, "cve string, day date, score double, model string"), "cve", "day", "score", "model")
        return [(r["day"], r["direction"], r["cause"]) for r in out.where("cve = 'c'").orderBy("day").collect()]

    assert run([0.01] * 3 + [0.2] * 7) == [(D(3), "rise", "organic")]
    assert run([0.01] * 3 + [0.2] * 6) == []
    assert run([0.2]) == [(D(0), "rise", "already_high")] and run([None, 0.2]) == [(D(1), "rise", "first_scored")]
    assert run([0.2] + [0.07] * 20) == [(D(0), "rise", "already_high")]
    assert run([0.2] + [0.069] * 7) == [(D(0), "rise", "already_high"), (D(1), "fall", "organic")]
    assert run([0.01] * 2 + [0.3] * 8, {k: "v2" for k in range(2, 10)}) == [(D(2), "rise", "model_change")]


def test_episodes_are_anchored(spark):
    rows = [("k", D(n)) for n in (0, 60, 120, 150, 151)] + [("k", D(0))]
    out = windows.anchored_episodes(spark.createDataFrame(rows, "g string, day date"), ["g"], "day", 90).orderBy("episode").collect()
    assert [(r["first_day"], r["last_day"], r["n"]) for r in out] == [(D(0), D(60), 3), (D(120), D(151), 3)]


def test_runs_split_at_blocks(spark):
    rows = [(k, 7) for k in range(5, 12)] + [(12, 8), (14, 8)]
    out = windows.runs(spark.createDataFrame(rows, "at long, v long"), "at", "v", every=8).orderBy("lo").collect()
    assert [(r["lo"], r["hi"], r["v"]) for r in out] == [(5, 7, 7), (8, 11, 7), (12, 12, 8), (14, 14, 8)]


def test_gates_in_both_directions(spark):
    ok = spark.createDataFrame([(1, D(0)), (2, D(1))], "k long, day date")
    seeded = ok.unionByName(ok.limit(1))
    assert gates.unique_key(ok, "u", ["k"]).first()["passed"] and not gates.unique_key(seeded, "u", ["k"]).first()["passed"]
    assert gates.none_of(ok, "n", F.col("k") < 0).first()["passed"] and not gates.none_of(ok, "n", F.col("k") < 2).first()["passed"]
    assert gates.not_shrunk(ok, 2, "s").first()["passed"] and not gates.not_shrunk(ok, 3, "s").first()["passed"]
    assert gates.fresh(ok, "day", "2024-01-05", 3, "f").first()["passed"] and not gates.fresh(ok, "day", "2024-02-05", 3, "f").first()["passed"]
    assert not gates.fresh(ok.limit(0), "day", "2024-01-05", 3, "f").first()["passed"]
    assert not gates.no_orphans(ok.select("k"), ok.select("k").limit(1), ["k"], "o").first()["passed"]
    gates.enforce(gates.suite([gates.unique_key(ok, "u", ["k"]), gates.unique_key(seeded, "w", ["k"], gates.WARN)]))
    with pytest.raises(gates.GateFailed, match="dup"):
        gates.enforce(gates.unique_key(seeded, "dup", ["k"]))


def test_components_and_clusters(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 101), (None, 1)], "a long, b long")
    got = {r["id"]: r["component"] for r in graph.components(edges, "a", "b").collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}
    pairs = spark.createDataFrame([(1, 2, 0.95, False), (2, 3, 0.95, False), (1, 3, 0.6, False), (3, 4, 0.99, False), (2, 4, 0.7, True), (1, 4, 0.2, False)], "a long, b long, p double, cannot boolean")
    got = {r["id"]: r["cluster"] for r in linkage.clusters(pairs, "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3}


def test_intensity_recovers_order(spark):
    rng = np.random.default_rng(4)
    theta = rng.normal(size=300)
    rows = [("s", *[int(v) for v in rng.poisson(50 * 0.2 * np.exp(t), 3)], 50, float(t)) for t in theta]
    df = spark.createDataFrame(rows, "side string, a long, b long, c long, size long, theta double")
    fit = stats.intensity_fit(df, "side", ["a", "b", "c"], "size").collect()
    known = {tuple(r[1:5]): r[5] for r in rows}
    x = np.array([known[r["a"], r["b"], r["c"], r["size"]] for r in fit])
    y = np.log([r["intensity"] for r in fit])
    assert all(r["converged"] for r in fit) and np.corrcoef(x, y)[0, 1] > 0.95
    assert sum(r["weight"] for r in fit) == len(rows)


def test_streams(spark, tmp_path):
    rows = [(k % 3, dt.datetime(2024, 1, 1) + dt.timedelta(days=k)) for k in range(60)]
    spark.createDataFrame(rows + rows, "k long, at timestamp").coalesce(1).write.parquet(f"{tmp_path}/in")
    read = lambda: spark.readStream.schema("k long, at timestamp").parquet(f"{tmp_path}/in")

    def finish(df, name):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name).collect()

    assert len(finish(feeds.once_per_key(read(), ["k", "at"], "at"), "once")) == 60
    weekly = finish(feeds.tumbling(read(), ["k"], "at"), "weekly")
    assert weekly and all(r["n"] in (2, 4, 6) for r in weekly)
    eps = finish(feeds.episodes(read(), "k", "at", days=20), "eps")
    assert {(r["k"], r["first_at"].day, r["n"]) for r in eps if r["first_at"].month == 1} >= {(0, 1, 14)}
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "k long, h string")
    sink = feeds.upsert_sink(f"{tmp_path}/state", ["k"], "h", buckets=4)
    state = lambda: {r["k"]: (r["h"], r["last_changed_at"]) for r in feeds.current_state(spark, f"{tmp_path}/state").collect()}
    sink(batch, 0)
    sink(spark.createDataFrame([(2, "c"), (3, "d")], "k long, h string"), 1)
    sink(spark.createDataFrame([(2, "c"), (3, "d")], "k long, h string"), 1)
    assert state() == {1: ("a", "0"), 2: ("c", "1"), 3: ("d", "1")}
    sink(batch.limit(0), 2)
    for n in range(3, 7):
        sink(spark.createDataFrame([(2, "e")], "k long, h string"), n)
    assert state() == {1: ("a", "0"), 2: ("e", "3"), 3: ("d", "1")}
    assert max(map(len, feeds._versions(spark, f"{tmp_path}/state").values())) == 2
    page = spark.createDataFrame([(10,), (11,)], "t long")
    assert feeds.window_is_complete(page, page.where("t < 11"), "t", 2).first()["complete"] is True
    assert feeds.window_is_complete(page, spark.createDataFrame([(3,)], "t long"), "t", 2).first()["complete"] is False
    assert feeds.window_is_complete(page, page.limit(0), "t", 2).first()["complete"] is None
