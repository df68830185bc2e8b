"""Runs in parts, active versions and repair plans on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import gates, runs

D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)


def part(name, df):
    return runs.Part({name: df}, lambda t: gates.suite([gates.unique_key(t[name], "one_row", ["k"]), gates.check(t[name], "some", F.count("*"), "measured > 0", gates.WARN)]))


def values(df):
    return sorted(r["k"] for r in df.collect())


def test_parts_commit_alone_and_the_record_stays(spark, tmp_path):
    s = runs.RunStore(spark, str(tmp_path))
    rows = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k long")
    assert s.visible("a") is None and s.runs().count() == 0
    assert s.run("one", {"seen": rows(1)}, {"a": part("a", rows(1, 2)), "b": part("b", rows(7))})
    assert not s.run("two", {"seen": rows(2)}, {"a": part("a", rows(3, 3)), "b": part("b", rows(8, 9))})
    assert values(s.visible("a")) == [1, 2] and values(s.visible("b")) == [8, 9]
    assert sorted(r["k"] for r in s.records("seen").collect()) == [1, 2]
    got = {(r["run"], r["part"]): (r["seq"], r["ok"], r["blocked"], r["rows"]) for r in s.runs().collect()}
    assert got == {("one", "a"): (1, True, [], 2), ("one", "b"): (1, True, [], 1), ("one", None): (1, True, [], 3),
                   ("two", "a"): (2, False, ["one_row"], 0), ("two", "b"): (2, True, [], 2), ("two", None): (2, False, ["one_row"], 2)}
    # a replay is looked up, whatever it brings
    assert s.run("one", {"seen": rows(5)}, {"a": part("a", rows(50))}) and not s.run("two", {}, {"a": part("a", rows(50))})
    assert s.runs().count() == 6 and values(s.visible("a")) == [1, 2] and sorted(r["k"] for r in s.records("seen").collect()) == [1, 2]
    # a warning does not block an empty table
    assert s.run("three", {}, {"a": part("a", rows(1).limit(0))}) and values(s.visible("a")) == []
    assert sorted((r["k"], r["run"]) for r in s.history("b").collect()) == [(7, "one"), (8, "two"), (9, "two")]


def test_an_interrupted_run_is_not_visible_and_can_be_run_again(spark, tmp_path):
    s = runs.RunStore(spark, str(tmp_path))
    rows = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k long")
    assert s.run("one", {}, {"a": part("a", rows(1))})

    def broken(t):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        s.run("two", {"seen": rows(2)}, {"a": runs.Part({"a": rows(2)}, broken)})
    assert values(s.visible("a")) == [1] and s.runs().count() == 2
    assert s.run("two", {"seen": rows(3)}, {"a": part("a", rows(3, 4))})
    assert values(s.visible("a")) == [3, 4] and values(s.records("seen")) == [3]


def test_activation_by_language_prompt_number_and_precision(spark):
    row = lambda f, day, acc, ok, lang="en", version="p1", fl=None, fv=None: (f, lang, version, D(day), fl or lang, fv or version, acc, ok)
    rows = [row("date", 0, 3, 3), row("date", 0, 17, 16), row("count", 0, 4, 4), row("ransom", 0, 20, 18), row("type", 0, 20, 20, fl="ja"), row("size", 0, 20, 20), row("size", 0, 20, 20, fv="p0"),
            row("date", 5, 10, 10, version="p2"), row("date", 9, 10, 5, version="p3"), row("date", 0, 20, 20, lang="ja"), ("none", "en", "p1", D(0), None, "p1", None, None)]
    schema = "field string, lang string, version string, day date, file_lang string, file_version string, accepted long, correct long"
    a = runs.activations(spark.createDataFrame(rows, schema))
    got = {(r["field"], r["lang"], r["version"]): r["verdict"] for r in a.collect()}
    assert got == {("date", "en", "p1"): "activated", ("count", "en", "p1"): "too few", ("ransom", "en", "p1"): "not precise", ("type", "en", "p1"): "other language",
                   ("size", "en", "p1"): "other prompt", ("date", "en", "p2"): "activated", ("date", "en", "p3"): "not precise", ("date", "ja", "p1"): "activated", ("none", "en", "p1"): "other language"}
    facts = spark.createDataFrame([(k, f, lang, D(n)) for k, (f, lang, n) in enumerate([("date", "en", -1), ("date", "en", 0), ("date", "en", 4), ("date", "en", 5), ("date", "en", 99), ("date", "ja", 99), ("count", "en", 9), (None, "en", 9)])],
                                  "id long, field string, lang string, day date")
    assert {r["id"]: r["version"] for r in runs.active_on(facts, a).collect()} == {0: None, 1: "p1", 2: "p1", 3: "p2", 4: "p2", 5: "p1", 6: None, 7: None}


ROWS = "row long, org long, event date, public date, follow_up boolean, years array<int>, dup_of long"
INCIDENTS = "incident long, org long, event date, public date, structured boolean, dup_of long"


def test_repair_decisions(spark):
    rows = [(1, 1, D(0), D(300), True, [], None), (2, 2, None, D(800), False, [2024], None), (3, 3, None, D(800), True, [], None), (4, 4, None, D(800), True, [], None), (5, 5, None, D(800), False, [2020], None),
            (6, 6, None, D(800), False, [], None), (7, 7, None, D(10), False, [], None), (8, 1, D(0), D(300), True, None, 99), (9, 9, D(700), D(800), True, [], None), (10, 10, None, D(800), True, [], None)]
    known = [(11, 1, D(20), D(40), False, None), (12, 1, D(25), D(50), True, None), (13, 1, D(0), D(40), True, 12), (21, 2, None, D(380), True, None), (31, 3, None, D(100), False, None),
             (41, 4, None, D(100), False, None), (42, 4, None, D(200), False, None), (61, 6, None, D(100), True, None), (71, 7, None, D(5), True, None), (91, 9, None, D(750), True, None), (92, 9, D(100), D(750), True, None), (101, 10, None, D(100), True, 10)]
    got = {r["row"]: (r["action"], r["target"], r["how"]) for r in runs.repair_plan(spark.createDataFrame(rows, ROWS), spark.createDataFrame(known, INCIDENTS)).collect()}
    assert got == {1: ("duplicate", 12, "event_window"), 2: ("duplicate", 21, "stated_year"), 3: ("duplicate", 31, "only_older_incident"), 4: ("review", None, "no_older_incident"),
                   5: ("keep", None, "late_notice"), 6: ("keep", None, "older_row_no_shared_date"), 7: ("keep", None, None), 8: ("review", 12, "already_linked"), 9: ("duplicate", 91, "event_window"),
                   10: ("review", None, "no_older_incident")}


def test_plans_are_checked_before_they_are_applied(spark):
    plan = spark.createDataFrame([(1, "duplicate", 2), (2, "duplicate", 1), (3, "duplicate", 4), (5, "duplicate", 6), (7, "duplicate", 8), (9, "keep", None), (10, "duplicate", 11), (12, "duplicate", 13), (20, "duplicate", 20)],
                                 "row long, action string, target long")
    current = spark.createDataFrame([(k, None) for k in (1, 2, 3, 4, 6, 7, 9, 11, 20)] + [(10, 4), (12, None), (13, 14), (14, 12)], "row long, dup_of long")
    done = runs.checked_plan(plan, current)
    assert {r["row"]: r["refused"] for r in done.collect()} == {
        1: "would close a circle", 2: "would close a circle", 3: None, 5: "row is gone", 7: "target is gone", 9: None, 10: "linked meanwhile", 12: "would close a circle", 20: "would close a circle"}
    after = {r["row"]: r["dup_of"] for r in runs.applied(current, done).collect()}
    assert after[3] == 4 and after[10] == 4 and after[1] is None and len(after) == 13
