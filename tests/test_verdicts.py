"""The cascade of evidence on single cases: each rule, its guards, and the digest."""

from tidewatch.operators import reality as R

GROUPS = "grp string, name string, words array<string>, person_like boolean, weak boolean, country int"
EVIDENCE = "grp string, kind string, source string, host string, title string, entity string, person boolean, live boolean, country int"


def site(grp, source, host, title, live=True, country=None):
    return (grp, "site", source, host, title, None, None, live, country)


def entry(grp, entity, person=False):
    return (grp, "registry", "wikidata", None, None, entity, person, None, None)


def listed(grp):
    return (grp, "confirmed", "lists", None, None, None, None, None, None)


def verdicts(spark, groups, evidence):
    got = R.group_verdicts(spark.createDataFrame(groups, GROUPS), spark.createDataFrame(evidence, EVIDENCE)).collect()
    return {r["grp"]: (r["label"], r["via"], r["domain"]) for r in got}


def test_each_rule_and_its_guards(spark):
    g = lambda k, name="Acme Motors", words=("acme", "motors"), person=False, weak=False, country=1: (k, name, list(words), person, weak, country)
    groups = [g("masked", "Ac****"), g("test", "N/A"), g("own"), g("guess"), g("guess2"), g("guess3"), g("dead"), g("title"), g("other"), g("short", "Abc", ("abc",)), g("person", person=True), g("person2", person=True),
              g("many"), g("many_weak", weak=True), g("many_own"), g("reg"), g("reg_person"), g("reg_weak", weak=True), g("lists"), g("nothing"), g("search")]
    evidence = [site("masked", "tracker_domain", "a.com", "Acme Motors"), site("own", "tracker_domain", "a.com", "Welcome to ACME-Motors!"), site("guess", "slug_guess", "a.com", "Acme Motors"),
                site("guess2", "slug_guess", "a.com", "Acme Motors", country=1), site("guess3", "slug_guess", "a.com", "Acme Motors"), entry("guess3", "acme motors"), site("dead", "tracker_domain", "a.com", "Acme Motors", live=False),
                site("title", "tracker_domain", "a.com", "Acme Foods"), site("short", "slug_guess", "abc.com", "abc"), site("person", "slug_guess", "a.com", "Acme Motors"), site("person2", "leak_post", "a.com", "Acme Motors"),
                site("many", "slug_guess", "a.com", "Acme Motors"), site("many", "slug_guess", "b.com", "Acme Motors of Elsewhere"), site("many_weak", "slug_guess", "a.com", "Acme Motors"),
                site("many_weak", "slug_guess", "b.com", "Acme Motors of Elsewhere"), site("many_own", "slug_guess", "a.com", "Acme Motors"), site("many_own", "tracker_domain", "b.com", "Acme Motors of Elsewhere"),
                entry("reg", "Acme Motors"), entry("reg_person", "acme motors", True), entry("reg_weak", "acme motors"), listed("lists"), listed("reg_weak"), site("search", "search", "a.com", "Acme Motors"), entry("other", "acme")]
    assert verdicts(spark, groups, evidence) == {
        "masked": ("redacted_unresolved", "mask", None), "test": ("not_org", "A1", None), "own": ("real_org", "E1", "a.com"), "guess": ("real_org", "E1", None), "guess2": ("real_org", "E1", "a.com"),
        "guess3": ("real_org", "E1", "a.com"), "dead": ("ambiguous", "none", None), "title": ("ambiguous", "none", None), "other": ("ambiguous", "none", None), "short": ("ambiguous", "none", None),
        "person": ("ambiguous", "person_guard", None), "person2": ("real_org", "E1", "a.com"), "many": ("real_org", "multi_host_real", None), "many_weak": ("ambiguous", "multi_host", None),
        "many_own": ("real_org", "E1", "b.com"), "reg": ("real_org", "E2", None), "reg_person": ("ambiguous", "none", None), "reg_weak": ("real_org", "E3", None), "lists": ("real_org", "E3", None),
        "nothing": ("ambiguous", "none", None), "search": ("ambiguous", "none", None)}


def test_packs_don_t_depend_on_order_or_repeats(spark):
    rows = [site("x", "slug_guess", f"h{k}.com", "t") for k in range(50)] + [listed("x"), entry("y", "e")]
    one = {r["grp"]: r["pack"] for r in R.packed(spark.createDataFrame(rows, EVIDENCE)).collect()}
    two = {r["grp"]: r["pack"] for r in R.packed(spark.createDataFrame(rows[::-1] + rows[:20], EVIDENCE).repartition(5)).collect()}
    less = {r["grp"]: r["pack"] for r in R.packed(spark.createDataFrame(rows[1:], EVIDENCE)).collect()}
    assert one == two and one["x"] != less["x"] and one["y"] == less["y"]


def test_verdicts_reach_every_claim(spark):
    claims = spark.createDataFrame([(k, "x" if k % 3 else "y") for k in range(30)], "claim long, grp string")
    v = R.group_verdicts(spark.createDataFrame([("x", "Acme", ["acme"], False, False, 1), ("y", "N/A", ["na"], False, False, 1)], GROUPS), spark.createDataFrame([listed("x")], EVIDENCE))
    got = R.fanned_out(claims, v).collect()
    assert {r["claim"]: r["label"] for r in got} == {k: "real_org" if k % 3 else "not_org" for k in range(30)} and "grp" not in got[0].asDict()


def test_similar_names_as_brute_force(spark):
    """Among all pairs that begin alike, exactly those above the limit come out."""
    import itertools

    from tidewatch import plans
    from tidewatch.functions import text as T
    from tidewatch.plans import matching

    sf = "/root/testdata/sf0.001"
    names = sorted(r["nn"] for r in matching.organisation_names(spark, sf).select("nn").distinct().collect())
    want = {(a, b) for a, b in itertools.combinations(names, 2) if a[:4] == b[:4] and abs(len(a) - len(b)) <= 4 and round(T.jaro_winkler(a, b), 6) >= 0.9}
    got = plans.queries()["similar_names"](spark, sf).collect()
    assert {(r["nn"], r["other"]) for r in got} == want and len(got) == len(want) > 5
