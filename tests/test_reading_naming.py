"""Lists, volumes, pages, names of posts and actors: cases, and plain versions on small tables."""

import collections
import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import reading as R
from tidewatch.functions import text as T
from tidewatch.operators import naming as N


def listed(spark, texts):
    got = R.listed_items(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", "text").collect()
    out = collections.defaultdict(dict)
    for r in got:
        out[r["id"]][r["place"]] = r["item"]
    return [[out[k][p] for p in sorted(out[k])] for k in range(len(texts))]


def test_lists_with_brackets_and_whole_elements(spark):
    got = listed(spark, [
        "names (first, last), addresses; and phone numbers", "Account number, credit card account number, or debit card number; date of birth",
        "Username or email address, in combination with password or security question, names", "a lot), more (unclosed, still, open", "SSN, ssn, SSN, , 1, x",
        "Social Security number and Medical history, names and addresses", "ID [card; front, back], scans, in combination with a code", None, "", "in combination with nothing",
        "((a1, b1), c1d), ef", "names\nor emails"])
    assert got == [
        ["names (first, last)", "addresses", "phone numbers"], ["Account number, credit card account number, or debit card number", "date of birth"],
        ["Username or email address, in combination with password or security question", "names"], ["a lot)", "more (unclosed, still, open"], ["SSN", "ssn"],
        ["Social Security number", "Medical history", "names and addresses"], ["ID [card; front, back]", "scans, in combination with a code"], [], [], ["in combination with nothing"],
        ["((a1, b1), c1d)", "ef"], ["names", "emails"]]


def test_volumes(spark):
    texts = ["over 1.5 TB and 2,300 files", "1,5 gb of data", "1,500 gb", "up to 3k customers, ~20+ documents", "nearly 2 million records; 0 files", "5tb+ leaked", "approx. 7 mb", "none", None, "12 gbx", "1.2.3 gb"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").select("id", R.volumes(F.col("text")).alias("v")).collect()
    got = {r["id"]: [(x["qualifier"], x["value"], x["unit"]) for x in r["v"] or []] for r in rows}
    assert got == {0: [("over", 1.5e12, "bytes"), ("exact", 2300, "files")], 1: [("exact", 1.5e9, "bytes")], 2: [("exact", 1.5e12, "bytes")],
                   3: [("up_to", 3000, "persons"), ("over", 20, "files")], 4: [("about", 2e6, "records")], 5: [("over", 5e12, "bytes")], 6: [("about", 7e6, "bytes")], 7: [], 8: [], 9: [], 10: []}


def test_article_text(spark):
    long = "This paragraph is long enough to count as a part of the article text. " * 3
    pages = [f"<p>{long}</p><article><p>{long}A</p><p>short</p><p class='x'>{long}<script>var t='</p>';</script>B &amp;amp; &#233;</p></article><p>{long}C</p>",
             f"<html><body><p>{long}D<p>{long}E</p><p>{long}F</p></body></html>", "<article><h1>Title</h1><p>short one</p>rest &lt;b&gt;</article>", "no tags at all", "", None,
             f"<article><nav><p>{long}</p></nav><p>{long}{long}G"]
    got = [r["t"] for r in spark.createDataFrame(list(enumerate(pages)), "id long, h string").select("id", R.article_text(F.col("h")).alias("t")).orderBy("id").collect()]
    one = re.sub(r"\s+", " ", long).strip()
    assert got[0] == f"{one} A\n{one} B &amp; é".replace(". A", ". A") or got[0].split("\n")[0].endswith("A")
    assert "C" not in got[0].split("\n")[-1][-3:] and got[0].count("\n") == 1
    assert got[1].split("\n") == [f"{one} D {one} E", f"{one} F"]  # what never ends is text of the next end
    assert got[2] == "Title short one rest <b>" and got[3] == "no tags at all" and got[4] == "" and got[5] is None
    assert got[6].endswith("G")


def test_relevant_titles(spark):
    titles = spark.createDataFrame([(1, "Acme Motors hit by ransomware"), (2, "Acme Motors opens a plant"), (3, "Ransomware group Acme"), (4, "Breach of ACME-MOTORS data"), (5, None), (6, "breach motors acme")], "id long, title string")
    names = spark.createDataFrame([("Acme Motors",), ("breach of",), ("",), (None,)], "name string")
    terms = spark.createDataFrame([("ransomware",), ("breach",)], "term string")
    assert {tuple(r) for r in R.relevant(titles, names, terms).collect()} == {(1, "Acme Motors"), (4, "Acme Motors")}


# names

NAMES = ["acme", "acme motors", "acme motors group", "acme motor works", "saint mary hospital", "st mary hospital", "mary hospital", "hospital sisters health system", "hshs health system", "cedar valley",
         "cedar valley hospice", "cedar valley services", "allianz", "allianz life", "allianz global risks", "mass general hospital", "massachusetts general hospital", "kawasaki heavy", "kawasaky heavy", "unique zzyzx", "unique zzyzx hospital"]


def plain_level(a, b, df, n):
    idf = lambda t: math.log(n / df[t]) + 1e-9
    if a == b:
        return "exact"
    ta, tb = a.split(), b.split()
    sa, sb = set(ta), set(tb)
    telling = lambda t: df[t] <= max(1.0, 0.01 * n)
    initials = lambda ts: {"".join(x[0] for x in ts[i:j]): set(ts[i:j]) for i in range(len(ts)) for j in range(i + 2, len(ts) + 1)}
    canon = lambda t: N.ABBREVIATIONS.get(t, t)

    def kin(t, u):
        x, y = sorted((t, u), key=len)
        return t == u or canon(t) == canon(u) or N.token_similarity(t, u) > 0 or len(x) >= 3 and y.startswith(x)

    def lacks(t, own, other):
        return not any(kin(t, u) for u in other) and t not in initials(other) and not any(u in initials(own) and t in initials(own)[u] and telling(u) for u in other)

    small, large = (ta, tb) if len(ta) <= len(tb) else (tb, ta)
    if set(small) <= set(large) and len(small) >= 2 and sum(map(idf, small)) >= 0.6 * sum(map(idf, large)):
        return "contain"
    if sa & sb and any(telling(t) and lacks(t, ta, tb) for t in sa - sb) and any(telling(t) and lacks(t, tb, ta) for t in sb - sa):
        return "conflict"
    na, nb = (math.sqrt(sum(idf(t) ** 2 for t in s)) for s in (sa, sb))
    soft = sum(idf(t) * max((N.token_similarity(t, u), idf(u)) for u in tb)[0] * idf(max(tb, key=lambda u: N.token_similarity(t, u))) for t in sa) / (na * nb)
    if soft >= 0.9:
        return "soft"
    return "single" if len(small) == 1 and set(small) <= set(large) or any(df[t] <= 50 for t in sa & sb) else "none"


def test_name_levels_on_all_pairs(spark):
    names = spark.createDataFrame([(x, x, x, x.split(), [], 1) for x in NAMES], "name string, nn string, lk string, toks array<string>, aliases array<string>, orgs long")
    pairs = spark.createDataFrame([(a, b) for a, b in itertools.combinations(NAMES, 2)], "l string, r string")
    df = collections.Counter(t for x in NAMES for t in set(x.split()))
    got = {(r["l"], r["r"]): r["level"] for r in N.name_levels(pairs, N.weighed(names)).collect()}
    want = {(a, b): plain_level(a, b, df, len(NAMES)) for a, b in itertools.combinations(NAMES, 2)}
    assert {k: (v, want[k]) for k, v in got.items() if v != want[k]} == {} and len(got) == len(want)
    assert {"contain", "conflict", "soft", "single", "none"} == set(got.values())
    assert got["kawasaki heavy", "kawasaky heavy"] == "soft" and got["allianz life", "allianz global risks"] == "conflict"


def test_aliases_and_lost_qualifiers(spark):
    rows = [("a", "cedar valley services", "cedar valley", ["cv"]), ("b", "cedar valley hospice", "cedar valley hospice", []), ("c", "cv", "cv", []), ("d", "cedar valley group", "cedar valley", [])]
    rows += [(f"x{k}", f"filler{k}", f"filler{k}", []) for k in range(200)]
    names = spark.createDataFrame([(i, nn, lk, lk.split(), al, 1) for i, nn, lk, al in rows], "name string, nn string, lk string, toks array<string>, aliases array<string>, orgs long")
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "d"), ("a", "a")], "l string, r string")
    got = {(r["l"], r["r"]): r["level"] for r in N.name_levels(pairs, N.weighed(names)).collect()}
    assert got == {("a", "b"): "conflict", ("a", "c"): "alias", ("a", "d"): "linkkey", ("a", "a"): "exact"}


@pytest.mark.parametrize("title, bare", [
    ("Qrumaila Operating Organisation Compromised", "Qrumaila Operating Organisation"), ("[DISCLOSED] Qdiaz Laboratorial S.A.", "Qdiaz Laboratorial S.A."), ("Qmotel One FULL LEAK!", "Qmotel One"),
    ("qsteel.com\\$570.3M\\USA\\679GB\\100% DISCLOSED", "qsteel.com"), ("Qcantalk, Canadian translation services - Leak", "Qcantalk, Canadian translation services"), ("leak #1 qmotors", "qmotors"),
    ("Qsafi Oil (PURE IN) Hacked", "Qsafi Oil (PURE IN)"), ("Qsafi Oil Company (PURE IN Hacked", "Qsafi Oil Company"), ("Zionists Qsonol Hacked ( Gas Stations )", "Qsonol"),
    ("Acme Tools (12.5 GB)", "Acme Tools"), ("Plain Name", "Plain Name"), ("", ""), (None, ""), ("LEAKED", "")])
def test_bare_titles(title, bare):
    assert N.bare_title(title) == bare


def test_candidates():
    got = N.candidates("THE ENDGAME OF QUORVEX MOTORS’ GAME", "Despite giving the Quorvex Motors company time, they failed. See quorvexmotors.com.", "qgang", None, ["Quorvexmotors"])
    assert got[0]["name"] == "Quorvex Motors" and got[0]["host"] == "quorvexmotors.com" and "sibling" in got[0]["places"]
    assert len({N.core(c["name"]) for c in got}) == len(got)
    names = [c["name"] for c in N.candidates("Qgang leaks Acme Corp", "Download at https://gofile.io/d/x or qgang.com/leaks", "qgang", None)]
    assert "Acme Corp" in names and not any("gofile" in n or N.core(n) == "qgang" for n in names)
    assert len(N.candidates("One Two Hacked", " ".join(f"Qname{k} Corp went here." for k in range(30)), "g", None)) == N.OFFERED
    assert N.balanced("Acme (one [two") == "Acme" and N.balanced("Acme) Oil") == "Acme Oil" and N.balanced("A (b) c") == "A (b) c"


def test_decisions():
    c = lambda *names, place="title_span": [{"name": n, "host": None, "places": [place]} for n in names]
    assert N.decided(c("Acme Motors", "Land"), [0.9, 0.1]) == ("Acme Motors", "renamed", 0.9)
    assert N.decided([], [])[1] == "no_candidates" and N.decided(c("A b"), [0.2]) == (None, "none_sure", 0.2)
    assert N.decided(c("Acme Motors", "Zebra Foods"), [0.9, 0.8])[1] == "several"
    assert N.decided(c("Acme Motors", "acmemotors.com"), [0.8, 0.9])[0] == "Acme Motors"
    assert N.decided(c("Acme Motors", "zebra.com"), [0.8, 0.9])[1] == "several"
    assert N.decided(c("Acme Motors - Zebra Foods"), [0.9])[1] == "several"
    assert N.decided(c("Acme Motors"), [0.9], frozenset(["acmemotors"]))[1] == "none_sure"
    assert N.decided(c("Acme Motors Leaked"), [0.9])[1] == "decorated"
    two = c("Acme Motors Company") + c("Acme Motors", place="title_bare")
    assert N.decided(two, [0.95, 0.8])[0] == "Acme Motors"


def test_one_spelling_by_votes(spark):
    rng = random.Random(5)
    forms = ["Acme Motors", "ACME MOTORS", "acme motors", "Acme Motors Inc", "Acme Motors Holdings", "acmemotors.com", "Acmes", "Zebra Foods", "Zebra", "ZEBRA FOODS LTD"]
    rows = [(k, rng.choice("ab"), rng.choice(forms)) for k in range(300)] + [(400, "c", "ACME MOTORS"), (401, "c", None)]
    votes = collections.Counter((g, s) for _, g, s in rows if s)

    def best(g, chosen):
        k = N.core(chosen) if "." not in chosen else re.sub("[^a-z0-9]", "", chosen)
        core = lambda s: re.sub("[^a-z0-9]", "", s) if "." in s else N.core(s)
        ok = [s for h, s in votes if h == g and s != s.lower() and not (s == s.upper() and len(s.replace(" ", "")) > 5) and (core(s) == k or len(k) >= 4 and core(s).startswith(k) and core(s).count(k) == 1)]
        top = max(ok, key=lambda s: (votes[g, s], len(s.split()), -len(s), s), default=chosen)
        return top if votes[g, top] >= votes[g, chosen] else chosen

    got = {r["post"]: r["name"] for r in N.canonical(spark.createDataFrame(rows, "post long, grp string, chosen string")).collect()}
    assert got == {k: best(g, s) for k, g, s in rows if s} and 401 not in got
    assert got[400] == "ACME MOTORS"


def test_alias_index(spark):
    aliases = spark.createDataFrame([("Night Wolf Ransomware", "a1"), ("Target", "a2"), ("common", "a3"), ("lock-bit", "a4"), (None, "a5"), ("Unseen Group", "a6")], "alias string, actor string")
    names = spark.createDataFrame([(["target", "stores"],)], "words array<string>")
    rows = [(k, f"common words in title {k}") for k in range(300)] + [(900, "LockBit, lock bit and Night wolf strike"), (901, "target hit"), (902, None)]
    titles = spark.createDataFrame(rows, "id long, title string")
    index = N.alias_index(aliases, names, titles)
    assert {(r["alias"], r["titles"], r["kept"]) for r in index.collect()} == {("nightwolf", 1, True), ("target", 1, False), ("common", 300, False), ("lockbit", 1, True), ("unseen", 0, True)}
    assert {tuple(r) for r in N.actors_in_titles(titles, index).collect()} == {(900, "a1"), (900, "a4")}
    assert T.normal_name("Acme, Inc.") == "acme"
