"""Merkle manifest, filter audit and fingerprints against plain versions, with edge cases."""

from __future__ import annotations

import base64
import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from tidewatch.llm import bytescan, filter_audit, fingerprints, manifest, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos long, tie string, grp string, part string, block int, ahead boolean"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randrange(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    long = prose(rng, 60_000)
    texts = [None, "", " \t\n", "One", "two WORDS #tag", prose(rng, 120), "SHOUT " * 120, prose(rng, 130) + " 100% & more", long, "", "x" * 400, "ab" * 900]
    texts += [prose(rng, rng.randrange(1, 300)) for _ in range(140)]
    texts += [texts[5], texts[5], texts[20], texts[21].upper(), None]
    out = [(k, t, ("en", "en", "en", "fr", "de", None)[k % 6], ("a", None)[k % 2], None if k % 7 == 0 else len(t or "")) for k, t in enumerate(texts)]
    out += [(7, texts[7], "en", "a", 3), (7, texts[7], "en", "a", 3), (7, "other", "en", "a", 3), (None, texts[30], "en", None, 1), (None, None, None, None, None),
            (500, texts[5], "zz", "a", 1), (-4, "Ünï", "", "", 3)]
    return [(*r, 1, "x", "x", "x", 1, True) for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    r = [(k, None if k % 5 == 0 else k % 2, int(k % 3 == 0), "x") for k in range(0, 150)] + [(3, 1, 0, "y"), (3, 0, 1, "y"), (None, 1, 1, "z")]
    return spark.createDataFrame(r, "doc_id long, quality int, toxic int, part string")


def by_sql(sql, **frames):
    c = duckdb.connect()
    for name, df in frames.items():
        c.register(name, df.toArrow())
    cur = c.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted((tuple(dict(zip(names, r))[c] for c in sorted(names)) for r in cur.fetchall()), key=repr)


def plain(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


# op11


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain_proofs(rows):
    by = collections.defaultdict(list)
    for i, t, lang, source, n, *_ in rows:
        hit = i is not None and t is not None and zlib.crc32(str(i).encode()) % 3 == 0
        by[lang].append((i, leaf(i, source, lang, n, t), leaf(i, source, lang, n, t.translate(LOW) if hit else t)))
    for own in by.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree_of([r[1] for r in by[x]]) for x in langs}
    top = tree_of([trees[x][-1][0] for x in langs])
    out = []
    for at, x in enumerate(langs):
        for k, (i, own, altered) in enumerate(by[x]):
            siblings, folded = "", altered
            for levels, place in ((trees[x], k), (top, at)):
                for level in levels[:-1]:
                    first = place - place % 8
                    left, right = "".join(level[first:place]), "".join(level[place + 1 : first + 8])
                    siblings, folded, place = siblings + left + right, h(left, folded, right), place // 8
            out.append((i, folded, own, h(siblings), top[-1][0], trees[x][-1][0], folded == top[-1][0]))
    return sorted(out, key=repr)


def test_proofs_against_plain_trees(docs, rows):
    got = manifest.proofs(docs, manifest.tampered(docs))
    assert sorted(got.columns) == ["doc_id", "folded_root", "leaf", "proof_sha256", "root", "subroot", "verified"]
    want = plain_proofs(rows)
    assert plain(got) == want
    assert 0 < sum(r[-1] for r in want) < len(want)


def test_proofs_against_sql(docs):
    assert plain(manifest.proofs(docs, manifest.tampered(docs))) == by_sql(queries.ORACLE_SQL["op11_merkle_manifest"], documents=docs)


def test_deep_tree_and_many_languages(spark):
    rows = [(k, "t", "en", "s", 1) for k in range(5_000)] + [(k, "t", f"l{k}", "s", 1) for k in range(5_000, 5_075)]
    d = spark.createDataFrame([(*r, 1, "x", "x", "x", 1, True) for r in rows], SCHEMA)
    assert plain(manifest.proofs(d)) == plain_proofs(rows)


def test_one_row_and_none(spark, empty, rows):
    one = spark.createDataFrame(rows[5:6], SCHEMA)
    assert plain(manifest.proofs(one, manifest.tampered(one))) == plain_proofs(rows[5:6])
    assert manifest.proofs(empty).collect() == []


def test_any_change_shows(docs, rows):
    from pyspark.sql import functions as F

    changed = F.when(F.col("doc_id") == 9, F.lit("."))
    assert {r["doc_id"] for r in manifest.proofs(docs, changed).where("not verified").collect()} == {9}
    tree, top, langs = manifest.manifest(docs)
    assert langs.select("root").distinct().count() == 1 and tree.read(0).count() == len(rows) and top.read(0).count() == langs.count()


# op12


def fails(t, copy):
    w = WORD.findall(t)
    return "".join(f for f, bad in zip("ABCDE", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                                                 bool(re.search("[#$%&*|]", t)), copy)) if bad)


def plain_audit(rows, labels):
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good, toxic = {r[0] for r in labels if r[1] == 1}, {r[0] for r in labels if r[2] == 1}
    own = [(r[2] or "", fails(r[1] or "", r[0] is not None and r[0] > first[r[1] or ""]), r[0] in good and r[0] is not None, r[0] in toxic and r[0] is not None) for r in rows]
    out, removed_in_all = {}, collections.Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {r[0] for r in own}:
            mine = [r for r in own if r[0] == part]
            for k, f in enumerate(order):
                here = [r for r in mine if f in r[1] and not set(order[:k]) & set(r[1])]
                removed_in_all[part, f] += len(here)
                out[part, order, k + 1] = [sum(not set(order[: k + 1]) & set(r[1]) for r in mine), len(here),
                                           sum(f in r[1] and bool(set(order[:k]) & set(r[1])) for r in mine), sum(r[1] == f for r in mine),
                                           sum(r[2] for r in here), sum(r[3] for r in here)]
    return {(*k, *v, removed_in_all[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_against_a_plain_count(docs, rows, labels):
    got = filter_audit.audited(docs, labels)
    assert sorted(got.columns) == sorted(NAMES)
    assert dict(got.dtypes)["step"] == "int" and dict(got.dtypes)["shapley"] == "bigint"
    want = plain_audit(rows, labels.collect())
    assert {tuple(r[c] for c in NAMES) for r in got.collect()} == want
    assert got.count() == len(want) == 600 * len({r[2] or "" for r in rows})
    assert any(r[8] for r in want) and any(r[5] for r in want)


def test_audit_against_sql(docs, labels):
    d = docs.where("doc_id is not null")
    assert plain(filter_audit.audited(d, labels)) == by_sql(queries.ORACLE_SQL["op12_filter_audit"], documents=d, labels=labels)


def test_audit_of_nothing(spark, docs, empty, labels):
    assert filter_audit.audited(empty, labels).collect() == []
    none = filter_audit.audited(docs, labels.limit(0))
    assert none.agg({"good_lost": "sum"}).first()[0] == 0


def test_distinct_words_are_verified(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(prose(rng, 1)[:3] for _ in range(rng.randrange(0, 60))).encode() for _ in range(200)]
    body, at = bytescan.packed(texts)
    starts, ends = filter_audit._words(body, at)
    want = [len(set(t.split())) for t in texts]
    real = filter_audit.distinct_words(body, at, starts, ends, filter_audit._hashes(body, starts, ends))
    clashing = filter_audit.distinct_words(body, at, starts, ends, (ends - starts).astype(np.uint64) << np.uint64(40))
    assert real.tolist() == clashing.tolist() == want


# op13


def plain_chain(text: bytes, rank):
    """Features by definition, window by window, and their filters as sets of bits."""
    w, p = fingerprints.WINDOW, fingerprints.POPULAR
    if not text:
        return []
    if len(text) < w:
        hashes = [int.from_bytes(hashlib.sha256(text).digest()[:8], "little")]
    else:
        def score(b):
            used = sum(round(c * math.log2(c) * 65536) for c in collections.Counter(b).values())
            full = w * int(math.log2(w)) * 65536
            return (full - used) * 1000 // full

        windows = [text[i : i + w] for i in range(len(text) - w + 1)]
        keys = [(rank[s], i) if s >= fingerprints.LEAST else None for i, s in enumerate(map(score, windows))]
        votes = collections.Counter()
        for i in range(len(keys) - p + 1):
            run = [k for k in keys[i : i + p] if k]
            if run:
                votes[min(run)[1]] += 1
        places = sorted(k for k, v in votes.items() if v >= fingerprints.VOTES)
        if not places:
            real = [k for k in keys if k]
            places = [min(real)[1] if real else 0]
        hashes = []
        for k in places:
            x = 0x243F6A8885A308D3
            for j in range(0, w, 8):
                x = ((x ^ int.from_bytes(windows[k][j : j + 8], "little")) * 0xD6E8FEB86659FD93) % 2**64
                x ^= x >> 32
            x = x * 0x9FB21C651E98DF25 % 2**64
            hashes.append(x ^ (x >> 29))
    hashes = list(dict.fromkeys(hashes))
    return [{(x >> (11 * k)) % 2048 for x in hashes[i : i + fingerprints.MOST] for k in range(fingerprints.BITS)} for i in range(0, len(hashes), fingerprints.MOST)]


def plain_likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    a, b = sorted((a, b), key=len) if len(a) != len(b) else (a, b)

    def one(x, y):
        most, chance = min(len(x), len(y)), len(x) * len(y) / 2048
        least = chance + fingerprints.CUT * (most - chance)
        return min(1.0, max(0.0, (len(x & y) - least) / (most - least))) if most > least else 0.0

    return sum(max(one(x, y) for y in b) for x in a) / len(a)


def bits_of(fingerprint):
    n, body = fingerprint.split(":")
    if n == "0":
        return []
    bits = np.unpackbits(np.frombuffer(base64.b64decode(body), np.uint8)).reshape(int(n), -1)
    return [set(np.flatnonzero(b).tolist()) for b in bits]


def test_fingerprints_against_the_definition(docs, rows):
    rank = fingerprints.ranks(docs)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [r[1] or "" for r in order]
    edited = [a[: len(a) - len(a) // 3] + b[: len(a) // 3] for a, b in zip(texts, texts[1:] + texts[:1])]
    chains = {t: plain_chain(t.encode(), rank) for t in {*texts, *edited} if len(t) < 5_000}
    got = fingerprints.compared(docs).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["edited_sha256"]): r for r in got}
    checked = 0
    for k, (row, t, e) in enumerate(zip(order, texts, edited)):
        r = by[row[0], hashlib.sha256(e.encode()).hexdigest()]
        follower = texts[(k + 1) % len(texts)]
        assert r["n_chars"] == len(t)
        if t in chains and e in chains:
            assert bits_of(r["fingerprint"]) == chains[t] and bits_of(r["edited_fingerprint"]) == chains[e]
            assert r["near_edited"] == pytest.approx(plain_likeness(chains[t], chains[e]), abs=1e-9)
            if follower in chains:
                assert r["near_next"] == pytest.approx(plain_likeness(chains[t], chains[follower]), abs=1e-9)
            checked += 1
    assert checked > 140


def test_long_texts_in_pieces_are_as_whole(monkeypatch, rows):
    rng = random.Random(1)
    text = (prose(rng, 9_000) + "z" * 5_000 + prose(rng, 3_000)).encode()
    rank = np.array(random.Random(2).sample(range(fingerprints.SCORES), fingerprints.SCORES))
    whole = fingerprints.digests([text], rank)
    monkeypatch.setattr(fingerprints, "PIECE", 4096)
    assert fingerprints.digests([text], rank) == whole
    assert fingerprints.digests([b"q" * 9_000], rank) != [b""]


def test_ranks_count_all_windows(docs, rows, monkeypatch):
    want = collections.Counter()
    for r in rows:
        body = np.frombuffer((r[1] or "").encode(), np.uint8)
        want.update(fingerprints.scores(body).tolist())
    counts = np.array([want[k] for k in range(fingerprints.SCORES)])
    monkeypatch.setattr(fingerprints, "PIECE", 5000)
    rank = fingerprints.ranks(docs)
    assert (np.argsort(rank) == np.argsort(counts, kind="stable")).all()


def test_fingerprints_tell_edits_from_others(spark):
    rng = random.Random(4)
    d = spark.createDataFrame([(k, prose(rng, 400)) for k in range(200)], "doc_id long, text string")
    got = fingerprints.compared(d).collect()
    assert min(r["near_edited"] for r in got) > 0.3 and max(r["near_next"] for r in got) < 0.1


def test_fingerprints_of_few(spark, empty, docs):
    assert fingerprints.compared(empty).collect() == []
    one = fingerprints.compared(spark.createDataFrame([(3, "short text")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0 and one[0]["edited_sha256"] == hashlib.sha256(b"short tsho").hexdigest()
    nulls = fingerprints.compared(spark.createDataFrame([(None, None), (None, None)], "doc_id long, text string")).collect()
    assert [r["fingerprint"] for r in nulls] == ["0:", "0:"] and nulls[0]["near_edited"] == 1.0
    alone = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprinted(docs).where("doc_id > 20").collect()}
    beside = {r["doc_id"]: r["fingerprint"] for r in fingerprints.compared(docs).where("doc_id > 20").collect()}
    assert alone == beside
