"""The pipeline's stages on a small table: columns, what stays, what goes, and a complete packing."""

from __future__ import annotations

import collections
import random

import corpus_pipeline
import __spark_entry__


def test_stages_in_order(spark, tmp_path):
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = text(200)
    rows = [(k, text(150), "en", f"src{k % 3}") for k in range(40)]
    rows += [(100, base, "en", "src0"), (101, base, "fr", "src1"), (102, base + " more", "en", "src2"), (103, "too short", "en", "src0"),
             (104, None, "en", "src0"), (105, "again and again and so on " * 40, "en", "src1"), (106, text(120) + ' token = "0123abcdefABCDEF99"', "en", "src2")]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        seen[name] = {r["doc_id"]: r for r in out.collect()}
        if name != "best-fit packing":
            assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        docs = out
    assert {103, 104, 105} & set(seen["quality rules"]) == set() and set(range(40)) <= set(seen["quality rules"])
    assert set(seen["quality rules"]) - set(seen["near-duplicates"]) == {101, 102}
    assert "[SECRET]" in seen["secret scan"][106]["text"] and "0123abc" not in seen["secret scan"][106]["text"]
    assert len(seen["source mixing"]) < len(seen["secret scan"])
    packed = corpus_pipeline.run(spark, str(tmp_path))
    fill = collections.Counter()
    for r in packed.collect():
        fill[r["sequence_id"]] += r["length"]
    assert set(r["doc_id"] for r in packed.select("doc_id").collect()) == set(seen["source mixing"]) and max(fill.values()) <= 4096


def test_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
