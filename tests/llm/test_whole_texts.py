"""Texts that must be read whole: blanks, phrases and lines at every size of host."""

import random

import corpus_pipeline
import duckdb
import pytest

from tidewatch.llm import quality, queries, secrets


@pytest.mark.parametrize("before", ["password: ", "password:    ", "password:\t", "password:\n", "password    = ", "pwd\t\t:\t", "password\n  = ", "token:\npassword: "])
def test_blanks_around_the_separator(before):
    words, value = secrets.ranks(secrets.vocabulary_path()), "xK9#mQ2$vL8pW"
    assert secrets.guess_spans(f"{before}{value} end", words) == [(len(before), 3, len(before) + len(value))]


def test_values_of_several_words():
    words, phrase = secrets.ranks(secrets.vocabulary_path()), "correct horse battery staple"
    for text in (f"passphrase: {phrase}", f"pass phrase =\t{phrase}. Then go on.", f'password is "{phrase}" here', f"passphrase: '{phrase}'"):
        at = text.index(phrase)
        assert secrets.guess_spans(text, words) == [(at, 3, at + len(phrase))], text
    assert secrets.guess_spans("the password is important and the token was everything", words) == []


@pytest.mark.parametrize("longest", [quality.LONGEST, 3])
def test_lines_go_by_number_of_texts_at_every_host_size(spark, tmp_path, monkeypatch, longest):
    monkeypatch.setattr(quality, "LONGEST", longest)
    rng, words = random.Random(1), [f"w{k}" for k in range(500)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    line = lambda k: f"Common line number {k} of this host and its pages"
    rows = [(k, (line(k % 100) + "\n" if k < 2200 else "") + text(12), "big") for k in range(2300)]
    rows += [(9000 + k, line(7) + "\n" + text(12), "small") for k in range(20)] + [(9100, None, None)] + [rows[3]] * 5
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.op6_absolute_lines(spark, str(tmp_path))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cur = c.execute(queries.ORACLE_SQL["op6_absolute_lines"])
    names = [x[0] for x in cur.description]
    got = df.select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, cur.fetchall()))
    assert sum(r["n_removed_lines"] for r in got) == 2205
    left = corpus_pipeline.quality_rules(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert left.where("source = 'big' and text like '%Common%'").count() == 0 and left.where("source = 'small' and text like '%Common%'").count() == 20
