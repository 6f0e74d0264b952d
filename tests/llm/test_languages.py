"""The automaton and the phrases against plain search, held-out accuracy, and odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselens.llm import languages
from caselens.llm.common import table

WORDS = {
    "aa": ["dom", "kara", "mon", "tir", "vel"],
    "bb": ["xau", "qeo", "piu", "wae", "zoi"],
    "cc": ["straß", "fünd", "grök", "hält", "zwölf"],
}


def prose(lang, n, rng):
    return " ".join("".join(rng.choices(WORDS[lang], k=2)) for _ in range(n))


def longest(text, start, learned):
    size = 0
    while start + size < len(text) and text[start : start + size + 1] in learned:
        size += 1
    return max(size, 1)


@pytest.mark.parametrize("stretch", [3, 16, 512])
def test_phrases_are_those_of_a_plain_cross_parse(monkeypatch, stretch):
    monkeypatch.setattr(languages, "STRETCH", stretch)
    rng = random.Random(stretch)
    learned = "".join(rng.choices("abc ", k=300))
    texts = ["".join(rng.choices("abcd ", k=n)) for n in (1, 2, 40, 200, 511, 513)]
    letters, codes = np.unique(np.frombuffer(learned.encode("utf-32-le"), "<u4"), return_inverse=True)
    one = languages.Learned("x", letters, *languages.packed_edges(languages.suffix_automaton(codes.tolist()), len(letters)), 1.0)
    joined = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), "<u4")
    sizes = np.array([len(t) for t in texts])
    got = languages.count_phrases(one.codes(joined), np.cumsum(sizes + 1) - sizes - 1, sizes, one)
    for text, n in zip(texts, got):
        at = plain = 0
        while at < len(text):
            at += longest(text, at, learned)
            plain += 1
        assert n == plain


def test_languages_are_told_apart_without_labels_of_the_held_out(spark):
    rng = random.Random(1)
    rows = [(i, prose(lang, rng.randint(3, 60), rng).capitalize() + ".", lang if i % 7 else None, "s", 1)
            for i in range(300) for lang in [("aa", "bb", "cc")[i % 3]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score long")
    got = {r["doc_id"]: r for r in languages.predict_held_out(docs).collect()}
    assert len(got) == 300
    for i, *_ in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["lang_pred"] == ("aa", "bb", "cc")[i % 3]
        assert 0 <= got[i]["score"] <= 1
    # Labels and other columns of rows that are predicted play no part.
    other = docs.withColumn("lang", F.when(~languages.held_out(), F.col("lang")).otherwise(F.lit("bb"))).withColumn("source", F.lit(None))
    assert {r["doc_id"]: r for r in languages.predict_held_out(other).collect()} == got


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    said = languages.predict_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = said.where("held_out").agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert held[0] > 150 and held[1] >= 0.99 * held[0]


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, prose("aa", 30, rng), "aa") for i in range(40)]
    rows += [(100, None, "aa"), (101, "", "aa"), (102, "12 -- \x00 3", "bb"), (None, "dommon", None), (103, "dommon " * 300_000, None),
             (104, "dommon", None), (104, "dommon", None), (105, "漢字", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = languages.predict_held_out(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3 and by[100]["score"] == 0
    assert all(by[i]["lang_pred"] == "aa" and by[i]["score"] == 1 for i in (103, 104, 105, None))
    assert by[None]["held_out"] is True
    empty = languages.predict_held_out(docs.limit(0))
    assert empty.columns == ["doc_id", "held_out", "lang_pred", "score"] and empty.count() == 0
    bare = languages.predict_held_out(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in bare} == {("und", 0.0)}
