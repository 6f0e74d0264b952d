"""Counts against plain ones; what the forest refuses against the labels."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from caselens.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def test_counts_match_plain_ones(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a " * 40, "x y z\x1cq\x85", "l\nl\n l\n\nl\r\nl\r", "a b c d e f g h i a b c d e f g h", "漢" * 5000]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))).replace("b a", rng.choice(["\n", " # "])) for _ in range(150)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for r in quality.counts(docs).collect():
        assert tuple(r[n] for n in names) == plain(texts[r["doc_id"]])


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "word " * 9 + "other " * 9 + "a b c d e f g", "x")], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.judge(docs, labels).select("base_failed", "kept").first() == (True, False)
    assert quality.judge(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_refuses_bad_rows_and_keeps_good_ones(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    # Held out: the threshold is taken from the even rows.
    judged = quality.judge(docs, labels.where("doc_id % 2 = 0")).join(labels, "doc_id").where("doc_id % 2 = 1")
    judged = judged.where("n_words >= 20")
    share = {r["quality"]: (r["kept"], r["n"]) for r in judged.groupBy("quality").agg(
        F.avg(F.col("kept").cast("double")).alias("kept"), F.count("*").alias("n")).collect()}
    assert share[1][0] >= 0.99 and share[0][0] <= 0.5


def test_refuses_nearly_all_junk_of_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs, labels.where("doc_id % 2 = 0")).join(labels, "doc_id").where("doc_id % 2 = 1 and not base_failed")
    share = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(
        F.avg(F.col("kept").cast("double")).alias("kept")).collect()}
    assert share[0] <= 0.05 and share[1] >= 0.995
