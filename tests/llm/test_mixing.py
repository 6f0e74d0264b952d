"""Copies against a scalar inversion; rates, shuffling and odd rows."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

from pyspark.sql import functions as F

from caselens.llm import mixing


def uniform(key):
    return (int(hashlib.md5(key.encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def draws(rate, key, seed=11):
    parts = max(1, math.ceil(rate / mixing.STEP))
    total = 0
    for i in range(1, parts + 1):
        u, mean, k = uniform(f"{seed}|{key}|{i}"), rate / parts, 0
        term = below = math.exp(-mean)
        while below < u and k < mixing.TERMS:
            k += 1
            term = term * mean / k
            below += term
        total += k
    return total


def sources(spark):
    rows = [(i, f"text {i}", "hot" if i % 3 else f"s{i % 7}", i, "z") for i in range(3000)]
    rows += [(9001, "lonely", "rare", 1, "z"), (9002, None, None, None, None), (9002, None, None, None, None), (None, "no id", "rare", 1, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, copy string")


def test_copies_are_inverted_draws(spark):
    docs = sources(spark)
    shares = spark.createDataFrame([("hot", 0.2), ("rare", 0.05), ("s0", 0.5), (None, 0.01), ("absent", 0.2)], "source string, share double")
    rate = {r["source"]: r["rate"] for r in mixing.rates(mixing.sizes_of(docs), shares).collect()}
    assert rate["s1"] == 0 and rate["rare"] > mixing.STEP and None in rate
    out = mixing.mix(docs, shares).collect()
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in out)
    want = Counter()
    for r in docs.collect():
        key = str(r["doc_id"]) if r["doc_id"] is not None else hashlib.md5(r["text"].encode()).hexdigest()
        want[r["doc_id"], r["text"], r["source"]] += draws(rate[r["source"]], key)
    assert got == +want
    hot = sum(n for (_, _, s), n in got.items() if s == "hot")
    assert abs(hot - 0.2 * 3004) < 5 * math.sqrt(0.2 * 3004)


def test_order_is_global_and_repeatable(spark):
    docs = sources(spark)
    shares = mixing.tempered_shares(mixing.sizes_of(docs))
    a = [(r["doc_id"], r["copy"], r["position"]) for r in mixing.mix(docs, shares, partitions=4).collect()]
    b = [(r["doc_id"], r["copy"], r["position"]) for r in mixing.mix(docs.repartition(3), shares, partitions=4).collect()]
    assert sorted(a, key=str) == sorted(b, key=str)
    sizes = [r["count"] for r in mixing.mix(docs, shares, partitions=4).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1.3 * min(sizes)


def test_a_third_of_the_rows_with_one_id_is_spread(spark):
    rows = [(i, f"t{i}", "s") for i in range(2000)] + [(None if i % 2 else 5, f"x{i}", "s") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, partitions=8)
    sizes = [r["count"] for r in out.where("doc_id is null or doc_id = 5").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.5 * sum(sizes) / 8


def test_empty(spark):
    docs = sources(spark).limit(0)
    assert mixing.mix(docs).count() == 0
