"""Intervals and counts against plain counting, with shards of a few words, and odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from caselens.llm import phrases

VOCABULARY = ["a", "b", "C", "d", "é", "the", "x\x00y", "1"]


def plain(rows, least, longest=5, top=2000):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                counts.update((lang or "und", tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    found = {k: a for k, a in counts.items() if a >= least}
    out = defaultdict(list)
    for (lang, p), a in found.items():
        if len(p) < 2 or any(
            l2 == lang and len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (l2, q), b in found.items()
        ):
            continue
        cuts = [(1000 * a * total[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return {
        (lang, rank, p.decode(), -a, l, r, total[lang], -score)
        for lang, made in out.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(made)[:top], 1)
    }


def texts(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choices(VOCABULARY, weights=[9, 7, 5, 4, 3, 3, 1, 1])[0] + rng.choice([" ", " ", " ", "\t ", ", ", "\n", ". "])
    return [("".join(word() for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "en", "fr", None])) for _ in range(n)]


def got(spark, rows, **how):
    docs = spark.createDataFrame(rows or [("x", "y")], "text string, lang string")
    made = phrases.collocations(docs if rows else docs.limit(0), **how)
    return {tuple(r)[:8] for r in made.collect()}


@pytest.mark.parametrize("size", [7, 100, 1 << 19])
def test_equals_plain_counting(spark, size):
    rows = texts(size, 150)
    assert got(spark, rows, least=4, size=size) == plain(rows, 4)


def test_ranks_are_cut_by_score_count_and_phrase(spark):
    rows = texts(3, 200)
    assert got(spark, rows, least=3, top=7) == plain(rows, 3, top=7)


def test_intervals_of_both_transforms_belong_to_the_phrase():
    rng = np.random.default_rng(5)
    numbers = np.concatenate([[0], rng.integers(0, 5, 400), [0]])
    forward, backward = (phrases.Transform(phrases.planes(t)) for t in phrases.transforms(numbers))
    edge = np.concatenate([[0], np.cumsum(np.bincount(numbers))])
    at = mirrored = edge[1:-1]
    n = np.diff(edge)[1:]
    for length in range(2, 6):
        at, mirrored, n = phrases.extend_both(forward, backward, at, mirrored, n)
        want = Counter(tuple(numbers[i : i + length]) for i in range(len(numbers) - length + 1) if all(numbers[i : i + length]))
        words = list(zip(*(w.tolist() for w in forward.words(at, length))))
        assert dict(zip(words, n.tolist())) == want and len(words) == len(want)
        reverse = list(zip(*(w.tolist() for w in backward.words(mirrored, length))))
        assert [w[::-1] for w in reverse] == words


def test_odd_rows(spark):
    rows = [(None, "en"), ("", "en"), (" \t.,", None), ("one two " * 150_000, "en"), ("A b", None), ("a B", None), ("a b", "und")]
    assert got(spark, rows, least=3, size=1000) == plain(rows, 3)
    assert got(spark, [], least=1) == set()
    docs = spark.createDataFrame([("a b", "en", 1, "z", 2.0)] * 3, "text string, lang string, rank int, phrase string, n double")
    assert {tuple(r)[:8] for r in phrases.collocations(docs, least=3).collect()} == {("en", 1, "a b", 3, 3, 3, 6, 2000)}


def test_shards_meet_their_intervals_bucket_by_bucket(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BUCKET_BYTES", 40)
    rows = [(" ".join(random.Random(i).choices("abc", k=20)), "en") for i in range(40)]
    name, table = phrases.written_shards(spark.createDataFrame(rows, "text string, lang string"), 32)
    assert spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Num Buckets'").first()["data_type"] == "39"
    joined = phrases._with_alive(table, phrases.frequent(phrases.first_level(table), 1))
    assert joined.count() == table.count() > 1
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and "39 out of 39" in plan
    spark.sql(f"DROP TABLE {name}")


def test_a_task_fills_its_shards(spark):
    rows = [(" ".join(random.Random(i).choices("abc", k=20)), "en") for i in range(50)]
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    # Batches of a few texts: what doesn't fill a shard waits for the next ones.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        made = phrases.shards(docs, 50).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    held = [int(np.frombuffer(r["counts"], "<i4").sum()) for r in made]
    assert sum(held) == 1000 and all(h == 40 for h in held)
    assert [r["rows"] for r in made] == [len(phrases.unplanes(r["forward"])) for r in made]


def test_suffixes_are_sorted_by_enough_numbers():
    rng = np.random.default_rng(7)
    for kinds in (3, 1 << 17, 1 << 30):
        numbers = rng.integers(0, kinds, 300).astype(np.int64)
        numbers[150:290] = numbers[5:145]
        order = phrases.suffix_order(numbers)
        keys = [tuple(np.roll(numbers, -int(i))[: phrases.DEPTH]) for i in order]
        assert keys == sorted(keys) and sorted(order.tolist()) == list(range(300))
        assert (phrases.stable_order(numbers.astype(np.int32)) == np.argsort(numbers, kind="stable")).all()


def test_longer_phrases_take_one_pass_and_few_rows(spark):
    rows = [("a b c d e f g h", "en")] * 30 + [("a b x y", "fr")] * 30
    name, table = phrases.written_shards(spark.createDataFrame(rows, "text string, lang string"), 40)
    joined = phrases._with_alive(table, phrases.frequent(phrases.first_level(table), 20))
    full = phrases.full_buckets(joined, 5, 20, 10)
    blocks = phrases.longer_phrases(joined, full, 10, 1)
    # A shard may hold both languages.
    assert full.shape == (4, 128) and blocks.count() <= 2 * joined.count()
    found = {(r["lang"], r["phrase"], r["a"], r["length"]) for r in phrases.frequent_of(blocks, 20).collect()}
    spark.sql(f"DROP TABLE {name}")
    runs = [("en", "a b c d e f g h".split()), ("fr", "a b x y".split())]
    assert found == {(lang, " ".join(w[i : i + n]), 30, n) for lang, w in runs for n in range(2, 6) for i in range(len(w) - n + 1)}


def test_numbers_go_to_tasks_compressed():
    rng = np.random.default_rng(9)
    words = np.minimum(rng.zipf(1.5, 1 << 16), 1 << 16)
    counts = np.minimum(rng.zipf(2.5, 1 << 16), 100)
    for numbers, most in ((words, 1.5), (counts, 0.5)):
        made = phrases.planes(numbers)
        assert len(made) < most * len(numbers)
        assert (phrases.unplanes(made) == numbers).all()
    assert not len(phrases.unplanes(phrases.planes(words[:0])))


def test_buckets_are_added_up_range_by_range(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PER_BUCKET", 1)
    monkeypatch.setattr(phrases, "BUCKET_RANGE", 64)
    monkeypatch.setattr(phrases, "MOST_ADDERS", 5)
    rows = texts(11, 150)
    assert got(spark, rows, least=4, size=100) == plain(rows, 4)
