"""Components against a comparison of all pairs."""

from __future__ import annotations

import random
import re

import pytest

from caselens.llm import jaccard
from caselens.llm.components import components


def the_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [the_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        if doc is not None and (r not in least or doc < least[r]):
            least[r] = doc
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, n=60, words=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Größe", "漢字", "ÀB", "x y", "z "]
    make = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage = make(40)
    texts = [make(rng.choice([0, 1, 3, 4, 5, 6, 30, 80, 120])) for _ in range(n)]
    for _ in range(n):
        base = list(rng.choice(texts))
        for _ in range(rng.randrange(0, 5)):
            if base:
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
        texts.append(base + make(rng.randrange(0, 3)))
    texts += [make(rng.randrange(0, 100)) + passage + make(rng.randrange(0, 100)) for _ in range(n)]
    group = make(100)
    for _ in range(n * 2):
        base = list(group)
        for _ in range(rng.randrange(0, 6)):
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
        texts.append(base)
    out = [rng.choice([" ", "\n", "  "]).join(t) for t in texts]
    out += [None, "", "  \n", "A b C d", "a B c D", "a b c d", out[3].upper(), out[-1]]
    rng.shuffle(out)
    return out


def run(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, sig int, token string")
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.link_components(docs).collect()]
    return sorted(got, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_all_pairs(spark, seed):
    rows = list(enumerate(corpus(seed)))
    assert run(spark, rows) == brute(rows)


def test_all_lists_left_to_the_rounds(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 0)
    monkeypatch.setattr(jaccard, "SHORT", 1)
    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    rows = list(enumerate(corpus(5, 25)))
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed, short", [(6, 1), (7, 2), (8, 4)])
def test_all_lists_left_to_the_shingles_outside_the_leaders(spark, monkeypatch, seed, short):
    monkeypatch.setattr(jaccard, "FREQUENT", 0)
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "ROUNDS", 0 if seed % 2 else 1)
    rows = list(enumerate(corpus(seed, 25, 60 if seed == 8 else 400)))
    assert run(spark, rows) == brute(rows)


def test_few_comparisons_among_copies_and_strangers(spark, monkeypatch):
    """300 near copies, most of which don't link with each other, and 300 strangers with one passage in common."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    texts = []
    for i in range(300):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 4, 5, 6])):
            copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
        texts.append(" ".join([*passage, *(word() for _ in range(11))]))
    compared = []
    plain = jaccard.overlaps

    def counted(pairs, sets):
        compared.append(pairs.count())
        return plain(pairs, sets)

    monkeypatch.setattr(jaccard, "overlaps", counted)
    rows = list(enumerate(texts))
    assert run(spark, rows) == brute(rows)
    assert sum(compared) < 10 * len(rows)


def test_near_copies_meet_once_by_their_differences(spark, monkeypatch):
    """300 near copies with up to 9 changed words: a set has few entries outside what most of them have, in all levels together."""
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(10**6)}"
    base, texts = [word() for _ in range(120)], []
    for _ in range(300):
        copy = list(base)
        for _ in range(rng.randrange(1, 10)):
            copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    entries, pairs = [], []
    plain, over = jaccard.settle, jaccard.overlaps

    def settled(df, label):
        made = plain(df, label)
        if label == "outer-lists":
            entries.append(made.count())
        return made

    def counted(some, sets):
        pairs.append(some.count())
        return over(some, sets)

    monkeypatch.setattr(jaccard, "settle", settled)
    monkeypatch.setattr(jaccard, "overlaps", counted)
    monkeypatch.setattr(jaccard, "SHORT", 16)
    rows = list(enumerate(texts))
    assert run(spark, rows) == brute(rows)
    assert entries and sum(entries) < 20 * len(rows)
    assert sum(pairs) < 10 * len(rows)


def test_ids_that_are_null_or_repeat(spark):
    rows = list(zip([5, None, 5, 9, None, 2, 2, 2], ["a b c d e f g", "a b c d e f g", "q r s t u v w", "q r s t u v w",
                                                     "l m n o p", "l m n o p", None, "one two three"]))
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1001)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 1000: 1000, 1001: 1000}
