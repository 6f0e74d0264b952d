"""Repeats against a count of every window, on texts made of shared passages, periods, copies and odd rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from caselens.llm import repeats

N = repeats.LENGTH


def brute(texts):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(raw[p : p + N] for raw in raws for p in range(len(raw) - N + 1))
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 1, np.int64)
        for p in range(len(raw) - N + 1):
            if seen[raw[p : p + N]] > 1:
                gone[p] += 1
                gone[p + N - len(raw) - 1 if p + N > len(raw) else p + N] -= 1
        lost = np.cumsum(gone)[: len(raw)] > 0
        kept = bytes(np.frombuffer(raw, np.uint8)[~lost])
        runs = int((np.diff(np.concatenate([[0], lost.astype(np.int8)])) == 1).sum())
        out.append((len(raw), int(lost.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def prose(rng, n):
    return "".join(rng.choice(["the ", "of ", "ñandú ", "to", "ing ", "\n", "a", "漢"]) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    shared = [prose(rng, n) for n in (60, 130, 170, 200, 400)]
    texts = []
    for _ in range(50):
        parts = [prose(rng, rng.randrange(0, 300))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(shared)
            cut = rng.randrange(0, 40)
            parts += [p[cut:] if rng.random() < 0.5 else p, prose(rng, rng.randrange(0, 80))]
        texts.append("".join(parts))
    near = texts[3]
    texts += [near[:200] + "x" + near[201:] for _ in range(2)] + [near[:-1] + "y", texts[5], texts[5]]
    texts += ["a" * 399, "a" * 400, "a" * 401, "b" * 900, "ab" * 700, "Der " * 300, "Der " * 250 + "x", "", None, "q" * 400]
    texts += [shared[4] * 3, shared[4]]
    return texts


def run(spark, texts, ids=None):
    rows = list(zip(ids or range(len(texts)), texts, ["s"] * len(texts), range(len(texts))))
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, tid long")
    got = {}
    for r in repeats.remove_repeats(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]))
    return got


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_every_window(spark, seed):
    texts = corpus(seed)
    got = run(spark, texts)
    want = brute(texts)
    assert {k: v for k, v in got.items() if v != [want[k]]} == {}


def test_passages_around_the_length(spark):
    """A passage that two documents share goes if it has 400 bytes, and not with 399, however many words it has."""
    rng = random.Random(9)
    texts, kept = [], []
    for size in (394, 399, 400, 401):
        passage = "".join(rng.choice("abcdefgh ") for _ in range(size))
        # Differing bytes on both sides, so that no more than the passage is shared.
        texts += [f"<{size}{passage}>left", f"({size + 5}{passage})right"]
        kept += [size < N] * 2
    got = run(spark, texts)
    want = brute(texts)
    assert {k: v for k, v in got.items() if v != [want[k]]} == {}
    assert [got[i][0][1] == 0 for i in range(len(texts))] == kept


def test_small_batches_hot_cores_and_slabs(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BATCH", 16)
    monkeypatch.setattr(repeats, "HOT", 3)
    monkeypatch.setattr(repeats, "SLAB", 700)
    texts = corpus(3)
    got = run(spark, texts)
    want = brute(texts)
    assert {k: v for k, v in got.items() if v != [want[k]]} == {}


def test_ids_that_are_null_or_repeat(spark):
    texts = corpus(4)[:12]
    texts += [texts[0], texts[1][:-1] + "z"]
    got = run(spark, texts, [7] * 6 + [None] * 8)
    want = brute(texts)
    assert sorted(got[7]) == sorted(want[:6])
    assert sorted(got[None]) == sorted(want[6:])


def test_empty_table(spark):
    assert run(spark, []) == {}
