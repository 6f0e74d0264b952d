"""Recall against brute force, ties, repeats and vectors that take no part."""

from __future__ import annotations

import numpy as np

from caselens.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10, every=100):
    n = max((len(e) for _, e in rows if e is not None), default=0)
    good = [(i, np.array(e, float)) for i, e in rows
            if i is not None and e is not None and len(e) == n and None not in e and np.isfinite(np.array(e, float)).all() and any(e)]
    out = {}
    for q, v in good:
        if q % every == 0:
            d = sorted((float(np.sqrt(((x - v) ** 2).sum())), i) for i, x in good if i != q)
            out[q] = [(i, s) for s, i in d[:k]]
    return {q: v for q, v in out.items() if v}


def run(spark, rows, **how):
    found = neighbours.search(spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA), **how).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def close(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_one_list_is_exact_with_ties_copies_and_bad_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(250)]
    rows += [(300, rows[7][1]), (400, rows[7][1]), *((500 + i, rows[7][1]) for i in range(40))]
    rows += [(600, None), (601, [0.0] * 6), (700, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (800, [float("nan")] + [1.0] * 5),
             (900, [float("inf")] + [1.0] * 5), (1000, [1.0, 2.0]), (None, [1.0] * 6)]
    close(run(spark, rows), brute(rows))


def test_recall_with_many_lists(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_POINTS", 32)
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 3, (12, 16))
    x = (centres[rng.integers(0, 12, 3000)] + rng.normal(0, 1, (3000, 16))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = run(spark, rows), brute(rows)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_few_rows(spark):
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0, 2.0])]) == {}
    close(run(spark, [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (5, [3.0, 4.0])]), {0: [(1, 0.0), (5, 8 ** 0.5)]})
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == {}


def test_graph_finds_near_centroids():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 8))
    g = neighbours.centroid_graph(neighbours.balanced_centroids(x, 128))
    ids, dist = g.nearest(x[:200], 4)
    true = np.sqrt(((x[:200, None] - g.centroids[None]) ** 2).sum(2))
    assert (ids[:, 0] == true.argmin(1)).mean() > 0.95
    assert np.allclose(dist[:, 0], np.take_along_axis(true, ids[:, :1], 1)[:, 0])
    size = np.bincount(true.argmin(1), minlength=128)
    assert size.max() <= 12


def test_repeated_rows_do_not_push_out_other_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(100 * i if i < 3 else i, [1.0, 2.0, 3.0]) for i in range(16)] + [(20 + i, rng.normal(size=3).tolist()) for i in range(40)]
    close(run(spark, rows * 2 + rows[:1] * 20), brute(rows))


def test_small_far_groups_get_whole_answers(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_POINTS", 32)
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    rng = np.random.default_rng(5)
    groups = rng.normal(0, 1, (20, 8))
    groups *= 60 / np.linalg.norm(groups, axis=1)[:, None]
    x = np.concatenate([rng.normal(0, 1, (3000, 8)), *(g + rng.normal(0, 0.1, (5, 8)) for g in groups)])
    rows = [(100 * i if i >= 3000 else 100 * i + 1, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    got, want = run(spark, rows), brute(rows)
    assert len(want) == 100 and {q: len(v) for q, v in got.items()} == dict.fromkeys(want, 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / 1000 >= 0.9
