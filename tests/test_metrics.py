"""Ranking metrics, calibration, top fraction and defaults on literal scores."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from caselens.functions import columns
from caselens.operators import features, isotonic, metrics
from caselens.plans import serving
from caselens.spec import LifecycleSpec

SPEC = LifecycleSpec()


def scored(spark, rows):
    return spark.createDataFrame(rows, "unique_key string, agency string, score double, breach int")


def average_precision(pairs):
    total = sum(y for _, y in pairs)
    tp = n = 0
    area = 0.0
    for s in sorted({s for s, _ in pairs}, reverse=True):
        here = [y for v, y in pairs if v == s]
        tp, n = tp + sum(here), n + len(here)
        area += sum(here) / total * tp / n
    return area


def roc_auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    out = [(f"{i}", "A" if i % 3 == 0 else "B", round(draw.random() ** 2, 2), int(draw.random() < 0.3)) for i in range(300)]
    return out + [(f"s{i}", "ONE", 0.4, 0) for i in range(5)]


def test_ranking_metrics(spark, rows):
    got = metrics.ranking_metrics(scored(spark, rows)).first()
    pairs = [(s, y) for _, _, s, y in rows]
    assert got["pr_auc"] == pytest.approx(average_precision(pairs))
    assert got["roc_auc"] == pytest.approx(roc_auc(pairs))
    assert got["brier"] == pytest.approx(sum((s - y) ** 2 for s, y in pairs) / len(pairs))
    by_group = {r["agency"]: r for r in metrics.metrics_by_group(scored(spark, rows), "agency").collect()}
    assert by_group["A"]["pr_auc"] == pytest.approx(average_precision([(s, y) for _, g, s, y in rows if g == "A"]))
    assert by_group["ONE"]["pr_auc"] is None and by_group["ONE"]["note"] == "single-class"


def test_scores_outside_the_unit_range_are_clipped_for_brier(spark):
    got = metrics.ranking_metrics(scored(spark, [("a", "A", 1.5, 1), ("b", "A", -2.0, 0), ("c", "A", 0.5, 1)])).first()
    assert got["brier"] == pytest.approx(0.25 / 3) and got["pr_auc"] == 1.0


def test_top_fraction_breaks_ties_by_text_key(spark):
    rows = [(str(k), "A", 0.5, 1) for k in range(1, 41)] + [("z", "A", 0.9, 0)] + [(f"low{k}", "A", 0.1, 0) for k in range(9)]
    top = metrics.top_fraction(scored(spark, rows), "score", "unique_key", 0.1)
    assert {r["unique_key"] for r in top.collect()} == {"z", "1", "10", "11", "12"}
    got = metrics.top_fraction_metrics(scored(spark, rows)).first()
    assert got["n_top"] == 5 and got["top_decile_precision"] == pytest.approx(0.8)
    assert got["top_decile_recall"] == pytest.approx(4 / 40)


def test_top_fraction_small_and_without_positives(spark):
    got = metrics.top_fraction_metrics(scored(spark, [("a", "A", 0.2, 0), ("b", "A", 0.3, 0)])).first()
    assert got["n_top"] == 1 and math.isnan(got["top_decile_lift"]) and got["top_decile_recall"] == 0.0


def test_calibration_edges(spark):
    values = [0.0, 0.1, 0.3, 0.30000000000000004, 0.6, 0.7, 0.95, 1.0, -0.2, 1.4]
    df = scored(spark, [(str(i), "A", v, 1) for i, v in enumerate(values)])
    got = {r["score"]: r["bin"] for r in df.select("score", columns.bin_index("score", 10).alias("bin")).collect()}
    assert got == {0.0: 0, 0.1: 1, 0.3: 2, 0.30000000000000004: 3, 0.6: 5, 0.7: 6, 0.95: 9, 1.0: 9, -0.2: 0, 1.4: 9}
    assert columns.equal_width_edges(10)[3] == 0.30000000000000004


def test_ece_and_band(spark):
    df = scored(spark, [("a", "A", 0.15, 0), ("b", "A", 0.15, 1), ("c", "A", 0.85, 1), ("d", "A", 0.85, 1)])
    assert metrics.expected_calibration_error(metrics.calibration_bins(df)).first()["ece"] == pytest.approx(0.25)
    cut = metrics.risk_cut(df)
    assert cut == pytest.approx(0.85)
    assert [r["risk_band"] for r in metrics.risk_band(df, cut).orderBy("unique_key").collect()] == ["normal", "normal", "high", "high"]


def test_constant_baseline(spark):
    df = scored(spark, [(str(i), "A", 0.0, int(i < 3)) for i in range(12)])
    got = metrics.evaluate_constant(df, "B0", 0.3).first()
    assert (got["top_decile_precision"], got["top_decile_lift"], got["top_decile_recall"], got["n_top"]) == (0.25, 1.0, 0.1, 1)
    assert got["brier"] == pytest.approx((3 * 0.49 + 9 * 0.09) / 12)


def test_ordinal_codes(spark):
    train = spark.createDataFrame([("b", "y"), ("a", None), ("B", "x")], "borough string, channel string")
    encoder = features.fit_ordinal(train, ["borough", "channel"])
    seen = spark.createDataFrame([("a", "x"), ("B", "z"), (None, None)], "borough string, channel string")
    coded = features.apply_ordinal(seen, encoder, ["borough", "channel"]).select("borough_code", "channel_code")
    assert sorted(tuple(r) for r in coded.collect()) == [(0, 0), (1, 0), (2, 1)]


def test_scalars(spark):
    df = spark.createDataFrame([("1e3",), ("NaN",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(columns.number_or_zero("v")).collect()] == [1000.0, 0.0, 0.0, 0.0]
    odd = spark.createDataFrame([(float("inf"),), (float("nan"),), (-1.5,), (None,)], "v double")
    assert [r[0] for r in odd.select(columns.finite_or_null("v")).collect()] == [None, None, -1.5, None]
    times = spark.sql("SELECT timestamp '2025-07-01 12:00:00' AS t UNION ALL SELECT timestamp '2025-12-01 12:00:00.5'")
    assert sorted(r[0] for r in times.select(columns.local_iso("t", "America/New_York")).collect()) == [
        "2025-07-01T12:00:00-04:00", "2025-12-01T12:00:00.500000-05:00",
    ]
    india = times.select(columns.local_iso("t", "Asia/Kolkata").alias("x")).collect()
    assert {r["x"][-6:] for r in india} == {"+05:30"}
    moved = times.select(columns.to_local("t", "America/New_York").alias("x")).collect()
    assert sorted(str(r["x"]) for r in moved) == ["2025-07-01 08:00:00", "2025-12-01 07:00:00.500000"]


def test_queue_arguments(spark):
    df = scored(spark, [("a", "A", 0.2, 0)]).withColumn("risk", F.col("score"))
    with pytest.raises(ValueError):
        serving.queue_filters(df, SPEC, min_risk=1.5)
    with pytest.raises(ValueError):
        serving.replay_queue(df, SPEC, "2024-01-01", ("2024-01-01", "2024-01-02"), limit=501)
    with pytest.raises(ValueError):
        serving.replay_queue(df, SPEC, "2024-01-02", ("2024-01-01", "2024-01-02"))
    with pytest.raises(ValueError):
        serving.hotspots(df, SPEC, "street")


@pytest.mark.parametrize("parts", [1, 5])
def test_isotonic_equals_max_of_min_of_means(spark, parts, partitions):
    partitions(parts)
    draw = random.Random(parts)
    rows = [(draw.randrange(60) / 60, draw.randrange(2), 1) for _ in range(300)] + [(None, 1, 1), (0.5, None, 1)]
    df = spark.createDataFrame(rows, "score double, breach int, x int")
    curve = isotonic.fit(df, "score", "breach")
    known = sorted((s, b) for s, b, _ in rows if s is not None and b is not None)
    xs = sorted({s for s, _ in known})
    mean = lambda a, b: (lambda v: sum(v) / len(v))([y for s, y in known if a <= s <= b])
    want = {x: max(min(mean(a, b) for b in xs if b >= x) for a in xs if a <= x) for x in xs}
    got = {r["score"]: r["risk"] for r in isotonic.apply(df, curve, "score", "risk").where("score is not null").collect()}
    assert got == pytest.approx(want)
    ends = isotonic.apply(spark.createDataFrame([(-1.0,), (2.0,), (None,)], "score double"), curve, "score", "risk").collect()
    assert [r["risk"] for r in ends] == [pytest.approx(want[xs[0]]), pytest.approx(want[xs[-1]]), None]
    assert isotonic.fit(df.limit(0), "score", "breach").count() == 0
    assert isotonic.apply(df, isotonic.fit(df.limit(0), "score", "breach"), "score", "risk").where("risk <> score").count() == 0


def test_blocks_are_pooled_before_they_meet(spark):
    """Falling labels: a range partition hands on one block, however many points it has."""
    df = spark.range(20_000).select((F.col("id") / 20_000).alias("score"), (F.col("id") < 10_000).cast("int").alias("breach"))
    assert isotonic.blocks(df, "score", "breach").count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [(r["x"], r["y"]) for r in isotonic.fit(df, "score", "breach").orderBy("x").collect()] == [(0.0, 0.5), (0.99995, 0.5)]
