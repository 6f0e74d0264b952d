"""The fitted risk model: signal, additivity, determinism, round trip, scenarios."""

from __future__ import annotations

import math
import random
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from caselens import fixed
from caselens.checks import model_cases
from caselens.operators import boosting, boosting_blocks, features, metrics, quality, trees
from caselens.plans import modeling
from caselens.spec import FeatureConfig, LifecycleSpec
from caselens.storage import settle
from test_flow import frame

SPEC = LifecycleSpec()
ZERO = datetime(2024, 1, 1, tzinfo=timezone.utc)
CFG = FeatureConfig(
    splits={"train": ("2024-01-01", "2024-01-15"), "val": ("2024-01-16", "2024-01-20"), "test": ("2024-01-21", "2024-01-28")},
    observed_at="2024-03-01", min_group_n=30, rare_min_n=30, replay=("2024-01-21", "2024-01-28"),
)


def slow_at_night(n=2500):
    """Night rows and one channel take longer, so the label has a pattern to learn."""
    draw, rows = random.Random(11), []
    for i in range(n):
        start = ZERO + timedelta(seconds=draw.randrange(28 * 86_400))
        channel = draw.choice(["PHONE", "ONLINE"])
        slow = (start.hour < 6) + (channel == "PHONE")
        hours = draw.uniform(0.1, 2.0) * (1 + 2 * slow)
        end = start + timedelta(hours=hours)
        kind = draw.choice(["Noise", "Water", "Light", f"Rare{i % 40}"])
        rows.append((f"{i:05d}", draw.choice(["AAA", "BBB"]), kind, int(start.timestamp()), int(end.timestamp()),
                     "Closed", draw.choice(["NORTH", "SOUTH", None]), channel, None))
    return rows


@pytest.fixture(scope="module")
def built(spark):
    valid = settle(frame(spark, slow_at_night()), "valid")
    frozen = features.frozen_targets(features.temporal_split(valid, SPEC, CFG.splits), CFG)
    table = settle(features.feature_table(valid, CFG, frozen), "table")
    risk = modeling.scoring_context(modeling.fit_risk_model(table, trials=1, max_rounds=8), table, frozen, CFG)
    return table, risk


def test_learns_the_pattern_and_reports(built):
    table, risk = built
    report = modeling.model_report(table, risk, SPEC, limitations=["short window"])
    rows = {r["model"]: r for r in report["metrics"].collect()}
    assert rows["boosted_trees"]["pr_auc"] > rows["B1_group_lookup"]["pr_auc"] > 0
    assert rows["B0_base_rate"]["roc_auc"] == 0.5
    assert metrics.beats_baseline(report["metrics"], "boosted_trees", "B1_group_lookup").first()["beats"]
    top = [r["feature"] for r in report["importance"].collect()]
    assert set(top) == set(fixed.FEATURES) and "channel" in top[:3]
    assert report["calibration"].agg(F.sum("n")).first()[0] == quality.labeled(table.where("split = 'test'")).count()
    assert {r["agency"] for r in report["per_group"].collect()} == {"AAA", "BBB"}


def test_contributions_add_up_to_the_log_odds(built):
    table, risk = built
    scored = modeling.score_rows(quality.labeled(table.where("split = 'test'")), risk)
    rows = scored.select("raw_score", "contributions").collect()
    rest = [math.log(r["raw_score"] / (1 - r["raw_score"])) - sum(r["contributions"]) for r in rows]
    assert max(rest) - min(rest) < 1e-9


def test_reasons(built):
    table, risk = built
    scored = modeling.score_population(table, risk, CFG)
    assert "top_reasons" in scored.columns
    for row in scored.limit(200).collect():
        reasons = row["top_reasons"]
        values = [r["contribution_log_odds"] for r in reasons]
        assert len(reasons) <= 3 and values == sorted(values, reverse=True) and all(v > 0 for v in values)
        positive = sorted((c for c in row["contributions"] if c > 0), reverse=True)
        assert values == pytest.approx(positive[:3])
        for r in reasons:
            assert r["label"] == fixed.FEATURE_LABELS[r["feature"]] and r["direction"] == "increases_risk"
            assert (r["train_median"] is None) == (r["feature"] in fixed.CATEGORICAL_FEATURES)


def test_serving_rows_are_open_in_the_replay_range(built):
    table, risk = built
    lo, hi = (F.lit(t).cast("timestamp") for t in CFG.replay)
    want = table.where((F.col(SPEC.start) < hi) & (F.col(SPEC.end).isNull() | (F.col(SPEC.end) >= lo))).count()
    assert modeling.score_population(table, risk, CFG).count() == want


def test_same_seed_same_scores_and_round_trip(spark, built, tmp_path):
    table, risk = built
    again = modeling.fit_risk_model(table, trials=1, max_rounds=8)
    modeling.save_context(risk, str(tmp_path / "context"))
    loaded = modeling.load_context(spark, str(tmp_path / "context"))
    rows = table.where("split = 'test'")

    def scores(model):
        return {r[0]: r[1] for r in modeling.score_rows(rows, model, explain=False).select("unique_key", "risk").collect()}

    first = scores(risk)
    assert first == scores(again) == scores(loaded)
    assert loaded.replay == tuple(CFG.replay)
    assert loaded.params.keys() == risk.params.keys() and loaded.split_sizes == risk.split_sizes


def test_calibration_gate(spark):
    spread = spark.createDataFrame([(0.1, 0), (0.1, 0), (0.2, 1), (0.3, 0), (0.9, 1), (0.9, 1)], "raw_score double, breach int")
    none, ece = modeling.fit_calibrator(spread, trigger=1.0)
    assert none is None and ece > 0
    fitted, _ = modeling.fit_calibrator(spread, trigger=0.0)
    got = [r["risk"] for r in modeling.apply_calibrator(spread, fitted).orderBy("raw_score").collect()]
    assert got == sorted(got) and got[0] == 0.0 and got[-1] == 1.0 and got[2] == pytest.approx(0.5)
    ends = spark.createDataFrame([(0.0, 0), (1.0, 0)], "raw_score double, breach int")
    assert [r["risk"] for r in modeling.apply_calibrator(ends, fitted).orderBy("raw_score").collect()] == [0.0, 1.0]


SCENARIO = (
    "id int, agency string, complaint_type string, borough string, channel string, created_at timestamp, "
    "agency_open_backlog double, complaint_open_backlog double, agency_arrivals_24h double, agency_closures_24h double, "
    "hist_median_res_hrs_28d double, hist_breach_rate_28d double"
)


def test_scenarios(spark, built):
    table, risk = built
    at = datetime(2024, 1, 22, 3, 0, tzinfo=timezone.utc)
    asked = spark.createDataFrame(
        [
            (1, " aaa ", " noise ", "north", " phone", at, 5.0, 2.0, 40.0, 40.0, 2.0, 0.2),
            (2, "AAA", "Never Seen", "NORTH", "FAX", at, None, None, None, None, None, None),
            (3, "ZZZ", "Noise", "NORTH", "PHONE", at, None, None, None, None, None, None),
            (4, "AAA", " ", "NORTH", "PHONE", at, None, None, None, None, None, None),
            (5, "AAA", "Noise", "NORTH", "PHONE", at, -1.0, None, None, None, None, None),
            (6, "AAA", "Noise", "NORTH", "PHONE", at, None, None, None, None, None, 1.5),
        ],
        SCENARIO,
    )
    scored, refused = modeling.score_scenarios(asked, risk, SPEC)
    rows = {r["id"]: r for r in scored.collect()}
    assert set(rows) == {1, 2}
    assert rows[1]["complaint_type"] == "Noise" and rows[1]["channel"] == "PHONE" and not rows[1]["defaults_used"]
    assert rows[1]["day_of_week"] == 2 and rows[1]["hour_of_day_created"] == 3
    assert rows[2]["complaint_type"] == "Never Seen" and rows[2]["complaint_type_grouped"] == "OTHER_AAA"
    assert rows[2]["sla_source"] == "agency_p75_unseen_complaint_fallback"
    assert len(rows[2]["defaulted_fields"]) == 6 and rows[2]["defaults_used"]
    assert 0 <= rows[2]["risk"] <= 1
    assert {r["id"]: r["_reject_reason"] for r in refused.collect()} == {
        3: "unsupported_group", 4: "complaint_type_empty", 5: "agency_open_backlog_negative",
        6: "hist_breach_rate_28d_above_1",
    }


def noisy(n, seed):
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.normal(size=n), draw.integers(0, 5, n), draw.normal(size=n), np.zeros(n)])
    risk = 1 / (1 + np.exp(-(2 * (x[:, 0] > 0.3) * (x[:, 1] > 2) + x[:, 2] - 1)))
    return x, (draw.random(n) < risk).astype(float)


PARAMS = {"maxDepth": 4, "stepSize": 0.3, "subsamplingRate": 0.8, "featureShare": 0.8, "minChildWeight": 2}


def test_every_name_can_be_another(spark, built):
    """The same tickets under other column names give the same features, scores and scenario answers."""
    names = LifecycleSpec(**{f: f"my_{f}" for f in SPEC.__dataclass_fields__ if f != "closed_value"})
    other = replace(CFG, spec=names)
    back = {getattr(SPEC, f): getattr(names, f) for f in SPEC.__dataclass_fields__ if f != "closed_value"}
    valid = settle(frame(spark, slow_at_night(800)), "valid")

    def scored(rows, cfg):
        spec = cfg.spec
        frozen = features.frozen_targets(features.temporal_split(rows, spec, cfg.splits), cfg)
        table = settle(features.feature_table(rows, cfg, frozen), "table")
        risk = modeling.scoring_context(modeling.fit_risk_model(table, trials=1, max_rounds=4, spec=spec), table, frozen, cfg)
        asked = table.where("split = 'test'").select(
            spec.key, spec.group, spec.subgroup, F.lit("NORTH").alias(spec.region), F.lit("PHONE").alias(spec.channel),
            F.col(spec.start).alias("created_at"), *[F.lit(None).cast("double").alias(c) for c in fixed.DEFAULTABLE_FEATURES])
        population = modeling.score_population(table, risk, cfg).select(F.col(spec.key).alias("k"), "risk", *fixed.FEATURES)
        whatif = modeling.score_scenarios(asked, risk, spec)[0].select(F.col(spec.key).alias("k"), "risk", "sla_target_hours")
        groups = modeling.model_report(table, risk, spec)["per_group"].toDF("group", "n", "pr_auc", "base_rate", "note")
        return [sorted(map(tuple, df.collect())) for df in (population, whatif, groups)]

    mine = scored(valid.withColumnsRenamed(back), other)
    assert mine == scored(valid, CFG) and all(mine)


def test_growing_stops_and_a_model_is_a_prefix():
    (x, y), (vx, vy) = noisy(3000, 1), noisy(1500, 2)
    edges = boosting.bin_edges(x)
    train, val = boosting.Rows(boosting.binned(x, edges), y), boosting.Rows(boosting.binned(vx, edges), vy)
    kept, seen = boosting.boost(train, val, PARAMS, -0.5, 200, 10, 7)
    best = max(range(len(seen)), key=lambda i: (seen[i], -i))
    assert len(kept) == best + 1 and len(seen) == best + 11 < 200
    longer, more = boosting.boost(train, val, PARAMS, -0.5, 200, 40, 7)
    assert more[: len(seen)] == seen and [t.value for t in longer[: len(kept)]] == [t.value for t in kept]
    assert seen[best] > boosting.average_precision(vy, -vx[:, 0]) + 0.1


def test_every_split_is_the_best_one_and_sides_weigh_enough():
    x, y = noisy(400, 3)
    edges = boosting.bin_edges(x)
    rows, slope, curve = boosting.binned(x, edges), 0.4 - y, np.full(len(y), 0.24)
    tree = boosting.grow_tree(rows, slope, curve, np.array([0, 1, 2, 3]), 3, 1.0, 5.0)
    inside = {0: np.ones(len(y), bool)}
    for n in range(len(tree.value)):
        here = inside[n]
        assert tree.value[n] == pytest.approx(-slope[here].sum() / (curve[here].sum() + 1))
        if tree.left[n] < 0:
            continue

        def gain(f, b):
            low = here & (rows[:, f] <= b)
            high = here & ~low
            if min(curve[low].sum(), curve[high].sum()) < 5:
                return 0.0
            return sum(slope[s].sum() ** 2 / (curve[s].sum() + 1) for s in (low, high)) - slope[here].sum() ** 2 / (curve[here].sum() + 1)

        best = max(gain(f, b) for f in range(4) for b in range(64))
        assert gain(tree.feature[n], tree.bin[n]) == pytest.approx(best) and best > 0
        inside[tree.left[n]] = here & (rows[:, tree.feature[n]] <= tree.bin[n])
        inside[tree.right[n]] = here & ~inside[tree.left[n]]


def test_average_precision_takes_ties_together():
    assert boosting.average_precision(np.array([1, 0, 1, 0.0]), np.array([0.9, 0.9, 0.5, 0.1])) == pytest.approx(0.5 * 0.5 + 0.5 * 2 / 3)
    assert boosting.average_precision(np.zeros(3), np.ones(3)) == 0.0


def test_bounded_sample_and_exact_choice(built):
    """With fewer rows to fit on, the draw is still chosen on all validation rows."""
    table, _ = built
    small = modeling.fit_risk_model(table, trials=3, max_rounds=6, fit_rows=100)
    scored = modeling.score_rows(quality.labeled(table.where("split = 'val'")), small, explain=False)
    assert small.val_pr_auc == pytest.approx(metrics.ranking_metrics(scored, "raw_score").first()["pr_auc"])


def grown_tree(depth, draw, ends):
    """A random tree over ``ends``, the thresholds of each column, as arrays."""
    tree = {c: [] for c in ("left", "right", "feature", "threshold", "value")}

    def add(level):
        node = len(tree["value"])
        for c, v in (("left", -1), ("right", -1), ("feature", -1), ("threshold", 0.0), ("value", draw.uniform(-1, 1))):
            tree[c].append(v)
        if level < depth and (level == 0 or draw.random() < 0.95):
            column = draw.randrange(len(ends))
            tree["feature"][node], tree["threshold"][node] = column, draw.choice(ends[column])
            tree["left"][node], tree["right"][node] = add(level + 1), add(level + 1)
        return node

    add(0)
    return {c: np.array(v, float if c in ("threshold", "value") else np.int64) for c, v in tree.items()}


def test_tabled_trees_score_and_explain_as_walked_ones():
    draw = random.Random(5)
    ends = [sorted(draw.uniform(-1, 1) for _ in range(9)) for _ in range(4)]
    grown = [grown_tree(depth, draw, ends) for depth in (0, 1, 3, 6, 6, 8)]
    odd = [math.nan, math.inf, -math.inf]
    x = np.array([[draw.choice(odd + e + [draw.uniform(-2, 2)]) for e in ends] for _ in range(trees.BLOCK + 900)])
    known = trees.thresholds(grown)
    made = [trees.tabled(t, known, 4) for t in grown]
    assert [isinstance(t, trees.Tabled) for t in made] == [True] * 5 + [False]
    margin, credit = np.full(len(x), 0.3), np.zeros((len(x), 4))
    for i, row in enumerate(x):
        for t in grown:
            node = 0
            while t["left"][node] >= 0:
                child = t["left" if row[t["feature"][node]] <= t["threshold"][node] else "right"][node]
                credit[i, t["feature"][node]] += t["value"][child] - t["value"][node]
                node = child
            margin[i] += t["value"][node]
    assert np.array_equal(trees.risk_of(x, made, known, 0.3), 1 / (1 + np.exp(-margin)))
    assert np.array_equal(trees.credit_of(x, made, known, 4), credit)
    assert trees.risk_of(x[:2], [], trees.thresholds([]), 0.0).tolist() == [0.5, 0.5]


def test_the_isotonic_query_scores_validation_rows_once(spark, built, monkeypatch):
    read = []
    fit = modeling.fit_calibrator
    monkeypatch.setattr(model_cases, "fitted", lambda spark, sf: built)
    monkeypatch.setattr(modeling, "fit_calibrator", lambda rows, trigger: read.append(rows) or fit(rows, trigger))
    assert model_cases.isotonic_calibrated(spark, "").count() > 0
    assert "ArrowEvalPython" not in read[0]._jdf.queryExecution().executedPlan().toString()


def training_rows(spark, x, y, vx, vy):
    """Rows as the fit has them, in several partitions; a key comes twice and one is missing."""
    rows = [(None if i == 5 else f"{i // 2 if i < 40 else i}", float(b), held, [float(v) for v in a])
            for held, (xs, ys) in ((False, (x, y)), (True, (vx, vy))) for i, (a, b) in enumerate(zip(xs, ys))]
    return settle(spark.createDataFrame(rows, "_key string, breach double, _is_val boolean, features array<double>").repartition(5), "rows")


def test_bins_of_a_large_table_are_those_of_its_array(spark):
    (x, y), none = noisy(3000, 4), (np.zeros((0, 4)), np.zeros(0))
    rows = training_rows(spark, x, y, *none)
    got, want = boosting_blocks.bin_edges(rows), boosting.bin_edges(x)
    assert [len(e) for e in want] == [63, 4, 63, 0] and all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))


@pytest.mark.parametrize("ranked", [1 << 20, 90])
def test_blocks_grow_the_trees_of_all_rows(spark, ranked):
    """Without shares of rows and columns, blocks give the trees that one task grows on all rows, up to the same one."""
    (x, y), (vx, vy) = noisy(1500, 1), noisy(700, 2)
    edges, rounds = boosting.bin_edges(x), 7
    train, val = boosting.Rows(boosting.binned(x, edges), y), boosting.Rows(boosting.binned(vx, edges), vy)
    draws = [PARAMS | {"subsamplingRate": 1.0, "featureShare": 1.0, "maxDepth": d} for d in (2, 3)]
    rows = training_rows(spark, x, y, vx, vy)
    grown = boosting_blocks.grow_draws(rows, 2200, 700, 300, edges, draws, -0.5, rounds, 3, 7, ranked).toPandas()
    for draw, params in enumerate(draws):
        kept, _ = boosting.boost(train, val, params, -0.5, rounds, 3, 7)
        mine = grown[grown["draw"] == draw].sort_values(["tree", "node"])
        want = pd.concat(boosting.node_rows(draw, kept, edges))
        for column in ("tree", "node", "left", "right", "feature", "threshold", "value"):
            assert mine[column].tolist() == pytest.approx(want[column].tolist()), column


def test_precision_by_ranges_of_counted_scores():
    draw = np.random.default_rng(8)
    score, label = np.round(draw.normal(size=500), 1), draw.integers(0, 2, 500)
    high = score > 0.4
    parts = [boosting.average_precision(label, score)] + [
        boosting_blocks.ranked_precision(score[at], np.ones(at.sum(), int), label[at], *above) / label.sum()
        for at, above in ((high, (0, 0)), (~high, (high.sum(), label[high].sum())))]
    assert parts[0] == pytest.approx(parts[1] + parts[2])


def test_trees_start_from_and_weigh_all_training_rows(built):
    """Beyond the rows of one task nothing is left out: the first odds and the sums at the root are those of all rows."""
    table, whole = built
    rows = quality.labeled(table.where("split = 'train'"))
    n, rate = rows.count(), rows.agg(F.avg("breach")).first()[0]
    small = modeling.fit_risk_model(table, trials=1, max_rounds=2, fit_rows=n // 4)
    assert small.base == pytest.approx(math.log(rate / (1 - rate))) and small.base == pytest.approx(whole.base)
    again = modeling.fit_risk_model(table, trials=1, max_rounds=2, fit_rows=n // 4)
    assert sorted(map(tuple, small.nodes.collect())) == sorted(map(tuple, again.nodes.collect()))
