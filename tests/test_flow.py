"""Backlog, flow, history and as-of views against brute force, and leakage checks."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from caselens.operators import features, flow, history, quantiles, targets
from caselens.operators.prefix import Total, global_rank, totals_before
from caselens.operators.quality import with_duration_hours, with_is_open
from caselens.operators.quantiles import group_quantiles
from caselens.spec import FeatureConfig, LifecycleSpec
from caselens.storage import settle

SPEC = LifecycleSpec()
ZERO = datetime(2024, 1, 1, tzinfo=timezone.utc)
COLUMNS = "unique_key string, agency string, complaint_type string, s long, e long, status string, borough string, channel string, descriptor string"


def frame(spark, rows):
    df = spark.createDataFrame(rows, COLUMNS)
    timed = df.withColumns({SPEC.start: F.timestamp_seconds("s"), SPEC.end: F.timestamp_seconds("e")}).drop("s", "e")
    return with_duration_hours(with_is_open(timed, SPEC), SPEC)


def random_rows(n, seed, days=6):
    """A hot group with a third of all rows, crowded seconds, and missing ends and names."""
    draw, base = random.Random(seed), int(ZERO.timestamp())
    rows = []
    for i in range(n):
        group = "HOT" if i % 3 == 0 else draw.choice(["A", "B", "C"])
        start = base + draw.choice([draw.randrange(days * 86_400), draw.randrange(days) * 86_400, 3 * 3600])
        end = None if draw.random() < 0.2 else start + draw.choice([0, 1, 60, 3600, draw.randrange(3 * 86_400)])
        kind = draw.choice(["x", "y", None])
        rows.append((f"{i:05d}", group if i % 41 else None, kind, start, end, "Closed" if end else "Open", "R", "P", None))
    return rows


@pytest.fixture(scope="module")
def rows():
    return random_rows(500, 7)


@pytest.fixture(scope="module")
def table(spark, rows):
    return settle(frame(spark, rows), "rows")


@pytest.mark.parametrize("keys", [["agency"], ["agency", "complaint_type"]])
def test_backlog_is_the_interval_join(table, rows, keys):
    place = {"agency": 1, "complaint_type": 2}
    got = {r["unique_key"]: r["n"] for r in flow.backlog(table, SPEC, keys, "n").collect()}
    for row in rows:
        mine = [row[place[k]] for k in keys]
        want = 0
        if None not in mine:
            want = sum(
                1 for o in rows if [o[place[k]] for k in keys] == mine and o[3] < row[3] and (o[4] is None or o[4] >= row[3])
            )
        assert got[row[0]] == want


def test_flow_counts(table, rows):
    got = {r["unique_key"]: (r["agency_arrivals_24h"], r["agency_closures_24h"]) for r in flow.flow_counts(table, SPEC, ["agency"]).collect()}
    for row in rows:
        lo, hi = row[3] - 86_400, row[3]
        same = [o for o in rows if o[1] == row[1] and row[1] is not None]
        want = (sum(lo <= o[3] < hi for o in same), sum(o[4] is not None and lo <= o[4] < hi for o in same))
        assert got[row[0]] == want


def test_opened_so_far(table, rows):
    got = {r["unique_key"]: r["n"] for r in flow.opened_so_far(table, SPEC, "n").collect()}
    for row in rows[:100]:
        assert got[row[0]] == sum(o[1] == row[1] and row[1] is not None and o[3] <= row[3] for o in rows)


def test_totals_cross_tiles(spark):
    points = settle(spark.createDataFrame([("a", t, t) for t in range(-5, 20)], "k string, t long, v long"), "points")
    got = totals_before(points, None, ["k"], "t", {"all": Total("v"), "two": Total("v", 2)}, grain=4).orderBy("t").collect()
    assert len(got) == 25
    for row in got:
        assert row["all"] == sum(range(-5, row["t"]))
        assert row["two"] == sum(v for v in range(max(-5, row["t"] - 2), row["t"]))


def test_edges_of_as_of_are_strict(spark):
    base = int(ZERO.timestamp())
    df = frame(spark, [
        ("starts", "A", "x", base, None, "Open", "R", "P", None),
        ("ends", "A", "x", base - 10, base, "Closed", "R", "P", None),
        ("spans", "A", "x", base - 10, base + 1, "Closed", "R", "P", None),
    ])
    assert [r["unique_key"] for r in flow.open_as_of(df, SPEC, "2024-01-01 00:00:00").collect()] == ["spans"]
    during = flow.open_during(df, SPEC, "2024-01-01", "2024-01-02")
    assert {r["unique_key"] for r in during.collect()} == {"starts", "ends", "spans"}
    with pytest.raises(ValueError):
        flow.check_range("2024-01-02", "2024-01-01", "2024-01-02")


def test_open_as_of_many(spark, table, rows):
    instants = [ZERO + timedelta(hours=h) for h in (0, 3, 30, 72, 200)]
    times = spark.createDataFrame([(t,) for t in instants], "as_of timestamp")
    got = {(r["s"], r["unique_key"]) for r in flow.open_as_of_many(table, SPEC, times).select(F.unix_seconds("as_of").alias("s"), "unique_key").collect()}
    want = {(int(t.timestamp()), o[0]) for t in instants for o in rows
            if o[3] < t.timestamp() and (o[4] is None or o[4] > t.timestamp())}
    assert got == want


@pytest.mark.parametrize("interpolate", [False, True])
def test_quantiles_equal_builtin(table, interpolate):
    mine = group_quantiles(table, ["agency", "complaint_type"], SPEC.hours, {"a": 0.5, "b": 0.75, "c": 0.95}, 2.0, interpolate)
    kind = "percentile_cont" if interpolate else "percentile_disc"
    theirs = table.where("resolution_hours is not null").groupBy("agency", "complaint_type").agg(
        *[F.expr(f"{kind}({q}) within group (order by resolution_hours)").alias(c) for c, q in (("a", 0.5), ("b", 0.75), ("c", 0.95))]
    )

    def key(r):
        return (r["agency"] or "", r["complaint_type"] or "")

    left, right = sorted(mine.collect(), key=key), sorted(theirs.collect(), key=key)
    assert [key(r) for r in left] == [key(r) for r in right]
    for a, b in zip(left, right):
        assert (a["a"], a["b"], a["c"]) == pytest.approx((b["a"], b["b"], b["c"]))


def test_sketch_mode_agrees_on_small_groups(table):
    rows = table.where("not is_open and agency is not null")
    exact = {tuple(r[:2]): r for r in targets.group_targets(rows, SPEC, min_n=40).collect()}
    quick = {tuple(r[:2]): r for r in targets.group_targets(rows, SPEC, min_n=40, exact=False).collect()}
    assert exact == quick and {r["target_source"] for r in exact.values()} == {"group_p75", "agency_p75_fallback"}


def test_targets_count_only_rows_ended_before_the_cutoff(spark):
    base = int(ZERO.timestamp())
    ended = [(f"k{h}", "A", "x", base, base + h * 3600, "Closed", "R", "P", None) for h in (1, 2, 3, 4, 30, 40)]
    cut = targets.group_targets(frame(spark, ended), SPEC, min_n=1, closed_before="2024-01-02").first()
    assert (cut["n_closed"], cut["sla_target_hours"]) == (4, 3.0)
    assert targets.group_targets(frame(spark, ended), SPEC, min_n=1).first()["sla_target_hours"] == 30.0


def test_global_rank(spark, table):
    got = global_rank(table.select("unique_key", "resolution_hours"), [F.col("resolution_hours").desc_nulls_last(), F.col("unique_key")])
    ranked = sorted(got.collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, 501))
    order = [(-r["resolution_hours"] if r["resolution_hours"] is not None else 1e9, r["unique_key"]) for r in ranked]
    assert order == sorted(order)


CFG = FeatureConfig(
    splits={"train": ("2024-01-01", "2024-01-04"), "test": ("2024-01-04", "2024-01-07")},
    observed_at="2024-01-10", min_group_n=5, rare_min_n=5, history_days=3,
)


def test_history_uses_only_previous_days(spark, table, rows):
    split = features.temporal_split(table, SPEC, CFG.splits)
    frozen = features.frozen_targets(split, CFG)
    labeled = settle(targets.label_censored(split, frozen, SPEC, CFG.observed_at), "labeled")
    daily = history.daily_outcomes(labeled, SPEC)
    at = labeled.select("agency", F.unix_date(F.to_date(SPEC.start)).cast("long").alias("_day"))
    got = {(r["agency"], r["_day"]): r for r in history.trailing_history(daily, at, ["agency"], 3).collect()}
    known = {r["unique_key"]: r["sla_target_hours"] for r in labeled.collect()}
    for (agency, day), row in got.items():
        hours = sorted(
            (o[4] - o[3]) / 3600 for o in rows
            if agency is not None and o[1] == agency and o[4] is not None and known[o[0]] is not None and day - 3 <= o[4] // 86_400 < day
        )
        if not hours:
            assert row[history.MEDIAN] is None and row[history.RATE] is None
        else:
            assert row[history.MEDIAN] == pytest.approx(hours[(len(hours) + 1) // 2 - 1])


def test_later_events_change_nothing_earlier(spark, rows):
    """With targets fixed, rows that start or end later leave earlier features as they were."""
    cut = int(ZERO.timestamp()) + 3 * 86_400
    later = [r for r in rows if r[3] < cut]
    altered = [(*r[:4], r[4] if r[4] is not None and r[4] < cut else cut + 86_400 * 2, *r[5:]) for r in later]
    altered = [(*r[:5], "Closed", *r[6:]) for r in altered]
    first, second = frame(spark, rows), frame(spark, altered)
    split = settle(features.temporal_split(first, SPEC, CFG.splits), "split")
    frozen = features.frozen_targets(split, CFG)
    names = ["agency_open_backlog", "complaint_open_backlog", "agency_arrivals_24h", "agency_closures_24h",
             "hist_median_res_hrs_28d", "hist_breach_rate_28d"]
    before = F.col(SPEC.start) < F.timestamp_seconds(F.lit(cut))
    one = {r[0]: r[1:] for r in features.feature_table(first, CFG, frozen).where(before).select("unique_key", *names).collect()}
    two = {r[0]: r[1:] for r in features.feature_table(second, CFG, frozen).where(before).select("unique_key", *names).collect()}
    assert one == two and len(one) == len(later)


def test_features_have_no_gaps(spark, table):
    built = settle(features.feature_table(table, CFG), "features")
    assert built.count() == 500
    backlog = built.where("agency_open_backlog < 0 or complaint_open_backlog < 0 or agency_open_backlog is null")
    assert backlog.count() == 0
    assert built.where("hist_median_res_hrs_28d is null or hist_breach_rate_28d is null").count() == 0
    assert built.where("agency is not null and complaint_type_grouped is null").count() == 0


def test_population_adds_refused_rows_to_the_backlog(spark):
    base = int(ZERO.timestamp())
    valid = [("late", "A", "x", base + 500, base + 600, "Closed", "R", "P", None)]
    refused = [("long", "A", "x", base, base + 400 * 86_400, "Closed", "R", "P", None)]
    frozen = features.frozen_targets(features.temporal_split(frame(spark, valid), SPEC, CFG.splits), CFG)
    built = features.feature_table(frame(spark, valid), CFG, frozen, population=frame(spark, valid + refused))
    assert [(r["unique_key"], r["agency_open_backlog"]) for r in built.collect()] == [("late", 1)]


def test_censored_labels(spark):
    base = int(ZERO.timestamp())
    df = frame(spark, [
        ("closed-late", "A", "x", base, base + 7200, "Closed", "R", "P", None),
        ("closed-exact", "A", "x", base, base + 3600, "Closed", "R", "P", None),
        ("open-old", "A", "x", base, None, "Open", "R", "P", None),
        ("open-young", "A", "x", base + 86_400, None, "Open", "R", "P", None),
        ("unseen-kind", "A", "new", base, base + 36_000, "Closed", "R", "P", None),
        ("unseen-group", "Z", "x", base, base + 36_000, "Closed", "R", "P", None),
        ("no-status", "A", "x", base, base + 60, None, "R", "P", None),
    ])
    known = spark.createDataFrame([("A", "x", 9, 1.0, 2.0, "group_p75")],
                                  "agency string, complaint_type string, n_closed long, sla_target_hours double, agency_p75 double, target_source string")
    got = {r["unique_key"]: (r["breach"], r["label_state"]) for r in targets.label_censored(df, known, SPEC, "2024-01-02 00:30:00").collect()}
    assert got == {
        "closed-late": (1, "closed_outcome"), "closed-exact": (0, "closed_outcome"),
        "open-old": (1, "open_known_breach"), "open-young": (None, "open_censored"),
        "unseen-kind": (1, "closed_outcome"), "unseen-group": (None, "closed_outcome"),
        "no-status": (1, "open_known_breach"),
    }
    gold = {r["unique_key"]: r["breach"] for r in targets.label_closed(df, known, SPEC).collect()}
    assert gold["no-status"] == 0 and gold["open-old"] is None and gold["unseen-kind"] is None


@pytest.mark.parametrize("interpolate", [False, True])
def test_bins_from_the_data_equal_builtin(spark, monkeypatch, interpolate):
    """Values far apart and very close together; small limits force the descent into bins of bins."""
    monkeypatch.setattr(quantiles, "CUTS", 4)
    monkeypatch.setattr(quantiles, "WALKED", 5)
    draw = random.Random(2)
    rows = [(g, draw.choice([1e9, -3.0, 0.0]) * (g != "one") + draw.random() * 1e-6) for g in ["a", "b", None, "one"] for _ in range(300)]
    rows += [("flat", 7.0)] * 50 + [("a", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = {"x": 0.1, "y": 0.5, "z": 0.99}
    mine = {r["k"]: r for r in group_quantiles(df, ["k"], "v", probs, None, interpolate).collect()}
    kind = "percentile_cont" if interpolate else "percentile_disc"
    theirs = df.where("v is not null").groupBy("k").agg(
        F.count("*").alias("n"), *[F.expr(f"{kind}({q}) within group (order by v)").alias(c) for c, q in probs.items()]).collect()
    assert len(mine) == len(theirs)
    for row in theirs:
        assert mine[row["k"]]["n"] == row["n"]
        for c in probs:
            assert mine[row["k"]][c] == pytest.approx(row[c], rel=1e-12, abs=1e-15)
    assert group_quantiles(df.limit(0), ["k"], "v", probs, None).count() == 0
