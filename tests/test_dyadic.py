"""Covers of ranges, numbered instants and running totals by ranges against plain counting."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from caselens.operators import dyadic, flow
from caselens.operators.prefix import global_total, running_totals
from caselens.plans import serving
from caselens.spec import LifecycleSpec
from test_flow import ZERO, frame
from test_plans_shape import plan

SPEC = LifecycleSpec()


def test_a_cover_holds_every_number_of_the_range_once(spark):
    size, levels = 19, dyadic.levels_for(19)
    ranges = spark.createDataFrame([(a, b) for a in range(size) for b in range(size + 1)], "lo long, hi long")
    rows = dyadic.in_nodes(ranges, dyadic.cover(F.col("lo"), F.col("hi"), levels)).collect()
    held = {}
    for r in rows:
        width = 1 << r["level"]
        held.setdefault((r["lo"], r["hi"]), []).extend(range(r["block"] * width, (r["block"] + 1) * width))
    for a in range(size):
        for b in range(size + 1):
            assert sorted(held.get((a, b), [])) == list(range(a, b))
    points = dyadic.in_nodes(spark.range(size), dyadic.above(F.col("id"), levels)).collect()
    assert {(r["id"], r["level"], r["block"]) for r in points} == {(i, l, i >> l) for i in range(size) for l in range(levels + 1)}


def test_half_a_year_is_a_handful_of_nodes(spark):
    days = spark.range(200).select(F.col("id").alias("lo"), (F.col("id") + 180).alias("hi"))
    nodes = days.select(F.size(dyadic.cover(F.col("lo"), F.col("hi"), dyadic.levels_for(400))).alias("n"))
    assert nodes.agg(F.max("n")).first()[0] <= 16


def spread(n, seed):
    draw, rows = random.Random(seed), []
    for i in range(n):
        start = int(ZERO.timestamp()) + draw.randrange(6 * 86_400)
        end = None if draw.random() < 0.2 else start + draw.choice([0, 60, 3600, 86_400, 4 * 86_400]) + draw.randrange(100) - 50
        rows.append((f"{i:05d}", draw.choice(["AAA", "BBB"]), "x", start, end, "Closed" if end else "Open", "NORTH", "PHONE", None))
    return rows


@pytest.mark.parametrize("per_task", [3, 1 << 20])
def test_every_open_row_meets_every_instant(spark, per_task):
    rows = spread(300, 4)
    instants = [ZERO + timedelta(hours=h) for h in (-5, 0, 1, 24, 47, 48, 100, 143, 300)]
    times = spark.createDataFrame([(t,) for t in instants * 2], "as_of timestamp")
    found = flow.open_as_of_many(frame(spark, rows), SPEC, times, per_task=per_task)
    got = sorted((r["s"], r["unique_key"]) for r in found.select(F.unix_seconds("as_of").alias("s"), "unique_key").collect())
    assert got == sorted((int(t.timestamp()), r[0]) for t in instants for r in rows if r[3] < t.timestamp() and (r[4] is None or r[4] > t.timestamp()))


def test_queue_at_many_instants(spark):
    rows = spread(400, 5)
    risk = {r[0]: round(random.Random(r[0]).random(), 1) for r in rows}
    scored = frame(spark, rows).join(
        spark.createDataFrame(list(risk.items()), "unique_key string, risk double"), "unique_key"
    ).withColumns({"risk_band": F.lit("high"), "sla_target_hours": F.lit(1.0), "breach": F.lit(0)})
    instants = [ZERO + timedelta(minutes=m) for m in (0, 1, 7, 60, 61, 62, 1440, 2880, 2881, 5000, 8000, 9000)] + [ZERO + timedelta(days=40)]
    times = spark.createDataFrame([(t,) for t in [*instants, None]], "as_of timestamp")
    found = serving.replay_queue_many(scored, times, SPEC, ("2024-01-01", "2024-02-01"), limit=7)
    got = {}
    for r in found.withColumn("s", F.unix_seconds("as_of")).collect():
        got.setdefault(r["s"], []).append((r["place"], r["unique_key"], r["total"], r["_reject_reason"]))
    for t in instants[:-1]:
        s = int(t.timestamp())
        open_ = sorted((-risk[r[0]], r[0]) for r in rows if r[3] < s and (r[4] is None or r[4] > s))
        want = [(i, key, len(open_), None) for i, (_, key) in enumerate(open_[:7], 1)] or [(None, None, 0, None)]
        assert sorted(got[s], key=str) == sorted(want, key=str)
    assert got[int(instants[-1].timestamp())] == [(None, None, None, "as_of_out_of_range")]
    assert got[None] == [(None, None, None, "as_of_missing")]
    assert "BroadcastNestedLoopJoin" not in plan(found) and "CartesianProduct" not in plan(found)


def test_tiles_come_from_the_points(spark, partitions):
    """200,000 points inside a thousandth of the axis: no tile holds much more than its share."""
    n, parts = 200_000, 8
    partitions(parts)
    points = spark.range(n).select((F.lit(0.25) + F.col("id") / F.lit(n * 1024.0)).alias("x"), F.lit(1).cast("long").alias("v"))
    runs = running_totals(points, [], "x", ["v"], None)
    assert runs.where(F.abs((F.col("x") - 0.25) * n * 1024 - F.col("before_v")) > 0.01).count() == 0
    tiles = [f for f in runs.inputFiles()]
    sizes = spark.read.parquet(*sorted(set(tiles))).groupBy("_tile").count().collect()
    assert len(sizes) == parts and max(r["count"] for r in sizes) < 1.5 * n / parts


def test_totals_over_everything(spark):
    rows = spark.range(1000).select("id", F.pmod(F.xxhash64("id"), F.lit(50)).alias("x"))
    got = global_total(rows, ["x", "id"], F.col("id"), "sum").collect()
    total = 0
    for r in sorted(got, key=lambda r: (r["x"], r["id"])):
        total += r["id"]
        assert r["sum"] == total
