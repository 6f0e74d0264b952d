"""The tree against a plain descent, the law of growth, slots and odd rows."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from caselens.llm import sharding

TREE = sharding.even_tree(8)
LARGER = sharding.grown(TREE, 8, "region1", "rack3")


def draw(key, node, weight):
    u = (int(hashlib.md5(f"{key}/{node}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    return -math.log(u) / weight


def least(key, groups):
    if len(groups) == 1:
        return next(iter(groups))
    return min(groups, key=lambda n: draw(key, n, sum(x.weight for x in groups[n])))


def plain(key, tree):
    groups = defaultdict(list)
    for leaf in tree:
        groups[f"step{leaf.step}/{leaf.region}"].append(leaf)
    name = least(key, groups)
    leaves = groups[name]
    for level in ("rack", "shard"):
        groups = defaultdict(list)
        for leaf in leaves:
            groups[f"{name}/{getattr(leaf, level)}"].append(leaf)
        name = least(key, groups)
        leaves = groups[name]
    return leaves[0].shard


def docs(spark, n=4000):
    rows = [(i, f"t{i % 50}é", 0) for i in range(n)] + [(7, "again", 0), (7, "t7é", 0), (None, None, 0), (None, "x", 0), (n + 5, "漢" * 40_000, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, shard int")


def test_matches_a_plain_descent_and_grows_by_law(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TILE_ROWS", 16)
    got = sharding.shard_documents(docs(spark), TREE, LARGER).collect()
    slots = defaultdict(list)
    for r in got:
        key = "none" if r["doc_id"] is None else str(r["doc_id"])
        assert (r["shard"], r["grown_shard"]) == (plain(key, TREE), plain(key, LARGER))
        assert r["grown_shard"] in (r["shard"], 8)
        slots[r["shard"]].append(r["slot"])
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    assert all(abs(len(s) - 500) < 120 for s in slots.values()) and len(slots) == 8
    by = {(r["doc_id"], r["size"]): r["text_crc32"] for r in got}
    assert by[None, 1] == 0 and by[7, 6] == zlib.crc32(b"again") and by[4005, 120_001] == zlib.crc32("漢".encode() * 40_000)


def test_changed_weights_move_rows_only_in_and_out_of_their_subtree(spark):
    heavier = [sharding.Leaf(x.shard, x.region, x.rack, 3.0 if x.shard == 2 else 1.0) for x in TREE]
    keys = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    moved = keys.select(sharding.shard_of(F.col("k"), TREE).alias("a"), sharding.shard_of(F.col("k"), heavier).alias("b")).where("a <> b")
    racks = {x.shard: (x.region, x.rack) for x in TREE}
    pairs = [tuple(r) for r in moved.distinct().collect()]
    assert pairs
    for a, b in pairs:
        # Between regions rows go to the heavier one, between racks to the heavier one, inside it to the heavier shard.
        assert racks[b][0] == "region0"
        if racks[a][0] == "region0":
            assert racks[b][1] == "rack1"
            if racks[a][1] == "rack1":
                assert b == 2


@pytest.mark.parametrize("doc_id", [None, 7])
def test_a_third_of_the_rows_with_one_id_is_cut(spark, monkeypatch, doc_id):
    monkeypatch.setattr(sharding, "TILE_ROWS", 16)
    rows = [(i, f"t{i}") for i in range(4000)] + [(doc_id, "same")] * 1000 + [(doc_id, f"x{i}") for i in range(1000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    made = sharding.shard_documents(frame, TREE, LARGER)
    hot = [r for r in made.collect() if r["doc_id"] == doc_id]
    assert len({r["shard"] for r in hot}) == 1
    for shard in range(8):
        slots = sorted(r["slot"] for r in made.where(F.col("shard") == shard).collect())
        assert slots == list(range(len(slots)))
    # The window that numbers rows works on (shard, tile, cut); none holds much more than the size a tile should have.
    counted = []
    plain_settle = sharding.settle

    def watched(df, label):
        out = plain_settle(df, label)
        if label == "shard-tiles":
            counted.append(out.agg(F.max("n")).first()[0])
        return out

    monkeypatch.setattr(sharding, "settle", watched)
    sharding.shard_documents(frame, TREE, LARGER)
    assert counted and counted[0] < 3 * 8 * 16


def test_empty(spark):
    assert sharding.shard_documents(docs(spark).limit(0), TREE, LARGER).count() == 0
