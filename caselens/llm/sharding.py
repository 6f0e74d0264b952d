"""Sharding by a weighted hash tree of regions, racks and shards.

A row descends from the root.  At each level every child makes a hash draw for the row's
key, ``-ln(u) / weight``, and the least draw wins: a child wins in proportion to its
weight, and its draw does not depend on its siblings.  So when weights change, rows move
only into or out of subtrees whose weights changed.  A child's draw is the least over its
growth *steps*: what a step added to a node draws under a hash of its own, and a row that
follows a step stays in that step's part of the subtree.  A shard that is added to an old
rack therefore takes rows from everywhere but sends none to its neighbours.

The key law: id and tree decide.  Equal ids go to one shard; a null id is a key of its
own.  ``slot`` numbers the rows of a shard without a gap: rows are counted per (shard,
hash tile), tiles are added up, and only rows of one tile are ordered together, so no
shard is ever in one task, nor are the rows of an id that repeats.  Texts of any length are
read for size and checksum only (null: empty); other columns are not read and may have any
name.  Repeated rows get a slot each.  An empty table gives no rows.  Everything is
DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselens.storage import settle

#: Rows of a tile on average; a slot needs a sort of that many.
TILE_ROWS = 4096


@dataclass(frozen=True)
class Leaf:
    """A shard, or a part of one: where it hangs, what it weighs, and the growth step that added it."""

    shard: int
    region: str
    rack: str
    weight: float = 1.0
    step: int = 0


def even_tree(shards: int = 8, per_rack: int = 2, per_region: int = 4) -> list[Leaf]:
    return [Leaf(s, f"region{s // per_region}", f"rack{s // per_rack}") for s in range(shards)]


def grown(tree: list[Leaf], shard: int, region: str, rack: str, weight: float = 1.0) -> list[Leaf]:
    return [*tree, Leaf(shard, region, rack, weight, 1 + max(leaf.step for leaf in tree))]


def _draw(key: Column, node: str, weight: float) -> Column:
    u = (F.conv(F.substring(F.md5(F.concat(key, F.lit("/" + node))), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(
        float(1 << 52)
    )
    return -F.log(u) / F.lit(weight)


def _least(key: Column, names: list[str], weights: list[float]) -> Column:
    """Position of the winning child; one child needs no draw."""
    if len(names) == 1:
        return F.lit(0)
    draws = [F.struct(_draw(key, n, w).alias("d"), F.lit(i).alias("i")) for i, (n, w) in enumerate(zip(names, weights))]
    return F.least(*draws)["i"]


def _descend(key: Column, leaves: list[Leaf], levels: tuple[str, ...], path: str) -> Column:
    if not levels:
        return F.lit(leaves[0].shard)
    groups: dict[str, list[Leaf]] = {}
    for leaf in leaves:
        groups.setdefault(f"{path}/{getattr(leaf, levels[0])}", []).append(leaf)
    names = list(groups)
    won = _least(key, names, [sum(x.weight for x in groups[n]) for n in names])
    below = [_descend(key, groups[n], levels[1:], n) for n in names]
    return below[0] if len(below) == 1 else reduce(
        lambda rest, i: F.when(won == i, below[i]).otherwise(rest), range(len(below) - 2, -1, -1), below[-1]
    )


def shard_of(key: Column, tree: list[Leaf]) -> Column:
    """The shard of a key given as text."""
    by: dict[tuple[int, str], list[Leaf]] = {}
    for leaf in tree:
        by.setdefault((leaf.step, leaf.region), []).append(leaf)
    names = [f"step{s}/{r}" for s, r in by]
    won = _least(key, names, [sum(x.weight for x in part) for part in by.values()])
    below = [_descend(key, part, ("rack", "shard"), n) for n, part in zip(names, by.values())]
    return reduce(lambda rest, i: F.when(won == i, below[i]).otherwise(rest), range(len(below) - 2, -1, -1), below[-1])


def with_slots(rows: DataFrame, order: tuple[str, ...], row: str, shard: str = "shard") -> DataFrame:
    """``slot``: the rows of each shard numbered from 0, by hash tile of ``order`` and then ``order``.

    ``rows`` are written.  Rows that agree in ``order`` share a tile, and may be a third of the table; a tile with more
    rows than usual is cut by ``row``, a number that tells all rows apart.
    """
    n = rows.count()
    tiles = max(1, n // (TILE_ROWS * 8))
    tiled = rows.withColumn("tile", F.pmod(F.xxhash64(*order), F.lit(tiles)))
    wide = tiled.groupBy(shard, "tile").agg(F.ceil(F.count("*") / F.lit(8 * TILE_ROWS)).alias("cuts")).where("cuts > 1")
    wide = settle(wide.select(F.col(shard).alias("s"), F.col("tile").alias("t"), "cuts"), "wide-tiles")
    tiled = tiled.join(wide, (F.col(shard) == F.col("s")) & (F.col("tile") == F.col("t")), "left").withColumn(
        "cut", F.pmod(F.xxhash64(row), F.coalesce("cuts", F.lit(1)))).drop("s", "t", "cuts")
    per = settle(tiled.groupBy(shard, "tile", "cut").agg(F.count("*").alias("n")), "shard-tiles")
    before = per.select(
        F.col(shard).alias("s"), F.col("tile").alias("t"), F.col("cut").alias("c"),
        F.coalesce(
            F.sum("n").over(Window.partitionBy(shard).orderBy("tile", "cut").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before"),
    )
    inside = F.row_number().over(Window.partitionBy(shard, "tile", "cut").orderBy(*order, row)) - 1
    return (
        tiled.withColumn("inside", inside)
        .join(before, (F.col(shard) == F.col("s")) & (F.col("tile") == F.col("t")) & (F.col("cut") == F.col("c")))
        .withColumn("slot", (F.col("before") + F.col("inside")).cast("long"))
        .drop("s", "t", "c", "tile", "cut", "before", "inside")
    )


def shard_documents(docs: DataFrame, tree: list[Leaf], larger: list[Leaf]) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, and the shard in the ``larger`` tree."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    rows = docs.select(
        "doc_id",
        (F.length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, tree).alias("shard"),
        shard_of(key, larger).alias("grown_shard"),
    )
    placed = settle(rows.withColumn("row", F.monotonically_increasing_id()), "sharded")
    return with_slots(placed, ("doc_id", "text_crc32", "size"), "row").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
