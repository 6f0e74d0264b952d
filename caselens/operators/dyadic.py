"""Ranges of whole numbers as few dyadic nodes, so that ranges and points meet in an equi-join.

Node (level, block) holds the numbers from block * 2^level up to (block + 1) * 2^level.  A range is a union of
at most two nodes per level; a point lies in one node per level.  A range of n numbers that met points one by one
would need n rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _node(level: Column, block: Column) -> Column:
    return F.struct(level.cast("int").alias("level"), block.cast("long").alias("block"))


def cover(lo: Column, hi: Column, levels: int) -> Column:
    """The nodes of [lo, hi), numbers from 0 to 2^levels - 1."""

    def at(level: Column) -> Column:
        # Blocks that lie in the range whole; an odd first one and an even last one belong to no larger block of it.
        width = F.pow(F.lit(2.0), level)
        first, end = F.ceil(lo / width), F.floor(hi / width)
        left = (first % 2 == 1) & (first < end)
        right = (end % 2 == 1) & (end - 1 >= first + first % 2)
        return F.array_compact(F.array(F.when(left, _node(level, first)), F.when(right, _node(level, end - 1))))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))


def above(point: Column, levels: int) -> Column:
    """The nodes a number lies in."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(levels)), lambda level: _node(level, F.floor(point / F.pow(F.lit(2.0), level)))
    )


def levels_for(numbers: int) -> int:
    """Levels that numbers below ``numbers`` need."""
    return max(0, (max(1, numbers) - 1).bit_length())


def in_nodes(df: DataFrame, nodes: Column) -> DataFrame:
    """The rows of ``df`` once per node, with columns ``level`` and ``block``."""
    return df.withColumn("_node", F.explode(nodes)).select(*df.columns, "_node.level", "_node.block")
