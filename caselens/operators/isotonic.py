"""Isotonic regression by pool-adjacent-violators, on range partitions.

Neighbours whose means fall are pooled until none do; the order of pooling doesn't matter.  So the points of a range
partition are pooled in its task, in order, and the blocks that are left are pooled once more, all together.  Blocks are
few: their number grows with about the cube root of the points of a noisy label, whatever the table's size.

A fitted curve is the table of its knots (x, y): both ends of every block.  It is flat on a block, a line between two,
and flat outside of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens.storage import settle

BLOCKS = "lo double, hi double, total double, weight double"


def pooled(lo, hi, total, weight) -> list[list[float]]:
    """Blocks (lo, hi, total, weight) of rising means from ordered ones."""
    out: list[list[float]] = []
    for block in zip(lo, hi, total, weight):
        out.append(list(block))
        while len(out) > 1 and out[-2][2] * out[-1][3] >= out[-1][2] * out[-2][3]:
            last = out.pop()
            out[-1] = [out[-1][0], last[1], out[-1][2] + last[2], out[-1][3] + last[3]]
    return out


def _pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of a task's sorted rows; what is held is the blocks so far."""
    blocks: list[list[float]] = []
    for batch in batches:
        rows = [batch.column(c).to_pylist() for c in ("lo", "hi", "total", "weight")]
        blocks = pooled(*([b[i] for b in blocks] + rows[i] for i in range(4)))
    columns = list(zip(*blocks)) or [()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in columns], names=["lo", "hi", "total", "weight"])


def blocks(df: DataFrame, score: str, label: str) -> DataFrame:
    """The blocks of labelled rows, pooled within range partitions; rows of one score are one point."""
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    points = known.groupBy(F.col(score).cast("double").alias("lo")).agg(
        F.sum(F.col(label).cast("double")).alias("total"), F.count("*").cast("double").alias("weight")
    ).select("lo", F.col("lo").alias("hi"), "total", "weight")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settle(points.repartitionByRange(parts, "lo").sortWithinPartitions("lo").mapInArrow(_pool, BLOCKS), "blocks")


def fit(df: DataFrame, score: str, label: str) -> DataFrame:
    """The knots x, y of the rising curve through labelled rows; none without rows."""
    last = blocks(df, score, label).repartition(1).sortWithinPartitions("lo").mapInArrow(_pool, BLOCKS)
    mean = F.col("total") / F.col("weight")
    return last.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("x"), mean.alias("y"))


def knots(curve: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = curve.orderBy("x").toPandas()
    return rows["x"].to_numpy(float), rows["y"].to_numpy(float)


def apply(df: DataFrame, curve: DataFrame, score: str, out: str) -> DataFrame:
    """``out``: the curve at ``score``; without knots, the score itself."""
    x, y = knots(curve)
    if not len(x):
        return df.withColumn(out, F.col(score).cast("double"))
    shipped = df.sparkSession.sparkContext.broadcast((x, y))

    @F.pandas_udf("double")
    def at(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            known = values.notna()
            made = np.full(len(values), np.nan)
            made[known] = np.interp(values[known], *shipped.value)
            yield pd.Series(made).where(known)

    return df.withColumn(out, at(F.col(score).cast("double")))
