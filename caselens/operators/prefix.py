"""Running and trailing totals over a numeric axis, without one-task groups.

A window per group puts a whole group in one task.  Here rows are first summed
per (group, axis point) with map-side combine, points are cut into tiles of a
fixed axis width, each tile is scanned on its own, and the totals of earlier
tiles are added from a tile summary.  One task sees one tile, or one row per
tile of a group, however many rows the group holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselens.storage import settle

DAY = 86_400


@dataclass(frozen=True)
class Total:
    """Sum of ``measure`` over earlier points; ``width`` limits the look-back."""

    measure: str
    width: int | None = None
    inclusive: bool = False


def running_totals(
    points: DataFrame, keys: Sequence[str], axis: str, measures: Sequence[str], grain: float | None
) -> DataFrame:
    """Add ``before_<measure>``: the total over points with a smaller axis value.

    ``points`` must be unique on keys + axis and, with a grain, cheap to scan twice
    (a written table).  Points with a NULL key are left out.  Without a grain, tiles
    are range partitions of the points: of about equal size, wherever the points lie.
    """
    known = points.dropna(subset=[*keys, axis])
    if grain is None:
        tiled = settle(in_ranges(known, [*keys, axis], "_tile"), "tiles")
    else:
        tiled = known.withColumn("_tile", F.floor(F.col(axis) / F.lit(grain)).cast("long"))
    across = Window.partitionBy(*keys).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    carried = tiled.groupBy(*keys, "_tile").agg(*[F.sum(m).alias(m) for m in measures]).select(
        *keys, "_tile", *[F.coalesce(F.sum(m).over(across), F.lit(0)).alias(f"_carry_{m}") for m in measures]
    )
    inside = Window.partitionBy(*keys, "_tile").orderBy(axis).rowsBetween(Window.unboundedPreceding, -1)
    local = tiled.select(
        "*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"before_{m}") for m in measures]
    )
    return local.join(carried, [*keys, "_tile"]).select(
        *points.columns, *[(F.col(f"before_{m}") + F.col(f"_carry_{m}")).alias(f"before_{m}") for m in measures]
    )


def totals_before(
    points: DataFrame,
    at: DataFrame | None,
    keys: Sequence[str],
    axis: str,
    totals: Mapping[str, Total],
    grain: float | None = DAY,
    where: Column | None = None,
) -> DataFrame:
    """Totals over points strictly before each wanted point.

    ``points`` is a written table.  ``at`` lists the wanted keys + axis; without
    it the points of ``points`` that meet ``where`` are wanted.  Points must be
    unique on keys + axis unless ``at`` or a width is given.  A
    trailing total over [t - width, t) is the difference of two running
    totals, so each look-back point joins the same stream as a zero-weight
    probe.
    """
    measures = sorted({t.measure for t in totals.values()})
    widths = [0, *sorted({t.width for t in totals.values() if t.width})]
    marks = [f"_mark_{i}" for i in range(len(widths))]

    def here(total: Total):
        own = F.col(total.measure) if total.inclusive else F.lit(0)
        return F.col(f"before_{total.measure}") + own

    if at is None and len(widths) == 1:
        run = running_totals(points, keys, axis, measures, grain)
        return (run if where is None else run.where(where)).select(*keys, axis, *[here(t).alias(n) for n, t in totals.items()])

    def entry(shift: int, values: Mapping[str, Column]):
        zero = F.lit(0).cast("long")
        return F.struct(
            (F.col(axis) - F.lit(shift)).alias(axis), *[values.get(c, zero).alias(c) for c in [*measures, *marks]]
        )

    one = F.lit(1).cast("long")
    looked_at = [entry(w, {m: one}) for w, m in zip(widths, marks)]
    facts = {m: F.col(m).cast("long") for m in measures}
    if at is None:
        wanted = F.lit(True) if where is None else where
        entries = F.array(entry(0, {**facts, marks[0]: wanted.cast("long")}), *[F.when(wanted, e) for e in looked_at[1:]])
        stream = points.select(*keys, F.explode(F.array_compact(entries)).alias("_e"))
    else:
        stream = points.select(*keys, entry(0, facts).alias("_e")).unionByName(
            at.select(*keys, F.explode(F.array(*looked_at)).alias("_e"))
        )
    merged = stream.groupBy(*keys, F.col(f"_e.{axis}").alias(axis)).agg(
        *[F.sum(f"_e.{c}").alias(c) for c in [*measures, *marks]]
    )
    run = running_totals(settle(merged, "points"), keys, axis, measures, grain)
    if len(widths) == 1:
        return run.where(F.col(marks[0]) > 0).select(*keys, axis, *[here(t).alias(n) for n, t in totals.items()])

    found = F.filter(
        F.array(
            *[
                F.struct(F.lit(i).alias("i"), F.lit(w).alias("w"), F.col(m).alias("n"))
                for i, (w, m) in enumerate(zip(widths, marks))
            ]
        ),
        lambda s: s["n"] > 0,
    )
    folded = run.withColumn("_s", F.explode(found)).withColumn(axis, F.col(axis) + F.col("_s.w"))

    def part(total: Total):
        column = F.when(F.col("_s.i") == 0, here(total))
        if total.width:
            column = column.when(F.col("_s.i") == widths.index(total.width), -F.col(f"before_{total.measure}"))
        return F.sum(column)

    return folded.groupBy(*keys, axis).agg(*[part(t).alias(n) for n, t in totals.items()])


def in_ranges(df: DataFrame, order: Sequence, out: str) -> DataFrame:
    """Rows dealt to tasks by ranges of ``order``, with the number of their range.

    Write the result: a re-run task could see other boundaries.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(parts, *order).withColumn(out, F.spark_partition_id())


def global_total(df: DataFrame, order: Sequence, value: Column, out: str) -> DataFrame:
    """Total of ``value`` over all rows up to and with each row in ``order``, computed on all tasks.

    Rows are range-partitioned and written with their partition number; each
    partition is then summed up on its own and shifted by the totals of the
    partitions before it.
    """
    placed = settle(in_ranges(df.withColumn("_value", value.cast("long")), order, "_part"), "ranked")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_part").agg(F.sum("_value").alias("_n"))
    offsets = sums.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("_sum", F.sum("_value").over(inside))
        .join(offsets, "_part")
        .withColumn(out, (F.col("_sum") + F.col("_offset")).cast("long"))
        .drop("_part", "_sum", "_offset", "_value")
    )


def global_rank(df: DataFrame, order: Sequence, out: str = "rank") -> DataFrame:
    """Row number over the whole frame in ``order``, computed on all tasks."""
    return global_total(df, order, F.lit(1), out)
