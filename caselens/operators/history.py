"""Trailing history of closed outcomes, strictly before the day of the start."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens.functions.columns import day_number
from caselens.operators.quality import closed
from caselens.operators.quantiles import trailing_quantile
from caselens.spec import LifecycleSpec
from caselens.storage import settle

DAY_COLUMN = "_day"
MEDIAN = "hist_median_res_hrs_28d"
RATE = "hist_breach_rate_28d"


def daily_outcomes(labeled: DataFrame, spec: LifecycleSpec, target: str = "sla_target_hours") -> DataFrame:
    """Closed outcomes counted per (group, subgroup, end day, duration) and written.

    Durations are whole seconds, so this is far smaller than the rows; all
    history below reads it instead of the rows.
    """
    late = (F.col(spec.hours) > F.col(target)).cast("long")
    rows = closed(labeled, spec).where(F.col(target).isNotNull())
    counted = rows.groupBy(*spec.pair, day_number(spec.end).alias(DAY_COLUMN), F.col(spec.hours).alias("hours")).agg(
        F.count("*").alias("n"), F.sum(late).alias("breaches")
    )
    return settle(counted, "daily")


def trailing_history(
    daily: DataFrame, at: DataFrame, keys: Sequence[str], days: int, median: str = MEDIAN, rate: str = RATE
) -> DataFrame:
    """Median duration and breach rate of outcomes ended in the prior ``days`` days.

    ``at`` lists (keys, ``_day``); one row comes back per distinct entry without
    NULL keys, with NULLs where nothing ended in the look-back.
    """
    spine = at.select(*keys, DAY_COLUMN).dropna().distinct()
    found = trailing_quantile(daily, spine, keys, DAY_COLUMN, "hours", "n", days, {median: 0.5}, sums=["breaches"])
    return spine.join(found, [*keys, DAY_COLUMN], "left").select(
        *keys, DAY_COLUMN, median, (F.col("breaches") / F.col("n")).alias(rate)
    )


def history_for_starts(labeled: DataFrame, daily: DataFrame, spec: LifecycleSpec, days: int) -> DataFrame:
    """History per (group, subgroup, start day): own, else the group's, else 0.

    Own and group history are two levels of one computation.
    """
    spine = labeled.select(*spec.pair, day_number(spec.start).alias(DAY_COLUMN)).distinct()
    keys = [*spec.pair, "_level"]
    found = settle(trailing_history(_levels(daily, spec), _levels(spine, spec), keys, days), "history")
    own = found.where(F.col("_level") == 0).drop("_level")
    group = found.where(F.col("_level") == 1).select(
        spec.group, DAY_COLUMN, F.col(MEDIAN).alias("_group_median"), F.col(RATE).alias("_group_rate")
    )
    return (
        spine.join(own, [*spec.pair, DAY_COLUMN], "left")
        .join(group, [spec.group, DAY_COLUMN], "left")
        .withColumn(MEDIAN, F.coalesce(MEDIAN, "_group_median", F.lit(0.0)))
        .withColumn(RATE, F.coalesce(RATE, "_group_rate", F.lit(0.0)))
        .drop("_group_median", "_group_rate")
    )


def _levels(df: DataFrame, spec: LifecycleSpec) -> DataFrame:
    """Each row for its pair (level 0) and for its group with an empty subgroup (level 1)."""
    both = F.array(
        F.struct(F.lit(0).alias("level"), F.col(spec.subgroup).alias("name")),
        F.struct(F.lit(1).alias("level"), F.lit("").alias("name")),
    )
    exploded = df.withColumn("_l", F.explode(both))
    return exploded.withColumn(spec.subgroup, F.col("_l.name")).withColumn("_level", F.col("_l.level")).drop("_l")
