"""Exact quantiles per group from counted values.

``percentile`` keeps every distinct value of a group in one buffer.  Here a
histogram finds the bin that holds each wanted rank; only the values of that
bin are then counted and walked.  The histogram is a few rows per group and the
second pass shuffles only the selected bins.

Bins have a width that suits the unit, or come from the data: ``CUTS`` between
the least and the largest value of a group, and as long as a selected bin still
holds more than ``WALKED`` distinct values, ``CUTS`` between its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselens.operators.joins import null_safe_join
from caselens.storage import settle

#: Bins of a group where they come from the data, and values of a bin that are walked by one task.
CUTS, WALKED = 1024, 1 << 18
_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def _ranks(probs: Mapping[str, float], interpolate: bool, total: Column) -> Column:
    """Wanted 1-based ranks with the weight each carries in the answer."""
    wanted = []
    for name, q in probs.items():
        if not interpolate:
            rank = F.greatest(F.ceil(total * F.lit(q)), F.lit(1))
            wanted.append(F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank"), F.lit(1.0).alias("weight")))
            continue
        place = (total - 1) * F.lit(q)
        low = F.floor(place)
        for rank, weight in ((low, F.lit(1.0) - (place - low)), (low + 1, place - low)):
            wanted.append(
                F.struct(
                    F.lit(name).alias("name"), (rank + 1).cast("long").alias("rank"), weight.cast("double").alias("weight")
                )
            )
    return F.filter(F.array(*wanted), lambda w: w["weight"] > 0)


def _bins(
    hist: DataFrame, keys: Sequence[str], probs: Mapping[str, float], interpolate: bool, sums: Sequence[str] = ()
) -> DataFrame:
    """Bins that hold a wanted rank, with the count before them and whole-group sums."""
    whole = Window.partitionBy(*keys)
    climbed = hist.withColumn(
        "_upto", F.sum("_n").over(whole.orderBy("_bin").rowsBetween(*_UP_TO_HERE))
    ).withColumns({"_total": F.sum("_n").over(whole), **{c: F.sum(c).over(whole) for c in sums}})
    base = F.col("_upto") - F.col("_n")
    hits = F.filter(
        _ranks(probs, interpolate, F.col("_total")), lambda w: (w["rank"] > base) & (w["rank"] <= F.col("_upto"))
    )
    return (
        climbed.select(*keys, "_bin", base.alias("_base"), F.col("_total").alias("n"), *sums, hits.alias("_hits"))
        .where(F.size("_hits") > 0)
    )


def _pick(
    counted: DataFrame, keys: Sequence[str], probs: Mapping[str, float], sums: Sequence[str] = ()
) -> DataFrame:
    """Walk the counted values of the selected bins to the wanted ranks."""
    inside = Window.partitionBy(*keys, "_bin").orderBy("_value").rowsBetween(*_UP_TO_HERE)
    walked = counted.withColumn("_upto", F.col("_base") + F.sum("_n").over(inside))
    hit = F.explode(
        F.filter(
            "_hits", lambda w: (w["rank"] > F.col("_upto") - F.col("_n")) & (w["rank"] <= F.col("_upto"))
        )
    )
    picked = walked.select(*keys, "n", *sums, "_value", hit.alias("_hit"))
    return picked.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in ("n", *sums)],
        *[
            F.sum(F.when(F.col("_hit.name") == name, F.col("_value") * F.col("_hit.weight"))).alias(name)
            for name in probs
        ],
    )


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    width: float | Column | None = 1.0,
    interpolate: bool = False,
    exact: bool = True,
    count: str | None = None,
) -> DataFrame:
    """One row per group: ``n`` non-NULL values and one column per entry of ``probs``.

    ``df`` is scanned twice, so it should be a table.  ``width`` is the bin
    width in units of ``value``; it may depend on the key columns; None takes bins from the data.  ``count`` names a
    column that says how often a value occurs.  With ``exact=False`` a mergeable sketch answers in one
    pass; it does not take counted values.
    """
    times = F.lit(1) if count is None else F.col(count)
    rows = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_value"), times.cast("long").alias("_n")
    )
    if not exact:
        return rows.groupBy(*keys).agg(
            F.count("*").alias("n"), *[F.percentile_approx("_value", q).alias(name) for name, q in probs.items()]
        )
    if width is None:
        return _descend(rows, keys, probs, interpolate)
    rows = rows.withColumn("_bin", F.floor(F.col("_value") / F.lit(width)).cast("long"))
    hist = rows.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_n"))
    bins = settle(_bins(hist, keys, probs, interpolate), "bins")
    selected = null_safe_join(rows, bins, [*keys, "_bin"])
    counted = selected.groupBy(*keys, "_bin", "_value").agg(
        F.sum("_n").alias("_n"),
        F.max("_base").alias("_base"),
        F.max("n").alias("n"),
        F.any_value("_hits").alias("_hits"),
    )
    return _pick(counted, keys, probs)


def _cut(low: Column, high: Column) -> Column:
    """The bin of a value between its group's least and largest one."""
    at = F.floor((F.col("_value") - low) * CUTS / (high - low))
    return F.when(high > low, F.least(at, F.lit(CUTS - 1))).otherwise(0).cast("long")


def _descend(rows: DataFrame, keys: Sequence[str], probs: Mapping[str, float], interpolate: bool) -> DataFrame:
    """Quantiles by bins from the data: of a group, then of each selected bin while it is large.

    A value keeps its group; ``_path`` names the bin it is in, ``_base`` the rows of the group below that bin and
    ``_hits`` the wanted ranks in it.
    """
    rows = settle(rows.groupBy(*keys, "_value").agg(F.sum("_n").alias("_n")), "values")
    ends = settle(
        rows.groupBy(*keys).agg(
            F.min("_value").alias("_low"), F.max("_value").alias("_high"), F.sum("_n").alias("n")), "ends")
    tops = ends.withColumns({"_path": F.lit(""), "_base": F.lit(0).cast("long"), "_hits": _ranks(probs, interpolate, F.col("n"))})
    at = rows.withColumn("_path", F.lit(""))
    while True:
        known = null_safe_join(at, tops, [*keys, "_path"]).withColumn("_bin", _cut(F.col("_low"), F.col("_high")))
        hist = known.groupBy(*keys, "_path", "_bin").agg(
            F.sum("_n").alias("_n"), F.min("_value").alias("_low"), F.max("_value").alias("_high"),
            F.count("*").alias("_kinds"), F.max("_base").alias("_under"), F.max("n").alias("n"),
            F.any_value("_hits").alias("_wanted"))
        upto = F.col("_under") + F.sum("_n").over(Window.partitionBy(*keys, "_path").orderBy("_bin").rowsBetween(*_UP_TO_HERE))
        climbed = hist.withColumn("_upto", upto).withColumn("_base", F.col("_upto") - F.col("_n"))
        hits = F.filter("_wanted", lambda w: (w["rank"] > F.col("_base")) & (w["rank"] <= F.col("_upto")))
        bins = settle(climbed.select(*keys, "_path", "_bin", "_low", "_high", "_kinds", "_base", "n", hits.alias("_hits")).where(
            F.size("_hits") > 0), "bins")
        at = known.select(*keys, "_path", "_bin", "_value", "_n")
        large = bins.agg(F.max(F.when(F.col("_low") < F.col("_high"), F.col("_kinds")))).first()[0]
        if large is None or large <= WALKED:
            break
        at = null_safe_join(at, bins.select(*keys, "_path", "_bin"), [*keys, "_path", "_bin"])
        down = F.concat_ws("/", "_path", F.col("_bin").cast("string"))
        at = settle(at.withColumn("_path", down).drop("_bin"), "selected")
        tops = bins.withColumn("_path", down).drop("_bin", "_kinds")
    selected = null_safe_join(at, bins.drop("_low", "_high", "_kinds"), [*keys, "_path", "_bin"])
    inside = Window.partitionBy(*keys, "_path", "_bin").orderBy("_value").rowsBetween(*_UP_TO_HERE)
    walked = selected.withColumn("_upto", F.col("_base") + F.sum("_n").over(inside))
    hit = F.explode(F.filter("_hits", lambda w: (w["rank"] > F.col("_upto") - F.col("_n")) & (w["rank"] <= F.col("_upto"))))
    picked = walked.select(*keys, "n", "_value", hit.alias("_hit"))
    return picked.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[F.sum(F.when(F.col("_hit.name") == name, F.col("_value") * F.col("_hit.weight"))).alias(name) for name in probs])


def trailing_quantile(
    daily: DataFrame,
    at: DataFrame,
    keys: Sequence[str],
    day: str,
    value: str,
    count: str,
    days: int,
    probs: Mapping[str, float],
    width: float = 1.0,
    sums: Sequence[str] = (),
) -> DataFrame:
    """Quantiles over days [t - days, t) for each distinct (keys, day) of ``at``.

    ``daily`` holds counted values per (keys, day).  The histogram, not the
    values, is spread over the look-back; values are fetched only for the bin
    that holds the wanted rank.  ``n`` and the columns in ``sums`` are totals
    over the look-back.  Days without values in it are left out.
    """
    counts = daily.select(
        *keys, F.col(day).alias("_day"), F.col(value).alias("_value"), F.col(count).alias("_n"), *sums,
        F.floor(F.col(value) / F.lit(width)).alias("_bin"),
    )
    spine = at.select(*keys, F.col(day).alias("_at")).distinct()
    spread = F.explode(F.sequence(F.col("_day") + 1, F.col("_day") + days))
    added = [F.sum(c).alias(c) for c in ("_n", *sums)]
    hist = (
        counts.groupBy(*keys, "_day", "_bin").agg(*added)
        .withColumn("_at", spread)
        .join(spine, [*keys, "_at"], "left_semi")
        .groupBy(*keys, "_at", "_bin").agg(*added)
    )
    bins = settle(_bins(hist, [*keys, "_at"], probs, False, sums), "bins")
    back = bins.withColumn("_day", F.explode(F.sequence(F.col("_at") - days, F.col("_at") - 1)))
    counted = (
        counts.drop(*sums).join(back, [*keys, "_day", "_bin"])
        .groupBy(*keys, "_at", "_bin", "_value")
        .agg(
            F.sum("_n").alias("_n"),
            *[F.max(c).alias(c) for c in ("_base", "n", *sums)],
            F.any_value("_hits").alias("_hits"),
        )
    )
    return _pick(counted, [*keys, "_at"], probs, sums).withColumnRenamed("_at", day)
