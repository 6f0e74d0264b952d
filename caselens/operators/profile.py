"""Profiles of raw tables: blanks, duplicates, value counts, population rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens.functions.columns import blank


def blank_counts(df: DataFrame) -> DataFrame:
    """Blank or NULL values per data column; columns starting with _ are metadata."""
    columns = [c for c in df.columns if not c.startswith("_")]
    return df.agg(*[F.count_if(blank(c)).alias(c) for c in columns])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def negative_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which any of ``columns`` is below zero; must be 0 for backlogs."""
    below = F.exists(F.array(*[F.col(c) for c in columns]), lambda v: v < 0)
    return df.agg(F.count_if(below).alias("negative_rows"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of their key, and how many keys repeat."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
    )


def _unpivot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("_p")).select("_p.column", "_p.value")


def time_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Earliest and latest time per text column, and filled values that do not parse."""
    parsed = _unpivot(df, columns).withColumn("_t", F.try_to_timestamp(F.col("value")))
    return parsed.groupBy("column").agg(
        F.min("_t").alias("min_time"),
        F.max("_t").alias("max_time"),
        F.count_if(F.col("_t").isNull() & ~blank("value")).alias("unparseable"),
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counted = _unpivot(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    return counted.orderBy("column", F.desc("n"), "value")


def top_values(df: DataFrame, column: str, k: int = 15) -> DataFrame:
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), column).limit(k)


def populated_rate(df: DataFrame, column: str, by: str) -> DataFrame:
    """Filled share in percent, one decimal: overall (``level`` = overall) and per group."""
    filled = (~blank(column)).cast("double")
    return (
        df.rollup(by)
        .agg(F.grouping(by).alias("_all"), F.round(F.avg(filled) * 100, 1).alias("populated_pct"))
        .select(F.when(F.col("_all") == 1, F.lit("overall")).otherwise(F.lit("group")).alias("level"), by, "populated_pct")
    )


def monthly_matrix(df: DataFrame, start: str, group: str, groups: Sequence[str]) -> DataFrame:
    """Rows per month and group, 0 where there are none, with row totals."""
    month = F.date_format(F.col(start), "yyyy-MM").alias("month")
    wide = df.where(F.col(group).isin(*groups)).groupBy(month).pivot(group, list(groups)).count().fillna(0)
    total = sum((F.col(f"`{g}`") for g in groups[1:]), F.col(f"`{groups[0]}`"))
    return wide.withColumn("total", total).orderBy("month")


def domains(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values of each dimension, as (column, value) rows."""
    return _unpivot(df, columns).where(F.col("value").isNotNull()).distinct().orderBy("column", "value")


def children_by_parent(df: DataFrame, parent: str, child: str) -> DataFrame:
    pairs = df.where(F.col(parent).isNotNull() & F.col(child).isNotNull()).select(parent, child)
    return pairs.distinct().orderBy(parent, child)


def one_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key in ``order``, so the choice does not depend on the task."""
    others = [c for c in df.columns if c not in keys]
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    first = F.min_by(F.struct(*others), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*")
