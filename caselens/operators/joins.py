"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; key columns come from the left."""
    renamed = right.select(*[F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def lookup_with_fallback(
    df: DataFrame,
    primary: DataFrame,
    primary_keys: Sequence[str],
    fallback: DataFrame,
    fallback_keys: Sequence[str],
    value: str,
) -> DataFrame:
    """``value`` from the fine lookup, else from the coarse one, else NULL.

    Both lookups must be unique on their keys.  NULL keys match nothing.
    """
    coarse = fallback.select(*fallback_keys, F.col(value).alias("_coarse"))
    return (
        df.join(primary.select(*primary_keys, value), list(primary_keys), "left")
        .join(coarse, list(fallback_keys), "left")
        .withColumn(value, F.coalesce(value, "_coarse"))
        .drop("_coarse")
    )
