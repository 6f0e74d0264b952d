"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

REASON_SCHEMA = (
    "array<struct<feature:string,label:string,value:string,train_median:double,"
    "direction:string,contribution_log_odds:double>>"
)


def seconds(column: str | Column) -> Column:
    """Whole epoch seconds, sub-second part floored."""
    return F.unix_seconds(F.col(column) if isinstance(column, str) else column)


def hours_between(start: str | Column, end: str | Column) -> Column:
    return (seconds(end) - seconds(start)) / F.lit(3600.0)


def day_number(column: str | Column) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(F.to_date(column)).cast("long")


def blank(column: str) -> Column:
    return F.col(column).isNull() | (F.trim(F.col(column).cast("string")) == "")


def finite_or_null(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    broken = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~broken, value)


def number_or_zero(column: str) -> Column:
    """Numbers and numeric strings pass; everything else, NaN included, is 0.0."""
    value = F.col(column).try_cast("double")
    return F.when(F.isnan(value), F.lit(0.0)).otherwise(F.coalesce(value, F.lit(0.0)))


def to_local(column: str | Column, zone: str) -> Column:
    """Wall clock in ``zone`` of an instant, as a zone-free timestamp."""
    value = F.col(column) if isinstance(column, str) else column
    return F.from_utc_timestamp(F.to_utc_timestamp(value, F.current_timezone()), zone).cast("timestamp_ntz")


def local_iso(column: str | Column, zone: str) -> Column:
    """ISO text with offset of a naive timestamp read as wall clock in ``zone``."""
    value = F.col(column) if isinstance(column, str) else column
    wall = value.cast("timestamp")
    instant = F.to_utc_timestamp(wall, zone)
    minutes = ((F.unix_micros(wall) - F.unix_micros(instant)) / F.lit(60_000_000)).cast("int")
    size = F.abs(minutes)
    offset = F.concat(
        F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.floor(size / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )
    micros = F.date_format(wall, ".SSSSSS")
    fraction = F.when(micros != ".000000", micros).otherwise(F.lit(""))
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), fraction, offset)


def parse_reasons(column: str | Column) -> Column:
    """Reasons from JSON text; malformed text or a non-list is an empty list."""
    value = F.col(column) if isinstance(column, str) else column
    text = F.trim(value)
    parsed = F.when(text.startswith("["), F.from_json(text, REASON_SCHEMA))
    return F.coalesce(parsed, F.from_json(F.lit("[]"), REASON_SCHEMA))


def equal_width_edges(n_bins: int) -> list[float]:
    step = 1.0 / n_bins
    return [i * step for i in range(n_bins)] + [1.0]


def bin_index(score: str | Column, n_bins: int) -> Column:
    """Bin whose left edge is included; out-of-range scores go to the end bins."""
    value = F.col(score) if isinstance(score, str) else score
    inner = equal_width_edges(n_bins)[1:-1]
    reached = F.filter(F.array(*[F.lit(e) for e in inner]), lambda edge: edge <= value)
    return F.size(reached)


def weekday(column: str | Column) -> Column:
    """Sunday is 1, Saturday is 7."""
    return F.dayofweek(column)


def first_matching(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule whose condition holds, NULL when none does."""
    return F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in rules])
