"""Typing, normalising, quarantine and reconciliation of raw lifecycle records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caselens import fixed
from caselens.functions.columns import blank, first_matching, hours_between
from caselens.operators.quantiles import group_quantiles
from caselens.spec import LifecycleSpec

REASON = "_reject_reason"


def parse_times(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to timestamps; text that does not parse becomes NULL."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c)) for c in columns})


def normalize_text(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """``rules`` maps a column to ``trim``, ``upper`` (codes) or ``initcap`` (statuses)."""
    shapes = {"trim": lambda c: c, "upper": F.upper, "initcap": F.initcap}
    return df.withColumns({c: shapes[rule](F.trim(F.col(c))) for c, rule in rules.items()})


def blank_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.when(~blank(c), F.col(c)) for c in columns})


def sentinel_to_null(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.withColumn(column, F.when(~F.col(column).isin(*values), F.col(column)))


def fill_category(df: DataFrame, column: str, value: str = fixed.UNKNOWN) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def with_is_open(df: DataFrame, spec: LifecycleSpec) -> DataFrame:
    """Open without an end, or when the status is not the closing one.

    An ended row with NULL status is neither open nor closed (NULL).
    """
    return df.withColumn(spec.is_open, F.col(spec.end).isNull() | (F.col(spec.status) != spec.closed_value))


def with_duration_hours(df: DataFrame, spec: LifecycleSpec) -> DataFrame:
    return df.withColumn(spec.hours, hours_between(spec.start, spec.end))


def reject_rules(spec: LifecycleSpec, max_hours: float = fixed.MAX_RESOLUTION_HOURS) -> list[tuple[str, Column]]:
    return [
        (fixed.REJECT_UNPARSEABLE, F.col(spec.start).isNull()),
        (fixed.REJECT_BACKWARDS, F.col(spec.end) < F.col(spec.start)),
        (too_long_reason(max_hours), F.col(spec.hours) > max_hours),
    ]


def too_long_reason(max_hours: float) -> str:
    """The reason names its limit, in days when it is whole days."""
    if max_hours == fixed.MAX_RESOLUTION_HOURS:
        return fixed.REJECT_TOO_LONG
    return f"resolution_exceeds_{max_hours / 24:g}d" if max_hours % 24 == 0 else f"resolution_exceeds_{max_hours:g}h"


def tag_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    return df.withColumn(REASON, first_matching(rules))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(REASON).isNull()).drop(REASON), df.where(F.col(REASON).isNotNull())


def clean(raw: DataFrame, spec: LifecycleSpec, max_hours: float = fixed.MAX_RESOLUTION_HOURS) -> DataFrame:
    """Raw strings to typed, normalised and tagged rows, in one narrow projection."""
    typed = parse_times(raw, [spec.start, spec.end])
    named = normalize_text(
        typed,
        {
            spec.group: "upper",
            spec.subgroup: "trim",
            spec.detail: "trim",
            spec.region: "upper",
            spec.channel: "upper",
            spec.status: "initcap",
        },
    )
    named = sentinel_to_null(blank_to_null(named, [spec.detail]), spec.region, ["UNSPECIFIED", ""])
    timed = with_duration_hours(with_is_open(named, spec), spec)
    return tag_rejects(timed, reject_rules(spec, max_hours)).select(
        F.col(spec.key).cast("string").alias(spec.key),
        spec.start, spec.end, spec.group, spec.subgroup, spec.detail, spec.region, spec.channel,
        spec.status, spec.is_open, spec.hours, REASON,
    )


def closed(df: DataFrame, spec: LifecycleSpec) -> DataFrame:
    return df.where(~F.col(spec.is_open))


def labeled(df: DataFrame, label: str = "breach") -> DataFrame:
    return df.where(F.col(label).isNotNull())


def counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; NULL is a value of its own."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first(column))


def reject_counts(rejected: DataFrame) -> DataFrame:
    return counts(rejected, REASON)


def open_counts(df: DataFrame, spec: LifecycleSpec) -> DataFrame:
    return counts(df, spec.is_open)


def duration_profile(df: DataFrame, spec: LifecycleSpec, exact: bool = True) -> DataFrame:
    """Spread of closed durations: min, median, P75, P95, max, one decimal."""
    rows = closed(df, spec).where(F.col(spec.hours).isNotNull())
    spread = group_quantiles(
        rows, [], spec.hours, {"median_h": 0.5, "p75_h": 0.75, "p95_h": 0.95}, exact=exact
    ).select(F.lit(1).alias("_one"), "median_h", "p75_h", "p95_h")
    ends = rows.agg(F.min(spec.hours).alias("min_h"), F.max(spec.hours).alias("max_h")).withColumn("_one", F.lit(1))
    columns = ["min_h", "median_h", "p75_h", "p95_h", "max_h"]
    return ends.join(spread, "_one").select(*[F.round(c, 1).alias(c) for c in columns])


def reconcile(raw: DataFrame, valid: DataFrame, rejected: DataFrame) -> DataFrame:
    """Row counts of the three tables, their balance, and reject / acceptance rates."""
    sizes = [
        part.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
        for name, part in (("bronze", raw), ("silver", valid), ("rejected", rejected))
    ]
    stacked = sizes[0].unionByName(sizes[1]).unionByName(sizes[2])
    wide = stacked.agg(
        *[F.sum(F.when(F.col("part") == p, F.col("n"))).alias(f"{p}_rows") for p in ("bronze", "silver", "rejected")]
    )
    return wide.select(
        "bronze_rows",
        "silver_rows",
        "rejected_rows",
        (F.col("bronze_rows") == F.col("silver_rows") + F.col("rejected_rows")).alias("balanced"),
        F.try_divide("rejected_rows", "bronze_rows").alias("reject_rate"),
        F.try_divide("silver_rows", "bronze_rows").alias("acceptance_rate"),
    )


@dataclass(frozen=True)
class Watched:
    """Counts that Spark takes while rows are written: all of them, and those of each value of a column.

    They are there once the write is done; reading them scans nothing.
    """

    observation: Observation
    column: str
    values: tuple[str, ...]

    def counts(self) -> dict[str | None, int]:
        """Rows of each value; those without one, or with another, under None."""
        seen = self.observation.get
        known = {v: seen[f"value_{i}"] for i, v in enumerate(self.values)}
        return {**known, None: seen["rows"] - sum(known.values())}


def watch(df: DataFrame, column: str, values: Sequence[str]) -> tuple[DataFrame, Watched]:
    """The rows, to be written once, and what is counted meanwhile."""
    observation = Observation()
    each = [F.count_if(F.coalesce(F.col(column) == v, F.lit(False))).alias(f"value_{i}") for i, v in enumerate(values)]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *each), Watched(observation, column, tuple(values))


def watch_rejects(tagged: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, Watched]:
    return watch(tagged, REASON, [reason for reason, _ in rules])


def reconcile_watched(spark: SparkSession, cleaned: Watched) -> DataFrame:
    """What ``reconcile`` gives, from the counts of the write of the tagged rows."""
    counts = cleaned.counts()
    refused = sum(n for reason, n in counts.items() if reason is not None)
    made = spark.createDataFrame(
        [(counts[None] + refused, counts[None], refused)], "bronze_rows long, silver_rows long, rejected_rows long")
    return made.select(
        "*",
        (F.col("bronze_rows") == F.col("silver_rows") + F.col("rejected_rows")).alias("balanced"),
        F.try_divide("rejected_rows", "bronze_rows").alias("reject_rate"),
        F.try_divide("silver_rows", "bronze_rows").alias("acceptance_rate"),
    )


def dq_summary_watched(spark: SparkSession, cleaned: Watched, labels: Watched) -> DataFrame:
    """What ``dq_summary`` gives, from the counts of the writes of tagged and of labelled rows."""
    reasons, states = cleaned.counts(), labels.counts()
    refused = sum(n for reason, n in reasons.items() if reason is not None)
    rows = [("rows", "bronze_rows", reasons[None] + refused), ("rows", "silver_rows", reasons[None]), ("rows", "rejected_rows", refused)]
    rows += [("rejects_by_reason", name, n) for name, n in reasons.items() if name is not None and n]
    rows += [("label_states", name, n) for name, n in states.items() if n]
    return spark.createDataFrame(rows, "section string, name string, n long")


def dq_summary(raw: DataFrame, valid: DataFrame, rejected: DataFrame, labels: DataFrame) -> DataFrame:
    """Reconciliation, reject reasons and label states as (section, name, n) rows."""
    totals = reconcile(raw, valid, rejected).select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("name"), F.col(c).alias("n"))
                    for c in ("bronze_rows", "silver_rows", "rejected_rows")
                ]
            )
        ).alias("s")
    ).select(F.lit("rows").alias("section"), "s.name", "s.n")
    reasons = rejected.groupBy(F.col(REASON).alias("name")).agg(F.count("*").alias("n"))
    states = labels.groupBy(F.col("label_state").alias("name")).agg(F.count("*").alias("n"))
    return totals.unionByName(reasons.select(F.lit("rejects_by_reason").alias("section"), "name", "n")).unionByName(
        states.select(F.lit("label_states").alias("section"), "name", "n")
    )
