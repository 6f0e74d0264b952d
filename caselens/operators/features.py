"""Point-in-time features, category grouping, encoders and default values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselens import fixed
from caselens.functions.columns import number_or_zero, seconds
from caselens.operators.flow import SECOND, activity, at_starts, with_second
from caselens.operators.history import DAY_COLUMN, MEDIAN, RATE, daily_outcomes, history_for_starts
from caselens.operators.joins import null_safe_join
from caselens.operators.prefix import DAY, Total
from caselens.operators.quality import closed, fill_category
from caselens.operators.quantiles import group_quantiles
from caselens.operators.targets import group_targets, label_censored
from caselens.spec import FeatureConfig, LifecycleSpec
from caselens.storage import settle


def temporal_split(df: DataFrame, spec: LifecycleSpec, ranges: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Half-open ranges of the start time; rows outside all of them get NULL and stay."""
    start = F.col(spec.start)
    return df.withColumn(
        "split",
        F.coalesce(
            *[
                F.when((start >= F.lit(lo).cast("timestamp")) & (start < F.lit(hi).cast("timestamp")), F.lit(name))
                for name, (lo, hi) in ranges.items()
            ]
        ),
    )


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n")).orderBy("split")


def split_rates(df: DataFrame) -> DataFrame:
    rows = df.where(F.col("breach").isNotNull())
    rates = rows.groupBy("split").agg(F.count("*").alias("n"), F.round(F.avg("breach"), 3).alias("breach_rate"))
    return rates.orderBy("split")


def split_ranges(df: DataFrame, spec: LifecycleSpec) -> DataFrame:
    ranges = df.groupBy("split").agg(F.min(spec.start).alias("min_created"), F.max(spec.start).alias("max_created"))
    return ranges.orderBy("min_created")


def frozen_targets(df: DataFrame, cfg: FeatureConfig, exact: bool = True, closed_before: str | None = None) -> DataFrame:
    """Targets from closed training rows only; ``df`` carries ``split``."""
    train = closed(df.where(F.col("split") == "train"), cfg.spec)
    targets = group_targets(train, cfg.spec, cfg.quantile, cfg.min_group_n, exact, closed_before)
    return targets.withColumnRenamed("n_closed", "n_train_closed")


def common_types(train: DataFrame, spec: LifecycleSpec, min_n: int) -> DataFrame:
    """Pairs with at least ``min_n`` training rows."""
    counts = train.groupBy(*spec.pair).agg(F.count("*").alias("n_train"))
    return settle(counts.where(F.col("n_train") >= min_n), "common")


def group_rare(df: DataFrame, common: DataFrame, spec: LifecycleSpec, out: str = "complaint_type_grouped") -> DataFrame:
    """Common subgroups keep their name, others become ``OTHER_<group>``."""
    marks = common.select(*spec.pair, F.lit(True).alias("_common"))
    return df.join(marks, spec.pair, "left").withColumn(
        out,
        F.when(F.col("_common"), F.col(spec.subgroup)).otherwise(F.concat(F.lit(fixed.OTHER_PREFIX), F.col(spec.group))),
    ).drop("_common")


def calendar(df: DataFrame, spec: LifecycleSpec, seasonal: bool = False) -> DataFrame:
    """Hour and weekday of the start; ``seasonal`` uses the names with month and weekend flag."""
    hour, day = F.hour(spec.start), F.dayofweek(spec.start)
    if not seasonal:
        return df.withColumns({"hour_of_day_created": hour, "day_of_week": day})
    return df.withColumns(
        {
            "created_hour": hour,
            "created_dow": day,
            "created_month": F.month(spec.start),
            "is_weekend": day.isin(1, 7).cast("int"),
        }
    )


def start_features(labeled: DataFrame, cfg: FeatureConfig, population: DataFrame | None = None) -> DataFrame:
    """Backlogs, flows and history per distinct (group, subgroup, start second).

    Everything that is known per start second is joined here, on the small
    side, so that the rows themselves are shuffled once.
    """
    spec = cfg.spec
    seconds_of_pairs = activity(labeled if population is None else population, spec, spec.pair)
    own = at_starts(seconds_of_pairs, spec.pair, {"complaint_open_backlog": Total("net")})
    group = at_starts(
        seconds_of_pairs,
        [spec.group],
        {
            "agency_open_backlog": Total("net"),
            "agency_arrivals_24h": Total("arrivals", cfg.flow_seconds),
            "agency_closures_24h": Total("closures", cfg.flow_seconds),
        },
    )
    history = history_for_starts(labeled, daily_outcomes(labeled, spec), spec, cfg.history_days)
    counts = ["agency_open_backlog", "complaint_open_backlog", "agency_arrivals_24h", "agency_closures_24h"]
    spine = (
        labeled.select(*spec.pair, seconds(spec.start).alias(SECOND)).distinct()
        .join(own, [*spec.pair, SECOND], "left")
        .join(group, [spec.group, SECOND], "left")
        .fillna(0, subset=counts)
        .withColumn(DAY_COLUMN, F.floor(F.col(SECOND) / DAY))
    )
    joined = null_safe_join(spine, history, [*spec.pair, DAY_COLUMN], "left")
    return joined.select(*spec.pair, SECOND, *counts, MEDIAN, RATE)


def feature_table(
    valid: DataFrame,
    cfg: FeatureConfig,
    targets: DataFrame | None = None,
    exact: bool = True,
    population: DataFrame | None = None,
) -> DataFrame:
    """One row per record: identifiers, label, reveal columns and the 12 features.

    Backlog and flow count ``population`` when it is given, for instance valid
    rows together with those refused only for lasting too long.
    """
    spec = cfg.spec
    split = temporal_split(valid, spec, cfg.splits)
    if targets is None:
        targets = frozen_targets(split, cfg, exact)
    labeled = settle(label_censored(split, targets, spec, cfg.observed_at), "labeled")
    common = common_types(labeled.where(F.col("split") == "train"), spec, cfg.rare_min_n)
    rows = null_safe_join(with_second(labeled, spec), start_features(labeled, cfg, population), [*spec.pair, SECOND], "left")
    rows = calendar(fill_category(group_rare(rows, common, spec), spec.region), spec)
    return rows.select(
        spec.key, "split", "breach", "label_state", spec.is_open, "age_at_observation_hours",
        spec.group, spec.subgroup, spec.detail, spec.start, spec.end, spec.hours, spec.status,
        *[F.col(c).alias(f) for f, c in feature_columns(spec).items()],
    )


def feature_columns(spec: LifecycleSpec) -> dict[str, str]:
    """The column each feature is read from: features keep their names, whatever the table calls its columns."""
    return {f: {"borough": spec.region, "channel": spec.channel}.get(f, f) for f in fixed.FEATURES}


def fit_ordinal(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, code): training values in sorted order, numbered from 1."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns])
    values = train.select(F.explode(pairs).alias("_p")).select("_p.*").where(F.col("value").isNotNull()).distinct()
    place = F.row_number().over(Window.partitionBy("feature").orderBy("value"))
    return settle(values.withColumn("code", place), "encoder")


def apply_ordinal(df: DataFrame, encoder: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Add ``<column>_code``; unseen and NULL values get 0."""
    for column in columns:
        codes = encoder.where(F.col("feature") == column).select(
            F.col("value").alias(column), F.col("code").alias(f"{column}{suffix}")
        )
        df = df.join(codes, column, "left").withColumn(f"{column}{suffix}", F.coalesce(f"{column}{suffix}", F.lit(0)))
    return df


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: number_or_zero(c) for c in columns})


def _long_form(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keys, F.explode(pairs).alias("_p")).select(*keys, "_p.feature", "_p.value")


def context_medians(train: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Interpolated median of each column per context; NULL keys form their own context."""
    long = _long_form(train, keys, columns)
    middle = group_quantiles(long, [*keys, "feature"], "value", {"median": 0.5}, None, interpolate=True)
    contexts = train.select(*keys).distinct()
    wide = middle.groupBy(*keys).agg(*[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(c) for c in columns])
    return settle(null_safe_join(contexts, wide, keys, "left"), "context")


def global_medians(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, median) rows over all training rows."""
    long = _long_form(train, [], columns)
    middle = group_quantiles(long, ["feature"], "value", {"median": 0.5}, None, interpolate=True)
    return settle(middle.select("feature", "median"), "medians")


def fill_defaults(
    df: DataFrame, context: DataFrame, overall: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Missing values from the context median, else the global one, recording each.

    ``overall`` is the (feature, median) table: one row per column, so it is
    read as parameters of the query.
    """
    medians = {row["feature"]: row["median"] for row in overall.where(F.col("feature").isin(*columns)).collect()}
    local = context.select(*keys, *[F.col(c).alias(f"_context_{c}") for c in columns])
    joined = df.join(local, list(keys), "left")
    source = {
        c: F.when(
            F.col(c).isNull(),
            F.when(F.col(f"_context_{c}").isNotNull(), F.lit(fixed.SOURCE_CONTEXT_MEDIAN)).otherwise(
                F.lit(fixed.SOURCE_GLOBAL_MEDIAN)
            ),
        )
        for c in columns
    }
    listed = F.array_compact(
        F.array(
            *[
                F.when(source[c].isNotNull(), F.struct(F.lit(c).alias("feature"), source[c].alias("source")))
                for c in columns
            ]
        )
    )
    return (
        joined.withColumn("defaulted_fields", listed)
        .withColumns({c: F.coalesce(F.col(c).cast("double"), f"_context_{c}", F.lit(medians.get(c))) for c in columns})
        .drop(*[f"_context_{c}" for c in columns])
    )


def canonicalize(df: DataFrame, targets: DataFrame, spec: LifecycleSpec) -> DataFrame:
    """Group to upper case; subgroup to the known spelling, else its trimmed text."""
    names = targets.select(
        spec.group, F.lower(F.trim(spec.subgroup)).alias("_folded"), F.col(spec.subgroup).alias("_known")
    ).groupBy(spec.group, "_folded").agg(F.max("_known").alias("_known"))
    trimmed = df.withColumn(spec.group, F.upper(F.trim(spec.group))).withColumn(
        "_folded", F.lower(F.trim(spec.subgroup))
    )
    return (
        trimmed.join(names, [spec.group, "_folded"], "left")
        .withColumn(spec.subgroup, F.coalesce("_known", F.trim(spec.subgroup)))
        .drop("_folded", "_known")
    )
