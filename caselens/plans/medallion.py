"""Raw files to cleaned, labelled and rolled-up tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens import fixed
from caselens.operators import features, flow, quality, targets
from caselens.sources import tables
from caselens.spec import FeatureConfig, LifecycleSpec

REFUSED = "_refused"


def build_bronze(spark: SparkSession, path: str, name: str, multi_line: bool = True) -> DataFrame:
    return tables.save_table(tables.with_provenance(tables.read_raw_csv(spark, path, multi_line=multi_line)), name)


def build_silver(
    bronze: DataFrame,
    spec: LifecycleSpec,
    silver: str,
    rejected: str,
    raw_channel: str = "open_data_channel_type",
    max_hours: float = fixed.MAX_RESOLUTION_HOURS,
) -> tuple[DataFrame, DataFrame]:
    """Valid and refused rows from one cleaning pass, written once.

    The cleaned rows are one table, ``<silver>_cleaned``, partitioned by whether a row was refused; ``silver`` and
    ``rejected`` are views of its two sides, so each reads its own files only.
    """
    renamed = bronze.withColumnRenamed(raw_channel, spec.channel)
    tagged = quality.clean(renamed, spec, max_hours)
    parted = tagged.withColumn(REFUSED, F.col(quality.REASON).isNotNull())
    cleaned = f"{silver}_cleaned"
    tables.save_table(parted, cleaned, replace_schema=True, partition_by=[REFUSED])
    valid = tables.save_view(f"SELECT * EXCEPT ({REFUSED}, {quality.REASON}) FROM {cleaned} WHERE NOT {REFUSED}", silver, bronze.sparkSession)
    refused = tables.save_view(f"SELECT * EXCEPT ({REFUSED}) FROM {cleaned} WHERE {REFUSED}", rejected, bronze.sparkSession)
    return valid, refused


def gold_features(labeled: DataFrame, spec: LifecycleSpec) -> DataFrame:
    """Labelled rows with the seven-day proxy and the seasonal calendar."""
    base = labeled.select(
        spec.key, spec.group, spec.subgroup, spec.region, spec.channel, spec.start, spec.end, spec.is_open, spec.hours,
        targets.TARGET, "breach",
    )
    return features.calendar(flow.recent_unresolved_proxy(base, spec), spec, seasonal=True)


def build_gold(silver: DataFrame, spec: LifecycleSpec, prefix: str, min_n: int = 50) -> dict[str, DataFrame]:
    """Targets, labelled rows, three breach-rate rollups and the feature table."""
    found = targets.group_targets(quality.closed(silver, spec), spec, min_n=min_n)
    labeled = tables.save_table(targets.label_closed(silver, found, spec), f"{prefix}tickets_labeled")
    parts = {
        "sla_targets": found.drop("agency_p75"),
        "metrics_agency": targets.breach_rates(labeled, [spec.group], spec),
        "metrics_complaint": targets.breach_rates(labeled, spec.pair, spec, min_n=min_n),
        "metrics_borough": targets.breach_rates(labeled, [spec.group, spec.region], spec, not_null=[spec.region]),
        "features": gold_features(labeled, spec),
    }
    built = {name: tables.save_table(part, f"{prefix}{name}") for name, part in parts.items()}
    return {"tickets_labeled": labeled, **built}


def build_features(silver: DataFrame, cfg: FeatureConfig, targets_name: str, features_name: str) -> tuple[DataFrame, DataFrame]:
    """Frozen training targets and the point-in-time feature table."""
    split = features.temporal_split(silver, cfg.spec, cfg.splits)
    frozen = tables.save_table(features.frozen_targets(split, cfg), targets_name)
    return frozen, tables.save_table(features.feature_table(silver, cfg, frozen), features_name, replace_schema=True)


def keep_overlong(cleaned: DataFrame) -> DataFrame:
    """Valid rows plus those refused only for lasting too long: they were open too."""
    reason = F.col(quality.REASON)
    return cleaned.where(reason.isNull() | (reason == fixed.REJECT_TOO_LONG)).drop(quality.REASON)
