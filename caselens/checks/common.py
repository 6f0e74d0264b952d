"""Frames the registered queries share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens.functions.columns import seconds
from caselens.operators import features, metrics, quality, targets
from caselens.sources import testdata
from caselens.spec import FeatureConfig
from caselens.storage import settle

SPEC = testdata.SPEC
CFG: FeatureConfig = testdata.EVENT_CONFIG
Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    run: Query
    sql: str | None = None


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def start_s(alias: str = "start_s"):
    return seconds(SPEC.start).alias(alias)


def end_s(alias: str = "end_s"):
    return seconds(SPEC.end).alias(alias)


def tickets(spark: SparkSession, sf: str, full: bool = False) -> DataFrame:
    return testdata.tickets_from_events(spark, sf, with_customer=full)


def gold(spark: SparkSession, sf: str, full: bool = False) -> DataFrame:
    rows = settle(tickets(spark, sf, full), "tickets")
    return targets.label_closed(rows, targets.group_targets(quality.closed(rows, SPEC), SPEC), SPEC)


def split(spark: SparkSession, sf: str, full: bool = False) -> DataFrame:
    return features.temporal_split(tickets(spark, sf, full), SPEC, CFG.splits)


def labeled(spark: SparkSession, sf: str, full: bool = False) -> DataFrame:
    rows = settle(split(spark, sf, full), "split")
    frozen = features.frozen_targets(rows, CFG)
    return targets.label_censored(rows, frozen, SPEC, CFG.observed_at)


def scored(spark: SparkSession, sf: str, full: bool = False) -> DataFrame:
    """Rows scored by the training breach rate of their pair."""
    rows = settle(labeled(spark, sf, full), "labeled")
    train = quality.labeled(rows.where(F.col("split") == "train"))
    lookup = metrics.rate_lookup(train, SPEC.pair)
    ranked = metrics.baseline_group_rate(rows, lookup, SPEC.pair, metrics.base_rate(train))
    return ranked.withColumn("score", F.round("score", 9))


def scored_split(spark: SparkSession, sf: str, name: str = "test") -> DataFrame:
    rows = quality.labeled(scored(spark, sf).where(F.col("split") == name))
    return settle(rows.select(SPEC.key, SPEC.group, "breach", "score"), "scored")
