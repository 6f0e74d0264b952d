"""Lifecycle tables derived from the given event and order tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselens.operators.quality import with_duration_hours, with_is_open
from caselens.spec import FeatureConfig, LifecycleSpec

SPEC = LifecycleSpec()

EVENT_CONFIG = FeatureConfig(
    splits={
        "train": ("2024-01-04", "2024-01-16"),
        "val": ("2024-01-18", "2024-01-22"),
        "test": ("2024-01-24", "2024-01-31"),
    },
    observed_at="2024-02-01 00:00:00",
    min_group_n=50,
    rare_min_n=50,
    replay=("2024-01-24", "2024-01-31"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_next(
    df: DataFrame, keys: Sequence[str], time: str, tie: str, out: str, tile_seconds: int = 600
) -> DataFrame:
    """The next time of the same key, NULL for the last row.

    Each (key, time tile) is sorted on its own; the last row of a tile takes
    the first time of the key's next tile, so no task sorts a whole key.  Keys
    must not be NULL.
    """
    tile = F.floor(F.unix_micros(time) / F.lit(tile_seconds * 1_000_000))
    tiled = df.withColumn("_tile", tile)
    inside = Window.partitionBy(*keys, "_tile").orderBy(time, tie)
    heads = tiled.groupBy(*keys, "_tile").agg(F.min(time).alias("_head"))
    following = F.lead("_head").over(Window.partitionBy(*keys).orderBy("_tile"))
    local = tiled.withColumn(out, F.lead(time).over(inside))
    return (
        local.join(heads.select(*keys, "_tile", following.alias("_next_head")), [*keys, "_tile"], "left")
        .withColumn(out, F.coalesce(out, "_next_head"))
        .select(*df.columns, out)
    )


def tickets_from_events(spark: SparkSession, sf_dir: str, with_customer: bool = True) -> DataFrame:
    """One ticket per event; it ends at the same user's next event."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias(SPEC.start), "user_id", "event_type", "props"
    )
    ended = with_next(events, ["user_id"], SPEC.start, "event_id", SPEC.end)
    k = F.get_json_object("props", "$.k").cast("int")
    kind = (
        F.when(k < 40, F.lit("K-COMMON")).when(k < 70, F.lit("K-MID")).when(k < 90, F.lit("K-LOW"))
        .otherwise(F.concat(F.lit("K-RARE"), k.cast("string")))
    )
    if with_customer:
        nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
        places = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
        people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        people = people.join(places, people.c_nationkey == places.n_nationkey, "left")
        ended = ended.join(people, ended.user_id == people.c_custkey, "left")
        region_name, channel = F.col("r_name"), F.col("c_mktsegment")
    else:
        region_name, channel = F.lit(None).cast("string"), F.lit(None).cast("string")
    tickets = ended.select(
        F.col("event_id").cast("string").alias(SPEC.key),
        SPEC.start,
        SPEC.end,
        F.col("event_type").alias(SPEC.group),
        kind.alias(SPEC.subgroup),
        F.lit(None).cast("string").alias(SPEC.detail),
        region_name.alias(SPEC.region),
        channel.alias(SPEC.channel),
        F.when(F.col(SPEC.end).isNotNull(), F.lit("Closed")).otherwise(F.lit("Open")).alias(SPEC.status),
    )
    return with_duration_hours(with_is_open(tickets, SPEC), SPEC)


def raw_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text records, one per order line, with the blemishes the cleaning step handles.

    Order date opens the record and ship date ends it; both are random, so
    most lines break a quality rule.
    """
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    parts, people = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    joined = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .join(people, orders.o_custkey == people.c_custkey)
    )
    text = "yyyy-MM-dd'T'HH:mm:ss.SSS"
    unreadable = (F.col("l_linenumber") == 7) & (F.col("l_quantity") < 5)
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("unique_key"),
        F.when(unreadable, F.lit("pending")).otherwise(F.date_format("o_orderdate", text)).alias("created_date"),
        F.when(F.col("l_quantity") > 48, F.lit(""))
        .otherwise(F.date_format("l_shipdate", text))
        .alias("closed_date"),
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("agency"),
        F.concat(F.col("p_type"), F.lit("  ")).alias("complaint_type"),
        F.when(F.col("p_size") < 10, F.lit("  ")).otherwise(F.concat(F.col("p_brand"), F.lit(', size "'), F.col("p_size").cast("string"), F.lit('"'))).alias("descriptor"),
        F.when(F.col("l_returnflag") == "N", F.lit(" Unspecified "))
        .when(F.col("l_returnflag") == "A", F.lit(""))
        .otherwise(F.lower("c_mktsegment"))
        .alias("borough"),
        F.lower("c_mktsegment").alias("open_data_channel_type"),
        F.when(F.col("l_linestatus") == "F", F.lit(" CLOSED")).otherwise(F.lit("in progress")).alias("status"),
        F.when(F.col("l_tax") > 0.07, F.date_format("l_shipdate", text)).otherwise(F.lit("")).alias("due_date"),
    )
