"""New raw files into the cleaned table, and arrivals per day, by Structured Streaming.

A run takes what has come since the last one (trigger available-now) and ends.  The checkpoint remembers which files
were read, so a run that is repeated, or started again after a loss, adds nothing twice, and the file sink lists only
the files of finished batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens import fixed
from caselens.operators import quality
from caselens.sources import tables
from caselens.spec import LifecycleSpec

REFUSED = "_refused"


def read_new_csv(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The raw extract as a stream of files, every column kept as text."""
    return (
        spark.readStream.schema(tables.all_text(tables.RAW_COLUMNS))
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
    )


def ingest_new(
    spark: SparkSession, path: str, cleaned: str, checkpoint: str, spec: LifecycleSpec,
    raw_channel: str = "open_data_channel_type", max_hours: float = fixed.MAX_RESOLUTION_HOURS,
) -> None:
    """Clean the files that came since the last run and add them to the folder ``cleaned``, partitioned by whether refused (1) or not (0)."""
    raw = tables.with_provenance(read_new_csv(spark, path)).withColumnRenamed(raw_channel, spec.channel)
    tagged = quality.clean(raw, spec, max_hours).withColumn(REFUSED, F.col(quality.REASON).isNotNull().cast("int"))
    tagged.writeStream.format("parquet").option("path", cleaned).option("checkpointLocation", checkpoint).partitionBy(
        REFUSED).trigger(availableNow=True).start().awaitTermination()


def read_cleaned(spark: SparkSession, cleaned: str) -> tuple[DataFrame, DataFrame]:
    """Valid and refused rows of all finished runs; each reads its own files."""
    rows = spark.read.parquet(cleaned)
    return rows.where(F.col(REFUSED) == 0).drop(REFUSED, quality.REASON), rows.where(F.col(REFUSED) == 1).drop(REFUSED)


def count_arrivals(
    spark: SparkSession, cleaned: str, counts: str, checkpoint: str, spec: LifecycleSpec, lateness: str = "7 days",
) -> None:
    """Valid rows per group and day, for the days that ``lateness`` has closed since the last run.

    A day is written once, when the watermark has passed it; a row that comes later than that is not counted.
    """
    rows = spark.readStream.schema(spark.read.parquet(cleaned).schema).parquet(cleaned)
    # The flag is a folder name: only the files of valid rows are listed for reading.
    valid = rows.where(F.col(REFUSED) == 0).withWatermark(spec.start, lateness)
    daily = valid.groupBy(F.window(spec.start, "1 day").alias("day"), F.col(spec.group)).agg(F.count("*").alias("arrivals"))
    daily.select(F.col("day.start").alias("day"), spec.group, "arrivals").writeStream.format("parquet").outputMode("append").option(
        "path", counts).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
