"""Raw files that come in two halves, cleaned run by run (order tickets)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselens.checks.common import SPEC, Case
from caselens.checks.quality_cases import CASES as BATCH
from caselens.checks.quality_cases import RAW, raw, rows_of
from caselens.checks.sql import with_
from caselens.storage import settle, shared_path
from caselens.streaming import ingest

#: Rows are valid up to so many days before the last one; later days are still open for late rows.
LATENESS_DAYS = 7


def ingested(spark, sf):
    """The folder of cleaned rows after two runs over two halves and a third one over nothing new."""
    source, cleaned, checkpoint = (shared_path(spark, name) for name in ("incoming", "cleaned", "ingest"))
    rows = settle(raw(spark, sf), "raw")
    for half in (0, 1):
        part = rows.where(F.pmod(F.xxhash64("unique_key"), F.lit(2)) == half)
        part.write.mode("append").option("header", True).option("escape", '"').csv(source)
        ingest.ingest_new(spark, source, cleaned, checkpoint, SPEC)
    ingest.ingest_new(spark, source, cleaned, checkpoint, SPEC)
    return cleaned


def streamed_valid(spark, sf):
    return rows_of(ingest.read_cleaned(spark, ingested(spark, sf))[0])


def streamed_rejects(spark, sf):
    refused = ingest.read_cleaned(spark, ingested(spark, sf))[1]
    return refused.groupBy(F.col("_reject_reason").alias("reject_reason")).agg(F.count("*").alias("n"))


def streamed_arrivals(spark, sf):
    """Closed days, counted in two runs."""
    cleaned = ingested(spark, sf)
    counts, checkpoint = shared_path(spark, "arrivals"), shared_path(spark, "arrivals-run")
    for _ in range(2):
        ingest.count_arrivals(spark, cleaned, counts, checkpoint, SPEC, f"{LATENESS_DAYS} days")
    return spark.read.parquet(counts).select(F.unix_seconds("day").alias("day_s"), SPEC.group, "arrivals")


CASES = {
    "streamed_valid": Case(streamed_valid, BATCH["silver_valid"].sql),
    "streamed_rejects": Case(streamed_rejects, BATCH["reject_counts"].sql),
    "streamed_arrivals": Case(
        streamed_arrivals,
        with_(
            RAW,
            f"""SELECT CAST(floor(start_s / 86400.0) AS BIGINT) * 86400 AS day_s, agency, count(*) AS arrivals FROM tagged WHERE reason IS NULL
  AND (CAST(floor(start_s / 86400.0) AS BIGINT) + 1 + {LATENESS_DAYS}) * 86400 <= (SELECT max(start_s) FROM tagged WHERE reason IS NULL)
GROUP BY ALL""",
        ),
    ),
}
