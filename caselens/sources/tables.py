"""Reading and writing raw extracts, managed tables and exported snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from caselens.spec import LifecycleSpec

# Columns of the raw extract, all text.
RAW_COLUMNS = (
    "unique_key",
    "created_date",
    "closed_date",
    "agency",
    "complaint_type",
    "descriptor",
    "borough",
    "open_data_channel_type",
    "status",
    "due_date",
)


def all_text(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_raw_csv(
    spark: SparkSession, path: str, columns: Sequence[str] = RAW_COLUMNS, multi_line: bool = True
) -> DataFrame:
    """Delimited text with a header, every column kept as text.

    Quoted line breaks need ``multi_line``, which reads each file in one task;
    hand over many files, or pass False when no value holds a line break.
    """
    return (
        spark.read.schema(all_text(columns))
        .option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )


def with_provenance(df: DataFrame) -> DataFrame:
    """Stamp ingest time and source file; ``df`` is a file scan."""
    return df.select(
        "*", F.current_timestamp().alias("_ingested_at"), F.col("_metadata.file_path").alias("_source_file")
    )


def extract_slice(
    df: DataFrame, spec: LifecycleSpec, lo: str, hi: str, groups: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Rows started in [lo, hi) of the listed groups; both conditions reach the scan."""
    start = F.col(spec.start)
    inside = (start >= F.lit(lo).cast("timestamp")) & (start < F.lit(hi).cast("timestamp"))
    return df.where(inside & F.col(spec.group).isin(*groups)).select(*columns)


def read_scored(spark: SparkSession, path: str, spec: LifecycleSpec | None = None) -> DataFrame:
    """Scored rows with a text key and timestamps; columns that already fit are left as they
    are, so filters on them reach the scan."""
    spec = spec or LifecycleSpec()
    scored = spark.read.parquet(path)
    kinds = dict(scored.dtypes)
    fixes = {}
    if kinds[spec.key] != "string":
        fixes[spec.key] = F.col(spec.key).cast("string")
    for column in (spec.start, spec.end):
        if kinds[column] == "string":
            fixes[column] = F.try_to_timestamp(F.col(column))
        elif kinds[column] != "timestamp":
            fixes[column] = F.col(column).cast("timestamp")
    return scored.withColumns(fixes) if fixes else scored


def export_scored(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_records(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """JSON records, one per line or as a one-line list; ``multi_line`` for indented files."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def export_records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def save_table(
    df: DataFrame, name: str, replace_schema: bool = False, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Overwrite a managed table and return a scan of it.

    Without ``replace_schema`` an existing table must keep its columns.
    ``partition_by`` lays the table out by columns that later filters name.
    """
    spark = df.sparkSession
    if not replace_schema and spark.catalog.tableExists(name):
        present = [(f.name, f.dataType) for f in spark.table(name).schema]
        offered = [(f.name, f.dataType) for f in df.schema]
        if present != offered:
            raise ValueError(f"columns of {name} differ; pass replace_schema=True to replace them")
    df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(name)
    return spark.table(name)


def save_view(query: str, name: str, spark: SparkSession) -> DataFrame:
    """Replace a view and return it; a table of that name is left alone and the call fails."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


def require_tables(spark: SparkSession, names: Sequence[str]) -> None:
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise FileNotFoundError(f"missing tables: {', '.join(missing)}")
