"""Written intermediates in the shared folder.

Small summaries (targets, bucket bounds, encoders) are written before they are
joined to a large side.  Catalyst then knows their real size: it broadcasts one
that is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles one that is
not.  The files also survive the loss of executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else the context's, else one below the warehouse.

    A folder that is named is taken at its word.  The warehouse is only a guess, so off a local
    master it must carry a scheme other than ``file:``.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    guess = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    if not usable_guess(guess, spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return guess


def usable_guess(path: str, master: str) -> bool:
    scheme = path.split(":", 1)[0] if "://" in path or path.startswith("file:") else ""
    return master.startswith("local") or scheme not in ("", "file")


def shared_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/caselens-{app}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
