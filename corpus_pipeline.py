"""From raw documents to token ids: judged, deduplicated, masked, mixed and encoded.

Each stage takes (spark, docs, sf_dir) and gives a table; all but the last keep the columns
of ``documents``.  Between stages the table is written and read again, so a stage never
recomputes another.  Nulls, repeated rows, empty tables and further columns are handled as
the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caselens.llm import jaccard, mixing, pieces, quality, secrets
from caselens.llm.common import table
from caselens.storage import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.masked(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.token_ids(docs.select("doc_id", "lang", "source", "text"), ("doc_id", "lang", "source"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mixture", mixture),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The forest of the first stage can't be said in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None
