"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mixture.  A document of source s is wanted
``target rows * share(s) / rows(s)`` times on average.  How often it comes is a Poisson
draw with that mean: the document's hash is a uniform number, and the draw inverts the
distribution function at it.  A mean above ``STEP`` is split into equal parts that are
drawn from hashes of their own and added, so the inversion stays short at any rate.
Every copy gets a hashed position, by which it is dealt to a partition and ordered there: a
global shuffle in which the rows of a hot source, or of a repeated id, lie as spread as any.

Draws depend on ``doc_id``, the source and the seed alone, so a rerun, a lost executor or
another partitioning changes nothing; the position depends on the text too.  Rows with equal
ids and sources get equal counts, and equal rows equal positions.  A null source is a source;
a null id draws by its text.  An empty table gives an empty mixture.  Texts of any length are
hashed whole.  No column of the input is
dropped; the added names ``copy``, ``rate`` and ``position`` replace columns so named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselens.storage import settle

#: Largest mean of one inversion, and terms of the distribution it looks at: the rest is below 1e-18.
STEP, TERMS = 8.0, 64


def uniform(*parts: Column) -> Column:
    """52 bits of an MD5 digest as a number inside (0, 1)."""
    key = F.concat_ws("|", *parts)
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def inverse_poisson(u: Column, mean: Column) -> Column:
    """The least k whose distribution function reaches u."""
    start = F.struct(
        F.lit(0).alias("k"), F.exp(-mean).alias("term"), F.exp(-mean).alias("total"), F.lit(False).alias("done")
    )

    def further(state: Column, i: Column) -> Column:
        done = state["done"] | (state["total"] >= u)
        term = state["term"] * mean / i
        return F.struct(
            F.when(done, state["k"]).otherwise(i).alias("k"),
            F.when(done, state["term"]).otherwise(term).alias("term"),
            F.when(done, state["total"]).otherwise(state["total"] + term).alias("total"),
            done.alias("done"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, further, lambda s: s["k"])


def sizes_of(docs: DataFrame) -> DataFrame:
    """source, n: rows of each source, written."""
    return settle(docs.groupBy("source").agg(F.count("*").alias("n")), "source-sizes")


def tempered_shares(sizes: DataFrame, alpha: float = 0.5) -> DataFrame:
    """Target shares by source: rows to the power ``alpha``, made to add to one."""
    weight = F.pow("n", F.lit(alpha))
    total = sizes.agg(F.sum(weight)).first()[0]
    return sizes.select("source", (weight / F.lit(total)).alias("share"))


def rates(sizes: DataFrame, shares: DataFrame, size: float = 1.0) -> DataFrame:
    """source, rate: the mean number of copies of a document, for a mixture of ``size`` times the input's rows.

    A source without a share has the rate 0; a share without rows counts for nothing.
    """
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    given = shares.select(F.col("source").alias("s"), "share")
    return sizes.join(given, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", F.coalesce(F.lit(size * total) * F.col("share") / F.col("n"), F.lit(0.0)).alias("rate")
    )


def copies(rate: Column, key: Column, seed: int) -> Column:
    parts = F.greatest(F.ceil(rate / STEP), F.lit(1)).cast("int")
    draws = F.transform(
        F.sequence(F.lit(1), parts),
        lambda i: inverse_poisson(uniform(F.lit(str(seed)), key, i.cast("string")), rate / parts),
    )
    return F.aggregate(draws, F.lit(0), lambda a, b: a + b)


def mix(docs: DataFrame, shares: DataFrame | None = None, size: float = 1.0, seed: int = 11, partitions: int | None = None) -> DataFrame:
    """All copies in shuffled order, with ``copy`` (from 1), ``rate`` and ``position`` (a number in (0, 1)).

    ``shares`` has source and share; without it, tempered shares are taken.
    """
    docs = docs.drop("copy", "rate", "position")
    sizes = sizes_of(docs)
    table = settle(rates(sizes, tempered_shares(sizes) if shares is None else shares, size), "mixing-rates")
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    of = table.withColumnRenamed("source", "rate_source")
    drawn = (
        docs.join(of, F.col("source").eqNullSafe(F.col("rate_source")), "left")
        .drop("rate_source")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), copies(F.col("rate"), key, seed))))
        .where("copy > 0")
        .withColumn("position", uniform(F.lit(f"{seed} place"), key, F.col("copy").cast("string"), F.md5(F.coalesce("text", F.lit("")))))
    )
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return drawn.repartition(n, "position").sortWithinPartitions("position")
