"""Baselines, ranking metrics, calibration and risk bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens import fixed
from caselens.functions.columns import bin_index
from caselens.operators import quality
from caselens.operators.prefix import global_rank, running_totals
from caselens.operators.quantiles import group_quantiles
from caselens.storage import settle

def base_rate(train: DataFrame, label: str = "breach") -> float:
    return train.agg(F.avg(label)).first()[0]


def baseline_constant(df: DataFrame, rate: float, out: str = "score") -> DataFrame:
    return df.withColumn(out, F.lit(rate).cast("double"))


def rate_lookup(train: DataFrame, keys: Sequence[str], label: str = "breach") -> DataFrame:
    """Mean label per group; rows with a NULL key are left out."""
    rows = train.dropna(subset=list(keys))
    return settle(rows.groupBy(*keys).agg(F.avg(label).alias("group_rate")), "rates")


def baseline_group_rate(
    df: DataFrame, lookup: DataFrame, keys: Sequence[str], rate: float, out: str = "score"
) -> DataFrame:
    """Training rate of the row's group; unseen groups get the training base rate."""
    joined = df.join(lookup, list(keys), "left")
    return joined.withColumn(out, F.coalesce("group_rate", F.lit(rate))).drop("group_rate")


def score_points(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Positives and rows per distinct score, with totals of all higher scores."""
    points = quality.labeled(df, label).groupBy(*keys, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.count("*").alias("n")
    )
    falling = points.withColumn("_falling", -F.col("score"))
    return running_totals(falling, list(keys), "_falling", ["pos", "n"], None)


def ranking_metrics(df: DataFrame, score: str = "score", label: str = "breach", keys: Sequence[str] = ()) -> DataFrame:
    """Average precision, ROC-AUC, Brier score and base rate, per group of ``keys``.

    Tied scores enter together.  A single-class group has NULL PR-AUC and
    ROC-AUC and says so in ``note``.
    """
    points = score_points(df, score, label, keys)
    clipped = F.greatest(F.least("score", F.lit(1.0)), F.lit(0.0))
    neg = F.col("n") - F.col("pos")
    sums = points.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("pos").alias("_pos"),
        F.sum(
            F.col("pos") * (F.col("before_pos") + F.col("pos")) / (F.col("before_n") + F.col("n"))
        ).alias("_precision"),
        F.sum(neg * (F.col("before_pos") + F.col("pos") / F.lit(2.0))).alias("_pairs"),
        F.sum(F.col("pos") * F.pow(clipped - 1, 2) + neg * F.pow(clipped, 2)).alias("_squares"),
    )
    mixed = (F.col("_pos") > 0) & (F.col("_pos") < F.col("n"))
    return sums.select(
        *keys,
        "n",
        F.when(mixed, F.col("_precision") / F.col("_pos")).alias("pr_auc"),
        F.when(mixed, F.col("_pairs") / (F.col("_pos").cast("double") * (F.col("n") - F.col("_pos")))).alias("roc_auc"),
        F.try_divide("_squares", "n").alias("brier"),
        F.try_divide("_pos", "n").alias("base_rate"),
        F.when(~mixed, F.lit("single-class")).alias("note"),
    )


def metrics_by_group(df: DataFrame, group: str, score: str = "score", label: str = "breach") -> DataFrame:
    per_group = ranking_metrics(df, score, label, [group])
    return per_group.select(
        group, "n", "pr_auc", F.when(F.col("note").isNull(), F.col("base_rate")).alias("base_rate"), "note"
    )


def top_fraction(df: DataFrame, score: str, key: str, fraction: float = fixed.TOP_FRACTION) -> DataFrame:
    """The max(1, floor(N * fraction)) best rows, score descending then key ascending.

    The score at the edge comes from running counts per distinct score; only
    rows tied at that score are ranked by key, on all tasks.
    """
    runs = running_totals(
        df.groupBy((-F.col(score).cast("double")).alias("_falling")).agg(F.count("*").alias("n")), [], "_falling", ["n"], None
    )
    runs = settle(runs, "cut")
    size = runs.agg(F.sum("n")).first()[0]
    if not size:
        return df.limit(0)
    wanted = max(1, int(size * fraction))
    edge = runs.where((F.col("before_n") < wanted) & (F.col("before_n") + F.col("n") >= wanted)).first()
    above = df.where(F.col(score) > -edge["_falling"])
    tied = df.where(F.col(score) == -edge["_falling"])
    if edge["before_n"] + edge["n"] == wanted:
        return above.unionByName(tied)
    ranked = global_rank(tied, [F.col(key).cast("string").asc()], "_tie_rank")
    return above.unionByName(ranked.where(F.col("_tie_rank") <= wanted - edge["before_n"]).drop("_tie_rank"))


def top_fraction_metrics(
    df: DataFrame, score: str = "score", label: str = "breach", key: str = "unique_key",
    fraction: float = fixed.TOP_FRACTION,
) -> DataFrame:
    """Precision, lift (NaN without positives) and captured recall of the top rows."""
    whole = df.agg(F.sum(label).alias("_pos"), F.avg(label).alias("_base")).withColumn("_one", F.lit(1))
    top = top_fraction(df.select(score, label, key), score, key, fraction).agg(
        F.avg(label).alias("_rate"), F.sum(label).alias("_hit"), F.count("*").alias("n_top")
    ).withColumn("_one", F.lit(1))
    lift = F.when(F.col("_base") > 0, F.col("_rate") / F.col("_base")).otherwise(F.lit(float("nan")))
    return whole.join(top, "_one").select(
        F.col("_rate").alias("top_decile_precision"),
        lift.alias("top_decile_lift"),
        (F.col("_hit") / F.greatest("_pos", F.lit(1))).alias("top_decile_recall"),
        "n_top",
    )


def evaluate(df: DataFrame, name: str, score: str = "score", label: str = "breach", key: str = "unique_key") -> DataFrame:
    """One model-card row: ranking metrics and top-decile metrics."""
    one = F.lit(1).alias("_one")
    ranked = ranking_metrics(df, score, label).select(one, "pr_auc", "roc_auc", "brier", "base_rate")
    top = top_fraction_metrics(df, score, label, key).select(one, "*")
    return ranked.join(top, "_one").select(
        F.lit(name).alias("model"), "pr_auc", "roc_auc", "brier", "base_rate",
        "top_decile_precision", "top_decile_lift", "top_decile_recall", "n_top",
        F.lit("score_desc_then_unique_key_asc").alias("tie_policy"),
    )


def evaluate_constant(
    df: DataFrame, name: str, rate: float, label: str = "breach", fraction: float = fixed.TOP_FRACTION
) -> DataFrame:
    """A constant score ranks nothing: the top rows hold the base rate at lift 1."""
    sums = df.agg(F.count("*").alias("n"), F.avg(label).cast("double").alias("_rate"))
    clipped = min(max(rate, 0.0), 1.0)
    brier = F.col("_rate") * F.lit((1 - clipped) ** 2) + (1 - F.col("_rate")) * F.lit(clipped**2)
    mixed = (F.col("_rate") > 0) & (F.col("_rate") < 1)
    return sums.select(
        F.lit(name).alias("model"),
        F.when(mixed, F.col("_rate")).alias("pr_auc"),
        F.when(mixed, F.lit(0.5)).alias("roc_auc"),
        brier.alias("brier"),
        F.col("_rate").alias("base_rate"),
        F.col("_rate").alias("top_decile_precision"),
        F.lit(1.0).alias("top_decile_lift"),
        F.lit(fraction).alias("top_decile_recall"),
        F.greatest(F.floor(F.col("n") * fraction), F.lit(1)).alias("n_top"),
        F.lit("analytic_no_ranking").alias("tie_policy"),
    )


def beats_baseline(report: DataFrame, challenger: str, baseline: str) -> DataFrame:
    """Whether the challenger's PR-AUC is above the baseline's."""
    pick = {n: F.max(F.when(F.col("model") == n, F.col("pr_auc"))) for n in (challenger, baseline)}
    return report.agg(pick[challenger].alias("challenger_pr_auc"), pick[baseline].alias("baseline_pr_auc")).withColumn(
        "beats", F.col("challenger_pr_auc") > F.col("baseline_pr_auc")
    )


def calibration_bins(df: DataFrame, score: str = "score", label: str = "breach", n_bins: int = 10) -> DataFrame:
    """Equal-width bins with mean prediction and actual rate; empty bins are left out."""
    return df.groupBy(bin_index(score, n_bins).alias("bin")).agg(
        F.count("*").alias("n"), F.avg(score).alias("mean_pred"), F.avg(label).alias("actual_rate")
    )


def expected_calibration_error(bins: DataFrame) -> DataFrame:
    gap = F.col("n") * F.abs(F.col("mean_pred") - F.col("actual_rate"))
    return bins.agg((F.sum(gap) / F.sum("n")).alias("ece"))


def risk_cut(validation: DataFrame, score: str = "score", fraction: float = fixed.TOP_FRACTION) -> float:
    """Interpolated quantile of validation scores above which a row is high risk."""
    cut = group_quantiles(validation, [], score, {"cut": 1 - fraction}, width=None, interpolate=True)
    return cut.first()["cut"]


def risk_band(df: DataFrame, cut: float, score: str = "score") -> DataFrame:
    return df.withColumn("risk_band", F.when(F.col(score) >= F.lit(cut), F.lit("high")).otherwise(F.lit("normal")))
