"""Fit, calibrate, evaluate and apply the breach-risk model."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens import fixed
from caselens.functions.columns import blank, number_or_zero
from caselens.operators import boosting, boosting_blocks, features, isotonic, metrics, quality, targets, trees
from caselens.operators.flow import open_during
from caselens.spec import FeatureConfig, LifecycleSpec
from caselens.storage import settle

CODES = [f"{c}_code" for c in fixed.CATEGORICAL_FEATURES]
#: Labelled rows, training and validation together, that one task holds; trees grow on blocks of so many of a larger table.
FIT_ROWS = 1 << 17
INPUTS = [*fixed.NUMERIC_FEATURES, *CODES]
CONTEXT_VALUES = [c for c in fixed.NUMERIC_FEATURES if c not in ("hour_of_day_created", "day_of_week")]


def context_keys(spec: LifecycleSpec) -> tuple[str, ...]:
    return (spec.group, "hour_of_day_created", "day_of_week")


@dataclass
class RiskModel:
    """A fitted model with the frozen tables scoring needs."""

    nodes: DataFrame
    base: float
    encoder: DataFrame
    medians: dict[str, float]
    params: dict[str, float]
    val_pr_auc: float
    val_ece: float
    cut: float
    train_rate: float
    calibrator: DataFrame | None = None
    context: DataFrame | None = None
    overall: DataFrame | None = None
    common: DataFrame | None = None
    targets: DataFrame | None = None
    split_sizes: dict[str, int] = field(default_factory=dict)
    replay: tuple[str, str] | None = None

    @property
    def calibration(self) -> str:
        return "isotonic" if self.calibrator is not None else "none"


def encode(df: DataFrame, encoder: DataFrame) -> DataFrame:
    """Numeric columns coerced, categories coded, all gathered in the array ``features``."""
    coded = features.apply_ordinal(df, encoder, fixed.CATEGORICAL_FEATURES)
    return coded.withColumn("features", F.array(*[number_or_zero(c).cast("double") for c in INPUTS]))


def search_space(trials: int, seed: int) -> list[dict[str, float]]:
    """Seeded draws of depth, rate, row and column shares and least weight of a leaf."""
    draw = random.Random(seed)
    return [
        {
            "maxDepth": draw.randint(4, 6),
            "stepSize": draw.uniform(0.03, 0.08),
            "subsamplingRate": draw.uniform(0.7, 0.9),
            "featureShare": draw.uniform(0.7, 0.9),
            "minChildWeight": draw.randint(1, 7),
        }
        for _ in range(trials)
    ]


def raw_scores(risk: RiskModel, encoded: DataFrame, out: str = "raw_score") -> DataFrame:
    return trees.scores(encoded, risk.nodes, risk.base, out=out)


def fit_calibrator(validation: DataFrame, trigger: float = fixed.CALIBRATION_TRIGGER) -> tuple[DataFrame | None, float]:
    """The knots of an isotonic fit when the validation calibration error is above ``trigger``, and that error."""
    bins = metrics.calibration_bins(validation, "raw_score")
    ece = metrics.expected_calibration_error(bins).first()["ece"]
    if ece is None or ece <= trigger:
        return None, ece
    return settle(isotonic.fit(validation, "raw_score", "breach"), "knots"), ece


def apply_calibrator(scored: DataFrame, calibrator: DataFrame | None) -> DataFrame:
    """``risk`` from ``raw_score``: piecewise linear between knots, else unchanged."""
    if calibrator is None:
        return scored.withColumn("risk", F.col("raw_score"))
    return isotonic.apply(scored, calibrator, "raw_score", "risk")


def fit_rows_of(data: DataFrame) -> tuple[boosting.Rows, boosting.Rows, list[np.ndarray]]:
    """All training and validation rows, binned and in the order of a hash of their key, and the bins' ends."""
    taken = data.withColumn("_place", F.xxhash64("_key")).orderBy("_place", "_key").select("_is_val", "breach", "features").toPandas()
    val = taken["_is_val"].to_numpy(bool)
    x, y = np.vstack(taken["features"].to_numpy()), taken["breach"].to_numpy(float)
    edges = boosting.bin_edges(x[~val])
    learning, held_back = (boosting.Rows(boosting.binned(x[side], edges), y[side]) for side in (~val, val))
    return learning, held_back, edges


def grow(
    data: DataFrame, draws: Sequence[dict[str, float]], max_rounds: int, seed: int, fit_rows: int = FIT_ROWS
) -> tuple[DataFrame, float]:
    """The trees of every draw, grown and stopped on all rows (_key, _is_val, breach, features), and the log-odds they start from."""
    sides = {r["_is_val"]: r for r in data.groupBy("_is_val").agg(F.count("*").alias("n"), F.avg("breach").alias("rate")).collect()}
    rate = min(max(sides[False]["rate"], 1e-6), 1 - 1e-6)
    base = math.log(rate / (1 - rate))
    held_back = sides[True]["n"] if True in sides else 0
    n, stop = sides[False]["n"] + held_back, (max_rounds, fixed.EARLY_STOP_ROUNDS, seed)
    if n <= fit_rows:
        return boosting.grow_draws(data.sparkSession, *fit_rows_of(data), draws, base, *stop), base
    edges = boosting_blocks.bin_edges(data.where(~F.col("_is_val")))
    return boosting_blocks.grow_draws(data, n, held_back, fit_rows, edges, draws, base, *stop), base


def fit_risk_model(
    table: DataFrame,
    trials: int = fixed.SEARCH_TRIALS,
    seed: int = fixed.SEARCH_SEED,
    max_rounds: int = fixed.MAX_ROUNDS,
    trigger: float = fixed.CALIBRATION_TRIGGER,
    fit_rows: int = FIT_ROWS,
    spec: LifecycleSpec = LifecycleSpec(),
) -> RiskModel:
    """Boosted trees over seeded draws; the draw with the best validation PR-AUC is kept.

    ``table`` is a feature table.  Encoders and medians come from labelled
    training rows; trees are grown on all of them.  The number of trees, the choice
    of the draw, calibration and the high-risk cut come from all validation rows.
    Up to ``fit_rows`` rows, a task grows all trees of a draw; more are grown in
    blocks of about ``fit_rows``.
    """
    known = quality.labeled(table).where(F.col("split").isin("train", "val"))
    train = known.where(F.col("split") == "train")
    encoder = features.fit_ordinal(train, fixed.CATEGORICAL_FEATURES)
    encoded = encode(known, encoder).select(
        F.col(spec.key).alias("_key"), F.col("breach").cast("double").alias("breach"), (F.col("split") == "val").alias("_is_val"), "features"
    )
    data = settle(encoded, "training")
    validation = data.where("_is_val")
    draws = search_space(trials, seed)
    grown, base = grow(data, draws, max_rounds, seed, fit_rows)
    grown = settle(grown, "trees")
    judged = metrics.ranking_metrics(
        trees.draw_scores(validation.select(F.col("features").alias("x"), F.col("breach").alias("y")), grown, base), "score", "y", ["draw"]
    ).select("draw", "pr_auc")
    # The first of equal draws is kept.
    at, score = min(((r["draw"], r["pr_auc"] or 0.0) for r in judged.collect()), key=lambda r: (-r[1], r[0]), default=(0, 0.0))
    params, nodes = draws[at], settle(grown.where(F.col("draw") == at).drop("draw"), "model")
    scored_val = settle(trees.scores(validation, nodes, base).select("breach", "raw_score"), "validation")
    calibrator, ece = fit_calibrator(scored_val, trigger)
    cut = metrics.risk_cut(apply_calibrator(scored_val, calibrator), "risk")
    overall = features.global_medians(train, fixed.NUMERIC_FEATURES)
    return RiskModel(
        nodes=nodes,
        base=base,
        encoder=encoder,
        medians={r["feature"]: r["median"] for r in overall.collect()},
        params=params,
        val_pr_auc=score,
        val_ece=ece,
        cut=cut,
        train_rate=metrics.base_rate(train),
        calibrator=calibrator,
        context=features.context_medians(train, context_keys(spec), CONTEXT_VALUES),
        overall=overall,
        split_sizes={r["split"]: r["n"] for r in features.split_rates(quality.labeled(table)).collect() if r["split"]},
    )


def scoring_context(
    risk: RiskModel, table: DataFrame, frozen: DataFrame, cfg: FeatureConfig
) -> RiskModel:
    """Add the frozen targets and common pairs that scenario scoring looks up."""
    risk.targets = frozen
    risk.replay = tuple(cfg.replay)
    risk.common = features.common_types(table.where(F.col("split") == "train"), cfg.spec, cfg.rare_min_n)
    return risk


def score_rows(df: DataFrame, risk: RiskModel, explain: bool = True) -> DataFrame:
    """Risk, risk band and, with ``explain``, contributions and reasons for feature rows."""
    scored = apply_calibrator(raw_scores(risk, encode(df, risk.encoder)), risk.calibrator)
    banded = metrics.risk_band(scored, risk.cut, "risk")
    if explain:
        banded = trees.path_contributions(banded, risk.nodes, len(INPUTS))
        banded = banded.withColumn("top_reasons", trees.top_reasons("contributions", fixed.FEATURES, risk.medians))
    return banded.drop("features", *CODES)


def score_population(table: DataFrame, risk: RiskModel, cfg: FeatureConfig) -> DataFrame:
    """Scored rows that are open at any point of the replay range, labelled or not."""
    return score_rows(open_during(table, cfg.spec, *cfg.replay), risk)


def is_not_finite(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.isnan(value) | (F.abs(value) == F.lit(float("inf")))


def validate_scenarios(df: DataFrame, spec: LifecycleSpec) -> DataFrame:
    """Tag rows with an empty name or a value out of range, first fault wins."""
    named = [spec.group, spec.subgroup, spec.region, spec.channel]
    rules = [(f"{c}_empty", blank(c)) for c in named]
    rules += [(f"{c}_not_finite", is_not_finite(c)) for c in fixed.DEFAULTABLE_FEATURES]
    rules += [(f"{c}_negative", F.col(c) < 0) for c in fixed.DEFAULTABLE_FEATURES]
    rules += [("hist_breach_rate_28d_above_1", F.col("hist_breach_rate_28d") > 1)]
    rules += [("created_at_missing", F.col("created_at").isNull())]
    return quality.tag_rejects(df, rules)


def score_scenarios(
    scenarios: DataFrame, risk: RiskModel, spec: LifecycleSpec
) -> tuple[DataFrame, DataFrame]:
    """What-if rows scored with frozen context, and the rows that were refused.

    Columns: group, subgroup, region, channel, ``created_at`` and the six
    optional operational features.
    """
    tagged = validate_scenarios(scenarios, spec)
    fine, refused = quality.split_rejects(tagged)
    fine = quality.normalize_text(fine, {spec.region: "upper", spec.channel: "upper"})
    named = features.canonicalize(fine, risk.targets, spec)
    timed = features.calendar(
        features.group_rare(named, risk.common, spec).withColumn(spec.start, F.col("created_at")), spec
    )
    known = targets.threshold_for(timed, risk.targets, spec)
    usable, unknown = quality.split_rejects(known)
    filled = features.fill_defaults(usable, risk.context, risk.overall, context_keys(spec), fixed.DEFAULTABLE_FEATURES)
    read = {f: F.col(c) for f, c in features.feature_columns(spec).items() if f != c}
    scored = score_rows(filled.withColumns(read) if read else filled, risk).withColumn("defaults_used", F.size("defaulted_fields") > 0)
    refused = refused.unionByName(unknown.select(*refused.columns))
    return scored.drop("contributions", "raw_score", spec.start), refused


def model_report(
    table: DataFrame, risk: RiskModel, spec: LifecycleSpec, dq: DataFrame | None = None,
    limitations: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """The model card as tables: metrics, per-group metrics, bins, importance, notes."""
    spark = table.sparkSession
    train = quality.labeled(table.where(F.col("split") == "train"))
    test = settle(score_rows(quality.labeled(table.where(F.col("split") == "test")), risk), "test")
    lookup = metrics.rate_lookup(train, spec.pair)
    rated = metrics.baseline_group_rate(test, lookup, spec.pair, risk.train_rate, "group_score")
    summary = (
        metrics.evaluate_constant(test, "B0_base_rate", risk.train_rate)
        .unionByName(metrics.evaluate(rated, "B1_group_lookup", "group_score", key=spec.key))
        .unionByName(metrics.evaluate(test, "boosted_trees", "risk", key=spec.key))
    )
    report = {
        "metrics": summary,
        "per_group": metrics.metrics_by_group(test, spec.group, "risk"),
        "calibration": metrics.calibration_bins(test, "risk"),
        "importance": trees.importance(test, fixed.FEATURES),
        "calibration_method": spark.range(1).select(
            F.lit(risk.calibration).alias("method"), F.lit(risk.val_ece).alias("validation_ece")
        ),
        "limitations": spark.createDataFrame([(t,) for t in limitations], "text string"),
    }
    if dq is not None:
        report["data_quality"] = dq
    return report


def save_context(risk: RiskModel, path: str) -> None:
    """Write the model and its frozen tables below ``path``."""
    spark = risk.encoder.sparkSession
    risk.nodes.write.mode("overwrite").parquet(f"{path}/trees")
    if risk.calibrator is not None:
        risk.calibrator.write.mode("overwrite").parquet(f"{path}/calibrator")
    for name in ("encoder", "context", "overall", "common", "targets"):
        part = getattr(risk, name)
        if part is not None:
            part.write.mode("overwrite").parquet(f"{path}/{name}")
    settings = [("base", risk.base), ("val_pr_auc", risk.val_pr_auc), ("val_ece", risk.val_ece), ("cut", risk.cut), ("train_rate", risk.train_rate),
                ("calibrated", float(risk.calibrator is not None)),
                ("has_lookups", float(risk.common is not None and risk.targets is not None))]
    if risk.replay is not None:
        settings.append(("has_replay", 1.0))
        spark.createDataFrame([risk.replay], "lo string, hi string").write.mode("overwrite").parquet(f"{path}/replay")
    settings += [(f"param.{k}", float(v)) for k, v in risk.params.items()]
    settings += [(f"rows.{k}", float(v)) for k, v in risk.split_sizes.items()]
    spark.createDataFrame(settings, "name string, value double").write.mode("overwrite").parquet(f"{path}/settings")


def load_context(spark: SparkSession, path: str) -> RiskModel:
    settings = {r["name"]: r["value"] for r in spark.read.parquet(f"{path}/settings").collect()}
    overall = spark.read.parquet(f"{path}/overall")
    lookups = bool(settings["has_lookups"])
    return RiskModel(
        nodes=spark.read.parquet(f"{path}/trees"),
        base=settings["base"],
        encoder=spark.read.parquet(f"{path}/encoder"),
        medians={r["feature"]: r["median"] for r in overall.collect()},
        params={k[6:]: v for k, v in settings.items() if k.startswith("param.")},
        val_pr_auc=settings["val_pr_auc"],
        val_ece=settings["val_ece"],
        cut=settings["cut"],
        train_rate=settings["train_rate"],
        calibrator=spark.read.parquet(f"{path}/calibrator") if settings["calibrated"] else None,
        context=spark.read.parquet(f"{path}/context"),
        overall=overall,
        common=spark.read.parquet(f"{path}/common") if lookups else None,
        targets=spark.read.parquet(f"{path}/targets") if lookups else None,
        split_sizes={k[5:]: int(v) for k, v in settings.items() if k.startswith("rows.")},
        replay=tuple(spark.read.parquet(f"{path}/replay").first()) if settings.get("has_replay") else None,
    )
