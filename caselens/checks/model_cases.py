"""The fitted risk model.

Its numbers depend on the fit, so SQL can't give them.  What must hold for any fit is counted by ``model_checks``, row by
row, and SQL expects none broken; the report's baselines don't depend on the fit and are compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from caselens import fixed
from caselens.checks.common import CFG, SPEC, Case, rounded, tickets
from caselens.checks.metric_cases import AP, RANKED, points_sql
from caselens.checks.sql import SCORED, with_
from caselens.operators import features, metrics, quality, trees
from caselens.plans import modeling, serving
from caselens.storage import settle, shared_path

_FITTED: dict[tuple[str, str], tuple[str, str]] = {}


def fitted(spark, sf):
    """The feature table and a model fitted on it, written once per application and input."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _FITTED:
        upper = tickets(spark, sf, full=True).withColumns({SPEC.group: F.upper(SPEC.group), SPEC.region: F.upper(SPEC.region)})
        valid = settle(upper, "tickets")
        frozen = features.frozen_targets(features.temporal_split(valid, SPEC, CFG.splits), CFG)
        built, saved = shared_path(spark, "features"), shared_path(spark, "context")
        features.feature_table(valid, CFG, frozen).write.parquet(built)
        table = spark.read.parquet(built)
        risk = modeling.fit_risk_model(table)
        modeling.save_context(modeling.scoring_context(risk, table, frozen, CFG), saved)
        _FITTED[at] = (built, saved)
    built, saved = _FITTED[at]
    return spark.read.parquet(built), modeling.load_context(spark, saved)


def risk_model_scores(spark, sf):
    """Risk and band of every row open during the replay days."""
    table, risk = fitted(spark, sf)
    scored = modeling.score_population(table, risk, CFG)
    return scored.select(SPEC.key, SPEC.group, "raw_score", "risk", "risk_band")


def isotonic_calibrated(spark, sf):
    """Test scores through an isotonic fit on validation scores."""
    table, risk = fitted(spark, sf)
    encoded = modeling.encode(quality.labeled(table), risk.encoder)
    raw = modeling.raw_scores(risk, encoded).select(SPEC.key, "split", "breach", "raw_score")
    # Written: the fit reads the scores several times.
    validation = settle(raw.where(F.col("split") == "val").select("breach", "raw_score"), "validation")
    calibrator, _ = modeling.fit_calibrator(validation, trigger=0.0)
    return modeling.apply_calibrator(raw.where(F.col("split") == "test"), calibrator).select(SPEC.key, "raw_score", "risk")


def path_contributions(spark, sf):
    table, risk = fitted(spark, sf)
    scored = modeling.score_rows(quality.labeled(table.where(F.col("split") == "test")), risk)
    return scored.select(SPEC.key, F.posexplode("contributions").alias("place", "contribution"))


def top_reasons(spark, sf):
    table, risk = fitted(spark, sf)
    scored = modeling.score_population(table, risk, CFG)
    return scored.select(SPEC.key, F.posexplode("top_reasons").alias("place", "r")).select(SPEC.key, "place", "r.*")


def _report(spark, sf):
    table, risk = fitted(spark, sf)
    return modeling.model_report(table, risk, SPEC, limitations=["Fitted on tickets derived from events."])


def model_metrics(spark, sf):
    return _report(spark, sf)["metrics"]


def model_metrics_by_group(spark, sf):
    return _report(spark, sf)["per_group"]


def importance(spark, sf):
    return _report(spark, sf)["importance"]


def model_calibration(spark, sf):
    return _report(spark, sf)["calibration"]


def score_scenarios(spark, sf):
    """What-if rows made from the test tickets, with most operational values left out."""
    table, risk = fitted(spark, sf)
    asked = table.where(F.col("split") == "test").select(
        SPEC.key,
        F.lower(SPEC.group).alias(SPEC.group),
        F.lower(SPEC.subgroup).alias(SPEC.subgroup),
        SPEC.region,
        SPEC.channel,
        F.col(SPEC.start).alias("created_at"),
        F.when(F.col("day_of_week") == 2, F.col("agency_open_backlog")).cast("double").alias("agency_open_backlog"),
        *[F.lit(None).cast("double").alias(c) for c in fixed.DEFAULTABLE_FEATURES[1:]],
    )
    scored, _ = modeling.score_scenarios(asked, risk, SPEC)
    return scored.select(
        SPEC.key, SPEC.group, SPEC.subgroup, "complaint_type_grouped", "risk", "risk_band", "sla_target_hours",
        "sla_source", F.size("top_reasons").alias("n_reasons"), F.size("defaulted_fields").alias("n_defaulted"), "defaults_used",
    )


def overview(spark, sf):
    table, risk = fitted(spark, sf)
    report = modeling.model_report(table, risk, SPEC)
    population = modeling.score_population(table, risk, CFG)
    tagged = settle(quality.tag_rejects(tickets(spark, sf), quality.reject_rules(SPEC, 72)), "tagged")
    reconciled = quality.reconcile(tagged, *quality.split_rejects(tagged))
    summary = serving.snapshot_summary(population, SPEC, CFG.replay)
    return serving.overview(summary, report, reconciled, "boosted_trees", "B1_group_lookup")


def model_checks(spark, sf):
    """name, broken: how many rows break a rule that holds for any fitted model."""
    table, risk = fitted(spark, sf)
    test = quality.labeled(table.where(F.col("split") == "test"))
    scored = settle(modeling.score_rows(test, risk), "scored")
    population = settle(modeling.score_population(table, risk, CFG), "population")
    start = risk.base + risk.nodes.where("node = 0").agg(F.sum("value")).first()[0]
    credit = F.aggregate("contributions", F.lit(0.0), lambda a, c: a + c)
    rising = F.slice(F.reverse(F.array_sort(F.filter("contributions", lambda c: c > 0))), 1, 3)
    told = F.transform("top_reasons", lambda r: r["contribution_log_odds"])
    means = scored.select(F.posexplode("contributions").alias("i", "c")).groupBy("i").agg(F.avg(F.abs("c")).alias("mean"))
    named = means.select(F.element_at(F.array(*map(F.lit, fixed.FEATURES)), F.col("i") + 1).alias("feature"), "mean")
    saved = shared_path(spark, "context")
    modeling.save_context(modeling.scoring_context(risk, table, risk.targets, CFG), saved)
    again = modeling.score_rows(test, modeling.load_context(spark, saved), explain=False).select(SPEC.key, F.col("risk").alias("again"))
    broken = {
        "band_is_not_risk_at_the_cut": (population, (F.col("risk") >= risk.cut) != (F.col("risk_band") == "high")),
        "bin_without_rows_or_out_of_range": (metrics.calibration_bins(scored, "risk"), ~F.col("bin").between(0, 9) | (F.col("n") < 1)),
        "contributions_and_log_odds_differ": (scored, F.abs(F.ln(F.col("raw_score") / (1 - F.col("raw_score"))) - start - credit) > 1e-6),
        "importance_is_not_the_mean": (
            trees.importance(scored, fixed.FEATURES).join(named, "feature", "left"),
            F.coalesce(F.abs(F.col("mean") - F.col("mean_abs_contribution")) > 1e-9, F.lit(True))),
        "node_is_not_between_its_children": (risk.nodes, (F.col("left") >= 0) != (F.col("right") >= 0)),
        "population_row_not_open_in_replay": (population, ~_open_in_replay()),
        "open_row_not_in_population": (
            table.where(_open_in_replay()).join(population.select(SPEC.key), SPEC.key, "left_anti"), F.lit(True)),
        "reasons_are_not_the_largest": (scored, told != rising),
        "risk_outside_0_1": (population, ~F.col("risk").between(0, 1)),
        "score_changes_in_a_round_trip": (
            scored.select(SPEC.key, "risk").join(again, SPEC.key, "full"), F.coalesce(F.col("risk") != F.col("again"), F.lit(True))),
        "tree_past_the_last_round": (risk.nodes, F.col("tree") >= fixed.MAX_ROUNDS),
    }
    rows = [df.agg(F.lit(name).alias("name"), F.count(F.when(rule, 1)).alias("broken")) for name, (df, rule) in broken.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


def _open_in_replay():
    lo, hi = (F.lit(t).cast("timestamp") for t in CFG.replay)
    return (F.col(SPEC.start) < hi) & (F.col(SPEC.end).isNull() | (F.col(SPEC.end) >= lo))


_CHECKED = (
    "band_is_not_risk_at_the_cut", "bin_without_rows_or_out_of_range", "contributions_and_log_odds_differ", "importance_is_not_the_mean",
    "node_is_not_between_its_children", "population_row_not_open_in_replay", "open_row_not_in_population", "reasons_are_not_the_largest",
    "risk_outside_0_1", "score_changes_in_a_round_trip", "tree_past_the_last_round",
)


def report_baselines(spark, sf):
    """The report's rows of the two baselines, on the feature table."""
    found = _report(spark, sf)["metrics"].where(F.col("model") != "boosted_trees")
    measures = ("pr_auc", "roc_auc", "brier", "base_rate", "top_decile_precision", "top_decile_lift", "top_decile_recall")
    return rounded(found, *measures)


def scenario_refusals(spark, sf):
    """What-if rows with one fault each, and why they are refused."""
    table, risk = fitted(spark, sf)
    at = F.pmod(F.col(SPEC.key).cast("long"), F.lit(7))
    fault = lambda i, bad, good: F.when(at == i, F.lit(bad)).otherwise(good)
    asked = table.where(F.col("split") == "test").select(
        SPEC.key,
        fault(1, "NOWHERE", F.lower(SPEC.group)).alias(SPEC.group),
        fault(2, "  ", F.lower(SPEC.subgroup)).alias(SPEC.subgroup),
        F.coalesce(SPEC.region, F.lit("ASIA")).alias(SPEC.region),
        F.coalesce(SPEC.channel, F.lit("WEB")).alias(SPEC.channel),
        F.when(at != 3, F.col(SPEC.start)).alias("created_at"),
        fault(4, -1.0, F.lit(None)).cast("double").alias("agency_open_backlog"),
        *[F.lit(None).cast("double").alias(c) for c in fixed.DEFAULTABLE_FEATURES[1:5]],
        F.when(at == 5, 1.5).when(at == 6, float("inf")).otherwise(F.lit(None)).cast("double").alias("hist_breach_rate_28d"),
    )
    return modeling.score_scenarios(asked, risk, SPEC)[1].select(SPEC.key, F.col("_reject_reason").alias("reason"))


CASES = {
    "model_checks": Case(model_checks, "SELECT * FROM (VALUES " + ", ".join(f"('{n}', 0::BIGINT)" for n in _CHECKED) + ") t(name, broken)"),
    "report_baselines": Case(
        report_baselines,
        with_(
            SCORED + [points_sql(), RANKED, "top AS (SELECT * FROM ranked WHERE rank <= (SELECT greatest(1, floor(count(*) * 0.1)) FROM test))"],
            f"""SELECT 'B0_base_rate' AS model, round(avg(breach), 6) AS pr_auc, 0.5::DOUBLE AS roc_auc,
  round(avg(power(breach - (SELECT rate FROM base), 2)), 6) AS brier, round(avg(breach), 6) AS base_rate,
  round(avg(breach), 6) AS top_decile_precision, 1.0::DOUBLE AS top_decile_lift, 0.1::DOUBLE AS top_decile_recall,
  CAST(floor(count(*) * 0.1) AS BIGINT) AS n_top, 'analytic_no_ranking' AS tie_policy FROM test
UNION ALL
SELECT 'B1_group_lookup', round({AP}, 6), round(sum((n - pos) * (tp - pos / 2.0::DOUBLE)) / (CAST(sum(pos) AS DOUBLE) * sum(n - pos)), 6),
  round((SELECT avg(power(breach - score, 2)) FROM test), 6), round((SELECT avg(breach) FROM test), 6),
  (SELECT round(avg(breach), 6) FROM top), (SELECT round(avg(breach) / (SELECT avg(breach) FROM test), 6) FROM top),
  (SELECT round(CAST(sum(breach) AS DOUBLE) / (SELECT CAST(sum(breach) AS DOUBLE) FROM test), 6) FROM top),
  (SELECT count(*) FROM top), 'score_desc_then_unique_key_asc' FROM points""",
        ),
    ),
    "scenario_refusals": Case(
        scenario_refusals,
        with_(
            SCORED,
            """SELECT unique_key, CASE CAST(unique_key AS BIGINT) % 7 WHEN 1 THEN 'unsupported_group' WHEN 2 THEN 'complaint_type_empty'
  WHEN 3 THEN 'created_at_missing' WHEN 4 THEN 'agency_open_backlog_negative' WHEN 5 THEN 'hist_breach_rate_28d_above_1'
  WHEN 6 THEN 'hist_breach_rate_28d_not_finite' END AS reason
FROM scored WHERE split = 'test' AND CAST(unique_key AS BIGINT) % 7 > 0""",
        ),
    ),
    "risk_model_scores": Case(risk_model_scores),
    "isotonic_calibrated": Case(isotonic_calibrated),
    "path_contributions": Case(path_contributions),
    "top_reasons": Case(top_reasons),
    "model_metrics": Case(model_metrics),
    "model_metrics_by_group": Case(model_metrics_by_group),
    "importance": Case(importance),
    "model_calibration": Case(model_calibration),
    "score_scenarios": Case(score_scenarios),
    "overview": Case(overview),
}
