"""Baselines, ranking metrics and calibration of the pair-rate score (event tickets)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselens.checks.common import SPEC, Case, rounded, scored, scored_split
from caselens.checks.sql import SCORED, with_
from caselens.operators import isotonic, metrics, quality
from caselens.operators.prefix import global_rank
from caselens.storage import settle


def baseline_group_rate(spark, sf):
    rows = scored(spark, sf).where(F.col("split") == "test")
    return rows.select(SPEC.key, "score")


def baseline_constant(spark, sf):
    rows = scored_split(spark, sf)
    return rounded(
        metrics.evaluate_constant(rows, "B0_base_rate", metrics.base_rate(scored_split(spark, sf, "train"))),
        "pr_auc", "brier", "base_rate", "top_decile_precision",
    )


def constant_scores(spark, sf):
    rate = metrics.base_rate(scored_split(spark, sf, "train"))
    constant = metrics.baseline_constant(scored_split(spark, sf), rate, "score")
    return rounded(constant.select(SPEC.key, "score"), "score")


def ranking_metrics(spark, sf):
    found = metrics.ranking_metrics(scored_split(spark, sf)).drop("note")
    return rounded(found, "pr_auc", "roc_auc", "brier", "base_rate")


def metrics_by_group(spark, sf):
    return rounded(metrics.metrics_by_group(scored_split(spark, sf), SPEC.group), "pr_auc", "base_rate")


def top_fraction(spark, sf):
    return metrics.top_fraction(scored_split(spark, sf), "score", SPEC.key).select(SPEC.key, "score", "breach")


def top_decile(spark, sf):
    found = metrics.top_fraction_metrics(scored_split(spark, sf))
    return rounded(found, "top_decile_precision", "top_decile_lift", "top_decile_recall")


def global_ranks(spark, sf):
    """Place of every labelled test ticket in queue order."""
    rows = scored_split(spark, sf).select(SPEC.key, "score")
    return global_rank(rows, [F.col("score").desc(), F.col(SPEC.key).asc()])


def calibration_bins(spark, sf):
    return rounded(metrics.calibration_bins(scored_split(spark, sf)), "mean_pred", "actual_rate")


def ece(spark, sf):
    return rounded(metrics.expected_calibration_error(metrics.calibration_bins(scored_split(spark, sf))), "ece")


def risk_band(spark, sf):
    rows = scored(spark, sf)
    cut = metrics.risk_cut(scored_split(spark, sf, "val"))
    banded = metrics.risk_band(quality.labeled(rows.where(F.col("split") == "test")), cut)
    return banded.select(SPEC.key, "risk_band", F.round(F.lit(cut), 6).alias("cut"))


def isotonic_curve(spark, sf):
    """Test scores on the rising curve through the validation rows."""
    curve = settle(isotonic.fit(scored_split(spark, sf, "val"), "score", "breach"), "knots")
    return rounded(isotonic.apply(scored_split(spark, sf), curve, "score", "risk").select(SPEC.key, "score", "risk"), "risk")


def beats_baseline(spark, sf):
    """The pair-rate score against the constant one."""
    rows = scored_split(spark, sf)
    rate = metrics.base_rate(scored_split(spark, sf, "train"))
    report = metrics.evaluate(rows, "B1_group_lookup").unionByName(metrics.evaluate_constant(rows, "B0_base_rate", rate))
    return rounded(
        metrics.beats_baseline(report, "B1_group_lookup", "B0_base_rate"), "challenger_pr_auc", "baseline_pr_auc"
    )


def points_sql(keys: str = "") -> str:
    group = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    return f"""points AS (
  SELECT {group}score, sum(breach) AS pos, count(*) AS n,
    sum(sum(breach)) OVER ({part}ORDER BY score DESC) AS tp, sum(count(*)) OVER ({part}ORDER BY score DESC) AS seen
  FROM test GROUP BY {group}score)"""


AP = "sum(CAST(pos AS DOUBLE) * tp / seen) / sum(pos)"
RANKED = "ranked AS (SELECT unique_key, score, breach, row_number() OVER (ORDER BY score DESC, unique_key) AS rank FROM test)"
_BIN = """binned AS (
  SELECT breach, score, CAST(CASE WHEN score >= 0.9 THEN 9 WHEN score >= 0.8 THEN 8 WHEN score >= 0.7000000000000001::DOUBLE THEN 7
    WHEN score >= 0.6000000000000001::DOUBLE THEN 6 WHEN score >= 0.5 THEN 5 WHEN score >= 0.4 THEN 4
    WHEN score >= 0.30000000000000004::DOUBLE THEN 3 WHEN score >= 0.2 THEN 2 WHEN score >= 0.1 THEN 1 ELSE 0 END AS INTEGER) AS bin
  FROM test)"""
_BINS = "bins AS (SELECT bin, count(*) AS n, avg(score) AS mean_pred, avg(breach) AS actual_rate FROM binned GROUP BY bin)"

CASES = {
    "baseline_group_rate": Case(
        baseline_group_rate, with_(SCORED, "SELECT unique_key, score FROM scored WHERE split = 'test'")
    ),
    "constant_scores": Case(
        constant_scores, with_(SCORED, "SELECT unique_key, round((SELECT rate FROM base), 6) AS score FROM test")
    ),
    "baseline_constant": Case(
        baseline_constant,
        with_(
            SCORED,
            """SELECT 'B0_base_rate' AS model, round(avg(breach), 6) AS pr_auc, 0.5::DOUBLE AS roc_auc,
  round(avg(power(breach - (SELECT rate FROM base), 2)), 6) AS brier, round(avg(breach), 6) AS base_rate,
  round(avg(breach), 6) AS top_decile_precision, 1.0::DOUBLE AS top_decile_lift, 0.1::DOUBLE AS top_decile_recall,
  CAST(floor(count(*) * 0.1) AS BIGINT) AS n_top, 'analytic_no_ranking' AS tie_policy FROM test""",
        ),
    ),
    "ranking_metrics": Case(
        ranking_metrics,
        with_(
            SCORED + [points_sql()],
            f"""SELECT CAST(sum(n) AS BIGINT) AS n, round({AP}, 6) AS pr_auc,
  round(sum((n - pos) * (tp - pos / 2.0::DOUBLE)) / (CAST(sum(pos) AS DOUBLE) * sum(n - pos)), 6) AS roc_auc,
  round((SELECT avg(power(breach - score, 2)) FROM test), 6) AS brier,
  round((SELECT avg(breach) FROM test), 6) AS base_rate FROM points""",
        ),
    ),
    "metrics_by_group": Case(
        metrics_by_group,
        with_(
            SCORED + [points_sql("agency")],
            f"""SELECT agency, CAST(sum(n) AS BIGINT) AS n,
  CASE WHEN sum(pos) NOT IN (0, sum(n)) THEN round({AP}, 6) END AS pr_auc,
  CASE WHEN sum(pos) NOT IN (0, sum(n)) THEN round(CAST(sum(pos) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 6) END AS base_rate,
  CASE WHEN sum(pos) IN (0, sum(n)) THEN 'single-class' END AS note FROM points GROUP BY agency""",
        ),
    ),
    "top_fraction": Case(
        top_fraction,
        with_(
            SCORED + [RANKED],
            "SELECT unique_key, score, breach FROM ranked "
            "WHERE rank <= (SELECT greatest(1, floor(count(*) * 0.1)) FROM test)",
        ),
    ),
    "top_decile": Case(
        top_decile,
        with_(
            SCORED
            + [RANKED, "top AS (SELECT * FROM ranked WHERE rank <= (SELECT greatest(1, floor(count(*) * 0.1)) FROM test))"],
            """SELECT round(avg(breach), 6) AS top_decile_precision,
  round(avg(breach) / (SELECT avg(breach) FROM test), 6) AS top_decile_lift,
  round(CAST(sum(breach) AS DOUBLE) / (SELECT CAST(sum(breach) AS DOUBLE) FROM test), 6) AS top_decile_recall,
  count(*) AS n_top FROM top""",
        ),
    ),
    "global_ranks": Case(global_ranks, with_(SCORED + [RANKED], "SELECT unique_key, score, rank FROM ranked")),
    "calibration_bins": Case(
        calibration_bins,
        with_(
            SCORED + [_BIN, _BINS],
            "SELECT bin, n, round(mean_pred, 6) AS mean_pred, round(actual_rate, 6) AS actual_rate FROM bins",
        ),
    ),
    "ece": Case(
        ece,
        with_(
            SCORED + [_BIN, _BINS],
            "SELECT round(sum(n * abs(mean_pred - actual_rate)) / CAST(sum(n) AS DOUBLE), 6) AS ece FROM bins",
        ),
    ),
    "isotonic_curve": Case(
        isotonic_curve,
        with_(
            SCORED + [
                "points AS (SELECT score AS x, sum(breach) AS pos, count(*) AS n FROM scored WHERE split = 'val' AND breach IS NOT NULL GROUP BY score)",
                "summed AS (SELECT x, row_number() OVER (ORDER BY x) AS i, sum(pos) OVER (ORDER BY x) AS p, sum(n) OVER (ORDER BY x) AS m, pos, n FROM points)",
                # The mean from a to b, its least over the ends from i on, and the largest of those over the starts up to i.
                """lowest AS (
  SELECT a.i AS a, b.i AS b, min((b.p - a.p + a.pos) / CAST(b.m - a.m + a.n AS DOUBLE)) OVER (PARTITION BY a.i ORDER BY b.i DESC) AS low
  FROM summed a JOIN summed b ON a.i <= b.i)""",
                "knots AS (SELECT s.i, s.x, max(low) AS y FROM summed s JOIN lowest l ON l.b = s.i GROUP BY s.i, s.x)",
                """sides AS (
  SELECT unique_key, score, (SELECT max(i) FROM knots WHERE x <= score) AS below, (SELECT min(i) FROM knots WHERE x >= score) AS above FROM test)""",
            ],
            """SELECT unique_key, score, round(CASE WHEN l.x = u.x OR u.x IS NULL THEN l.y WHEN l.x IS NULL THEN u.y
  ELSE l.y + (u.y - l.y) * (score - l.x) / (u.x - l.x) END, 6) AS risk
FROM sides LEFT JOIN knots l ON below = l.i LEFT JOIN knots u ON above = u.i""",
        ),
    ),
    "risk_band": Case(
        risk_band,
        with_(
            SCORED
            + ["cut AS (SELECT quantile_cont(score, 0.9) AS c FROM scored WHERE split = 'val' AND breach IS NOT NULL)"],
            """SELECT unique_key, CASE WHEN score >= (SELECT c FROM cut) THEN 'high' ELSE 'normal' END AS risk_band,
  (SELECT round(c, 6) FROM cut) AS cut FROM test""",
        ),
    ),
    "beats_baseline": Case(
        beats_baseline,
        with_(
            SCORED + [points_sql()],
            f"""SELECT round({AP}, 6) AS challenger_pr_auc, (SELECT round(avg(breach), 6) FROM test) AS baseline_pr_auc,
  {AP} > (SELECT avg(breach) FROM test) AS beats FROM points""",
        ),
    ),
}
