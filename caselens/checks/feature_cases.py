"""Feature table, grouping, encoders and default values (event tickets)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselens import fixed
from caselens.checks.common import CFG, SPEC, Case, labeled, rounded, split, start_s, tickets
from caselens.checks.flow_cases import HISTORY
from caselens.checks.sql import FROZEN, SPLIT, TICKETS, with_
from caselens.operators import features, profile, quality, targets
from caselens.storage import settle

MEDIAN_COLUMNS = [c for c in fixed.NUMERIC_FEATURES if c not in ("hour_of_day_created", "day_of_week")]
CONTEXT = [SPEC.group, "hour_of_day_created", "day_of_week"]


def group_rare(spark, sf):
    rows = settle(split(spark, sf), "split")
    common = features.common_types(rows.where(F.col("split") == "train"), SPEC, CFG.rare_min_n)
    return features.group_rare(rows, common, SPEC).select(SPEC.key, "complaint_type_grouped")


def common_types(spark, sf):
    return features.common_types(split(spark, sf).where(F.col("split") == "train"), SPEC, CFG.rare_min_n)


def calendar(spark, sf):
    rows = features.calendar(tickets(spark, sf), SPEC, seasonal=True)
    return rows.select(SPEC.key, "created_hour", "created_dow", "created_month", "is_weekend")


def full_features(spark, sf):
    return features.feature_table(settle(tickets(spark, sf, full=True), "tickets"), CFG)


def feature_table(spark, sf):
    table = full_features(spark, sf).select(
        SPEC.key, "split", "breach", "label_state", SPEC.is_open, SPEC.group, SPEC.subgroup, start_s(), *fixed.FEATURES
    )
    return rounded(table, "hist_median_res_hrs_28d", "hist_breach_rate_28d", "sla_target_hours")


def null_counts(spark, sf):
    return profile.null_counts(full_features(spark, sf), fixed.FEATURES)


def negative_counts(spark, sf):
    return profile.negative_counts(full_features(spark, sf), ["agency_open_backlog", "complaint_open_backlog"])


def ordinal_codes(spark, sf):
    rows = settle(split(spark, sf, full=True), "split")
    columns = [SPEC.region, SPEC.channel, SPEC.subgroup]
    encoder = features.fit_ordinal(rows.where(F.col("split") == "train"), columns)
    coded = features.apply_ordinal(rows, encoder, columns)
    return coded.select(SPEC.key, *[f"{c}_code" for c in columns])


def context_medians(spark, sf):
    table = settle(full_features(spark, sf), "features")
    train = quality.labeled(table.where(F.col("split") == "train"))
    return rounded(features.context_medians(train, CONTEXT, MEDIAN_COLUMNS), *MEDIAN_COLUMNS)


def global_medians(spark, sf):
    table = settle(full_features(spark, sf), "features")
    train = quality.labeled(table.where(F.col("split") == "train"))
    return rounded(features.global_medians(train, fixed.NUMERIC_FEATURES), "median")


def scenario_defaults(spark, sf):
    """Test rows with some features blanked, filled from training medians."""
    table = settle(full_features(spark, sf), "features")
    train = quality.labeled(table.where(F.col("split") == "train"))
    context = features.context_medians(train, CONTEXT, MEDIAN_COLUMNS)
    overall = features.global_medians(train, fixed.NUMERIC_FEATURES)
    asked = table.where(F.col("split") == "test").select(SPEC.key, *CONTEXT, *fixed.DEFAULTABLE_FEATURES)
    even = F.pmod(F.col(SPEC.key).cast("long"), F.lit(2)) == 0
    asked = asked.withColumn("agency_open_backlog", F.when(~even, F.col("agency_open_backlog")))
    asked = asked.withColumn("hist_breach_rate_28d", F.lit(None).cast("double"))
    filled = features.fill_defaults(asked, context, overall, CONTEXT, fixed.DEFAULTABLE_FEATURES)
    listed = F.array_join(F.transform("defaulted_fields", lambda d: F.concat_ws("=", d["feature"], d["source"])), ";")
    return rounded(
        filled.select(SPEC.key, "agency_open_backlog", "hist_breach_rate_28d", listed.alias("defaulted")),
        "agency_open_backlog", "hist_breach_rate_28d",
    )


def _asked_pairs(spark, sf):
    """Group and subgroup as a person might type them, one row per ticket of the test days."""
    rows = split(spark, sf).where(F.col("split") == "test")
    k = F.col(SPEC.key).cast("long")
    unseen = F.pmod(k, F.lit(7)) == 0
    unknown = F.pmod(k, F.lit(11)) == 0
    return rows.select(
        SPEC.key,
        F.when(unknown, F.lit("nobody")).otherwise(F.col(SPEC.group)).alias(SPEC.group),
        F.when(unseen, F.lit("  New Kind ")).otherwise(F.concat(F.lit(" "), F.lower(SPEC.subgroup))).alias(SPEC.subgroup),
    )


def _upper_targets(spark, sf):
    rows = settle(split(spark, sf), "split").withColumn(SPEC.group, F.upper(SPEC.group))
    return features.frozen_targets(rows, CFG)


def canonicalize(spark, sf):
    found = features.canonicalize(_asked_pairs(spark, sf), _upper_targets(spark, sf), SPEC)
    return found.select(SPEC.key, SPEC.group, SPEC.subgroup)


def threshold_lookup(spark, sf):
    known = _upper_targets(spark, sf)
    asked = features.canonicalize(_asked_pairs(spark, sf), known, SPEC)
    found = targets.threshold_for(asked, known, SPEC).withColumnRenamed("_reject_reason", "reject_reason")
    return rounded(
        found.select(SPEC.key, "sla_target_hours", "sla_source", "reject_reason"), "sla_target_hours"
    )


def coerce_numeric(spark, sf):
    """Text numbers to doubles; other text and NULL to 0."""
    mixed = F.when(F.col("agency") == "click", F.lit("n/a")).when(F.col("agency") == "view", F.lit("NaN")).otherwise(
        F.col(SPEC.hours).cast("string")
    )
    rows = tickets(spark, sf).withColumn("value", mixed)
    return rounded(features.coerce_numeric(rows, ["value"]).select(SPEC.key, "value"), "value")


BUILT = HISTORY + [
    """common AS (
  SELECT agency, complaint_type, count(*) AS n_train FROM labeled WHERE split = 'train'
  GROUP BY agency, complaint_type HAVING count(*) >= 50)""",
    """stream AS (
  SELECT unique_key, agency, complaint_type, s0 AS s, 1 AS d, 1 AS a, 0 AS c, true AS starts FROM labeled
  UNION ALL SELECT unique_key, agency, complaint_type, s1, -1, 0, 1, false FROM labeled WHERE s1 IS NOT NULL)""",
    """sweep AS (
  SELECT unique_key, starts,
    CAST(coalesce(sum(d) OVER (PARTITION BY agency ORDER BY s RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS agency_open_backlog,
    CAST(coalesce(sum(d) OVER (PARTITION BY agency, complaint_type ORDER BY s RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS complaint_open_backlog,
    CAST(coalesce(sum(a) OVER (PARTITION BY agency ORDER BY s RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS agency_arrivals_24h,
    CAST(coalesce(sum(c) OVER (PARTITION BY agency ORDER BY s RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS agency_closures_24h
  FROM stream)""",
    """features AS (
  SELECT l.unique_key, l.split, l.breach, l.label_state, l.is_open, l.agency, l.complaint_type, l.s0 AS start_s,
    agency_open_backlog, complaint_open_backlog, agency_arrivals_24h, agency_closures_24h,
    coalesce(o.med, p.med, 0) AS hist_median_res_hrs_28d, coalesce(o.rate, p.rate, 0) AS hist_breach_rate_28d,
    sla_target_hours, CAST(hour(created_date) AS INTEGER) AS hour_of_day_created,
    CAST(dayofweek(created_date) + 1 AS INTEGER) AS day_of_week,
    coalesce(borough, 'UNKNOWN') AS borough, channel,
    CASE WHEN m.n_train IS NOT NULL THEN l.complaint_type ELSE 'OTHER_' || l.agency END AS complaint_type_grouped
  FROM labeled l JOIN sweep w ON w.unique_key = l.unique_key AND w.starts
  LEFT JOIN own o ON o.agency = l.agency AND o.complaint_type = l.complaint_type AND o.day = l.s0 // 86400
  LEFT JOIN parent p ON p.agency = l.agency AND p.day = l.s0 // 86400
  LEFT JOIN common m ON m.agency = l.agency AND m.complaint_type = l.complaint_type)""",
    "train_features AS (SELECT * FROM features WHERE split = 'train' AND breach IS NOT NULL)",
]

_FEATURE_ROW = ", ".join(
    f"round({c}, 6) AS {c}" if c in ("hist_median_res_hrs_28d", "hist_breach_rate_28d", "sla_target_hours") else c
    for c in fixed.FEATURES
)
_CONTEXT_MEDIANS = ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS {c}" for c in MEDIAN_COLUMNS)
_ASKED = """asked AS (
  SELECT unique_key,
    upper(CASE WHEN CAST(unique_key AS BIGINT) % 11 = 0 THEN 'nobody' ELSE agency END) AS agency,
    CASE WHEN CAST(unique_key AS BIGINT) % 7 = 0 THEN 'New Kind' ELSE complaint_type END AS wanted
  FROM split WHERE split = 'test')"""
_NAMED = """named AS (
  SELECT unique_key, a.agency, coalesce(f.complaint_type, CASE WHEN wanted = 'New Kind' THEN wanted ELSE lower(wanted) END) AS complaint_type
  FROM asked a LEFT JOIN frozen f ON upper(f.agency) = a.agency AND f.complaint_type = wanted)"""


def _codes(column: str, alias: str) -> str:
    return (
        f"{alias} AS (SELECT {column} AS v, CAST(row_number() OVER (ORDER BY {column}) AS INTEGER) AS code FROM "
        f"(SELECT DISTINCT {column} FROM split WHERE split = 'train' AND {column} IS NOT NULL))"
    )


CASES = {
    "group_rare": Case(
        group_rare,
        with_(
            SPLIT,
            """SELECT unique_key, CASE WHEN n >= 50 THEN complaint_type ELSE 'OTHER_' || agency END AS complaint_type_grouped
FROM (SELECT *, count(*) FILTER (split = 'train') OVER (PARTITION BY agency, complaint_type) AS n FROM split)""",
        ),
    ),
    "common_types": Case(
        common_types,
        with_(
            SPLIT,
            "SELECT agency, complaint_type, count(*) AS n_train FROM split WHERE split = 'train' "
            "GROUP BY agency, complaint_type HAVING count(*) >= 50",
        ),
    ),
    "calendar": Case(
        calendar,
        with_(
            TICKETS,
            """SELECT unique_key, CAST(hour(created_date) AS INTEGER) AS created_hour,
  CAST(dayofweek(created_date) + 1 AS INTEGER) AS created_dow, CAST(month(created_date) AS INTEGER) AS created_month,
  CAST(dayofweek(created_date) IN (0, 6) AS INTEGER) AS is_weekend FROM tickets""",
        ),
    ),
    "feature_table": Case(
        feature_table,
        with_(
            BUILT,
            "SELECT unique_key, split, breach, label_state, is_open, agency, complaint_type, start_s, "
            f"{_FEATURE_ROW} FROM features",
        ),
    ),
    "null_counts": Case(
        null_counts,
        with_(
            BUILT,
            "SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in fixed.FEATURES) + " FROM features",
        ),
    ),
    "negative_counts": Case(
        negative_counts,
        with_(
            BUILT,
            "SELECT count(*) FILTER (agency_open_backlog < 0 OR complaint_open_backlog < 0) AS negative_rows FROM features",
        ),
    ),
    "ordinal_codes": Case(
        ordinal_codes,
        with_(
            SPLIT + [_codes("borough", "b"), _codes("channel", "h"), _codes("complaint_type", "k")],
            """SELECT unique_key, coalesce(b.code, 0) AS borough_code, coalesce(h.code, 0) AS channel_code,
  coalesce(k.code, 0) AS complaint_type_code
FROM split LEFT JOIN b ON borough = b.v LEFT JOIN h ON channel = h.v LEFT JOIN k ON complaint_type = k.v""",
        ),
    ),
    "context_medians": Case(
        context_medians,
        with_(
            BUILT,
            f"SELECT agency, hour_of_day_created, day_of_week, {_CONTEXT_MEDIANS} FROM train_features GROUP BY 1, 2, 3",
        ),
    ),
    "global_medians": Case(
        global_medians,
        with_(
            BUILT,
            " UNION ALL ".join(
                f"SELECT '{c}' AS feature, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median FROM train_features"
                for c in fixed.NUMERIC_FEATURES
            ),
        ),
    ),
    "scenario_defaults": Case(
        scenario_defaults,
        with_(
            BUILT
            + [
                """ctx AS (
  SELECT agency, hour_of_day_created, day_of_week, quantile_cont(CAST(agency_open_backlog AS DOUBLE), 0.5) AS b,
         quantile_cont(hist_breach_rate_28d, 0.5) AS r FROM train_features GROUP BY 1, 2, 3)""",
                """overall_medians AS (
  SELECT quantile_cont(CAST(agency_open_backlog AS DOUBLE), 0.5) AS b, quantile_cont(hist_breach_rate_28d, 0.5) AS r
  FROM train_features)""",
            ],
            """SELECT f.unique_key,
  round(CASE WHEN CAST(f.unique_key AS BIGINT) % 2 = 1 THEN f.agency_open_backlog ELSE coalesce(c.b, g.b) END, 6) AS agency_open_backlog,
  round(coalesce(c.r, g.r), 6) AS hist_breach_rate_28d,
  CASE WHEN CAST(f.unique_key AS BIGINT) % 2 = 1 THEN ''
       ELSE 'agency_open_backlog=' || CASE WHEN c.b IS NULL THEN 'global_train_median' ELSE 'agency_hour_weekday_median' END || ';' END
  || 'hist_breach_rate_28d=' || CASE WHEN c.r IS NULL THEN 'global_train_median' ELSE 'agency_hour_weekday_median' END AS defaulted
FROM features f CROSS JOIN overall_medians g
LEFT JOIN ctx c ON c.agency = f.agency AND c.hour_of_day_created = f.hour_of_day_created AND c.day_of_week = f.day_of_week
WHERE f.split = 'test'""",
        ),
    ),
    "canonicalize": Case(canonicalize, with_(FROZEN + [_ASKED, _NAMED], "SELECT * FROM named")),
    "threshold_lookup": Case(
        threshold_lookup,
        with_(
            FROZEN + [_ASKED, _NAMED],
            """SELECT unique_key, round(coalesce(f.sla_target_hours, a.agency_p75), 6) AS sla_target_hours,
  CASE WHEN f.target_source IS NOT NULL THEN f.target_source
       WHEN a.agency_p75 IS NOT NULL THEN 'agency_p75_unseen_complaint_fallback' END AS sla_source,
  CASE WHEN a.agency_p75 IS NULL THEN 'unsupported_group' END AS reject_reason
FROM named n LEFT JOIN frozen f ON upper(f.agency) = n.agency AND f.complaint_type = n.complaint_type
LEFT JOIN frozen_agency a ON upper(a.agency) = n.agency""",
        ),
    ),
    "coerce_numeric": Case(
        coerce_numeric,
        with_(
            TICKETS,
            "SELECT unique_key, round(CASE WHEN agency IN ('click', 'view') THEN 0 ELSE coalesce(resolution_hours, 0) END, 6) "
            "AS value FROM tickets",
        ),
    ),
}
