"""Targets, labels and breach rates (event tickets)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselens import fixed
from caselens.checks.common import CFG, SPEC, Case, gold, labeled, rounded, split, start_s, tickets
from caselens.checks.sql import CLOSED, FROZEN, GOLD, LABELED, SPLIT, TICKETS, targets as target_sql, with_
from caselens.operators import features, quality, targets
from caselens.storage import settle

TARGET_ROW = "agency, complaint_type, {0}, round(sla_target_hours, 6) AS sla_target_hours, round(agency_p75, 6) AS agency_p75, target_source"


def group_targets(spark, sf):
    return rounded(targets.group_targets(quality.closed(tickets(spark, sf), SPEC), SPEC), "sla_target_hours", "agency_p75")


def group_targets_before(spark, sf):
    """Targets from tickets that had ended by a cutoff."""
    rows = quality.closed(tickets(spark, sf), SPEC)
    found = targets.group_targets(rows, SPEC, min_n=50, closed_before="2024-01-16")
    return rounded(found, "sla_target_hours", "agency_p75")


def target_source_counts(spark, sf):
    return targets.target_source_counts(targets.group_targets(quality.closed(tickets(spark, sf), SPEC), SPEC))


def label_closed(spark, sf):
    return rounded(gold(spark, sf).select(SPEC.key, "sla_target_hours", "breach"), "sla_target_hours")


def breach_rate_group(spark, sf):
    return targets.breach_rates(gold(spark, sf), [SPEC.group], SPEC)


def breach_rate_subgroup(spark, sf):
    return targets.breach_rates(gold(spark, sf), SPEC.pair, SPEC, min_n=50)


def breach_rate_region(spark, sf):
    return targets.breach_rates(gold(spark, sf, full=True), [SPEC.group, SPEC.region], SPEC, not_null=[SPEC.region])


def overall_rate(spark, sf):
    return rounded(targets.overall_rate(quality.closed(gold(spark, sf), SPEC)), "breach_rate")


def temporal_split(spark, sf):
    return split(spark, sf).select(SPEC.key, "split")


def temporal_split_counts(spark, sf):
    return features.split_counts(split(spark, sf))


def split_ranges(spark, sf):
    return features.split_ranges(split(spark, sf), SPEC).select(
        "split", F.unix_seconds("min_created").alias("min_s"), F.unix_seconds("max_created").alias("max_s")
    )


def split_rates(spark, sf):
    return features.split_rates(labeled(spark, sf))


def frozen_targets(spark, sf):
    rows = settle(split(spark, sf), "split")
    return rounded(features.frozen_targets(rows, CFG), "sla_target_hours", "agency_p75")


def label_censored(spark, sf):
    rows = labeled(spark, sf).select(
        SPEC.key, "sla_target_hours", "age_at_observation_hours", "breach", "label_state"
    )
    return rounded(rows, "sla_target_hours", "age_at_observation_hours")


def label_states(spark, sf):
    return targets.label_state_counts(labeled(spark, sf))


def dq_summary(spark, sf):
    """Reconciliation, reject reasons and label states of tickets with a 72 h limit."""
    rules = quality.reject_rules(SPEC, 72)
    raw, cleaned = quality.watch_rejects(quality.tag_rejects(tickets(spark, sf), rules), rules)
    valid = quality.split_rejects(settle(raw, "tagged"))[0]
    rows = settle(features.temporal_split(valid, SPEC, CFG.splits), "split")
    labels = targets.label_censored(rows, features.frozen_targets(rows, CFG), SPEC, CFG.observed_at)
    watched, states = quality.watch(labels, "label_state", (fixed.STATE_CLOSED, fixed.STATE_KNOWN_BREACH, fixed.STATE_CENSORED))
    settle(watched.select(SPEC.key, "label_state"), "labels")
    return quality.dq_summary_watched(spark, cleaned, states)


SHORT = [
    TICKETS[0],
    TICKETS[1].replace("tickets AS (", "everything AS ("),
    "tickets AS (SELECT * FROM everything WHERE resolution_hours IS NULL OR resolution_hours <= 72)",
]

CASES = {
    "group_targets": Case(
        group_targets, with_(GOLD, f"SELECT {TARGET_ROW.format('n_closed')} FROM gold_targets")
    ),
    "group_targets_before": Case(
        group_targets_before,
        with_(
            TICKETS
            + ["early AS (SELECT * FROM tickets WHERE NOT is_open AND closed_date < TIMESTAMP '2024-01-16')"]
            + target_sql("early_targets", "early", 50),
            f"SELECT {TARGET_ROW.format('n_closed')} FROM early_targets",
        ),
    ),
    "target_source_counts": Case(
        target_source_counts,
        with_(GOLD, "SELECT target_source, count(*) AS n FROM gold_targets GROUP BY target_source"),
    ),
    "label_closed": Case(
        label_closed, with_(GOLD, "SELECT unique_key, round(sla_target_hours, 6) AS sla_target_hours, breach FROM gold")
    ),
    "breach_rate_group": Case(
        breach_rate_group,
        with_(GOLD, "SELECT agency, count(*) AS n, round(avg(breach), 3) AS breach_rate FROM gold WHERE NOT is_open GROUP BY agency"),
    ),
    "breach_rate_subgroup": Case(
        breach_rate_subgroup,
        with_(
            GOLD,
            "SELECT agency, complaint_type, count(*) AS n, round(avg(breach), 3) AS breach_rate FROM gold "
            "WHERE NOT is_open GROUP BY agency, complaint_type HAVING count(*) >= 50",
        ),
    ),
    "breach_rate_region": Case(
        breach_rate_region,
        with_(
            GOLD,
            "SELECT agency, borough, count(*) AS n, round(avg(breach), 3) AS breach_rate FROM gold "
            "WHERE NOT is_open AND borough IS NOT NULL GROUP BY agency, borough",
        ),
    ),
    "overall_rate": Case(
        overall_rate, with_(GOLD, "SELECT round(avg(breach), 6) AS breach_rate FROM gold WHERE NOT is_open")
    ),
    "temporal_split": Case(temporal_split, with_(SPLIT, "SELECT unique_key, split FROM split")),
    "temporal_split_counts": Case(
        temporal_split_counts, with_(SPLIT, "SELECT split, count(*) AS n FROM split GROUP BY split")
    ),
    "split_ranges": Case(
        split_ranges, with_(SPLIT, "SELECT split, min(s0) AS min_s, max(s0) AS max_s FROM split GROUP BY split")
    ),
    "split_rates": Case(
        split_rates,
        with_(
            LABELED,
            "SELECT split, count(*) AS n, round(avg(breach), 3) AS breach_rate FROM labeled "
            "WHERE breach IS NOT NULL GROUP BY split",
        ),
    ),
    "frozen_targets": Case(
        frozen_targets, with_(FROZEN, f"SELECT {TARGET_ROW.format('n_closed AS n_train_closed')} FROM frozen")
    ),
    "label_censored": Case(
        label_censored,
        with_(
            LABELED,
            "SELECT unique_key, round(sla_target_hours, 6) AS sla_target_hours, "
            "round(age_at_observation_hours, 6) AS age_at_observation_hours, breach, label_state FROM labeled",
        ),
    ),
    "label_states": Case(
        label_states, with_(LABELED, "SELECT label_state, count(*) AS n FROM labeled GROUP BY label_state")
    ),
    "dq_summary": Case(
        dq_summary,
        with_(
            SHORT + LABELED[len(TICKETS):],
            """SELECT 'rows' AS section, 'bronze_rows' AS name, count(*) AS n FROM everything
UNION ALL SELECT 'rows', 'silver_rows', count(*) FROM tickets
UNION ALL SELECT 'rows', 'rejected_rows', count(*) FROM everything WHERE resolution_hours > 72
UNION ALL SELECT 'rejects_by_reason', 'resolution_exceeds_3d', count(*) FROM everything
  WHERE resolution_hours > 72 HAVING count(*) > 0
UNION ALL SELECT 'label_states', label_state, count(*) FROM labeled GROUP BY label_state""",
        ),
    ),
}
