"""Replay and reporting queries on the pair-rate score (event tickets)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselens.checks.common import CFG, SPEC, Case, gold, rounded, scored, split, tickets
from caselens.checks.flow_cases import replay_instants
from caselens.checks.sql import FROZEN, GOLD, SCORED, TICKETS, sec, with_
from caselens.functions import columns
from caselens.operators import features, metrics, profile, quality
from caselens.operators.flow import open_during
from caselens.plans import medallion, serving
from caselens.sources import tables
from caselens.storage import settle, shared_path

AS_OF = "2024-01-26 09:30:00"


def ranked(spark, sf):
    """Upper-cased groups and regions, risk and band, for rows open during the replay days."""
    rows = metrics.risk_band(scored(spark, sf, full=True).withColumnRenamed("score", "risk"), 0.25, "risk")
    upper = rows.withColumns({SPEC.group: F.upper(SPEC.group), SPEC.region: F.upper(SPEC.region)})
    return settle(open_during(upper, SPEC, *CFG.replay), "replay")


def _flat(df, reveal):
    outcome = [F.col("actual_outcome.breached").alias("breached"), F.col("actual_outcome.closed_at").alias("closed_at")] if reveal else []
    return df.select(*[c for c in df.columns if c != "actual_outcome"], *outcome)


def replay_queue(spark, sf):
    found = serving.replay_queue(ranked(spark, sf), SPEC, AS_OF, CFG.replay, limit=200, reveal=True)
    return rounded(_flat(found, True), "sla_threshold_hrs")


def replay_queue_filtered(spark, sf):
    found = serving.replay_queue(
        ranked(spark, sf), SPEC, AS_OF, CFG.replay, group="click", region="asia", min_risk=0.2, limit=50
    )
    return rounded(found, "sla_threshold_hrs")


def queue_total(spark, sf):
    return serving.queue_total(ranked(spark, sf), SPEC, AS_OF, min_risk=0.2)


def replay_queue_many(spark, sf):
    """Every third hour of the data's days, in and out of the replay range."""
    times = settle(replay_instants(spark, sf), "times")
    found = serving.replay_queue_many(ranked(spark, sf), times, SPEC, CFG.replay, limit=20)
    return rounded(
        found.select(F.unix_seconds("as_of").alias("as_of_s"), F.col("_reject_reason").alias("reason"), "place", "total", SPEC.key, "age_hours",
                     "risk", "already_breached"),
        "risk",
    )


SHOWN = (SPEC.group, SPEC.region, SPEC.channel)


def ticket_detail(spark, sf):
    table = ranked(spark, sf)
    asked = tickets(spark, sf).where(F.hour(SPEC.start) == 9).select(SPEC.key)
    found, _ = serving.ticket_detail(table, asked, SPEC, reveal=True, risk="risk", feature_names=SHOWN)
    flat = found.select(
        SPEC.key, SPEC.group, SPEC.region, SPEC.channel, "status_at_extract", "created_at", "risk", "risk_band",
        F.size("top_reasons").alias("n_reasons"), F.to_json("feature_values").alias("feature_values"),
        F.col("actual_outcome.breached").alias("breached"), F.col("actual_outcome.label_state").alias("label_state"),
    )
    return rounded(flat, "risk")


def ticket_missing(spark, sf):
    """Asked keys outside the replay table."""
    asked = tickets(spark, sf).where(F.hour(SPEC.start) == 9).select(SPEC.key)
    return serving.ticket_detail(ranked(spark, sf), asked, SPEC, feature_names=SHOWN)[1]


def kpis(spark, sf):
    return serving.kpis(gold(spark, sf), SPEC, lo="2024-01-05", hi="2024-01-20", by_volume=True)


def kpis_one_group(spark, sf):
    upper = gold(spark, sf).withColumn(SPEC.group, F.upper(SPEC.group))
    return serving.kpis(upper, SPEC, group="click")


def hotspots(spark, sf):
    return serving.hotspots(gold(spark, sf), SPEC, "agency_complaint", lo="2024-01-05", hi="2024-01-20", k=10)


def hotspots_region(spark, sf):
    return serving.hotspots(gold(spark, sf, full=True), SPEC, "borough", k=18)


def metadata(spark, sf):
    frozen = features.frozen_targets(settle(split(spark, sf), "split"), CFG)
    return serving.metadata(tickets(spark, sf, full=True), SPEC, CFG.replay, frozen)


def subgroups_by_group(spark, sf):
    rows = settle(split(spark, sf), "split")
    return serving.subgroups_by_group(features.frozen_targets(rows, CFG), SPEC)


def snapshot_summary(spark, sf):
    return serving.snapshot_summary(ranked(spark, sf), SPEC, CFG.replay)


def best_group(spark, sf):
    rows = quality.labeled(scored(spark, sf).where(F.col("split") == "test"))
    return rounded(serving.best_group(metrics.metrics_by_group(rows, SPEC.group), SPEC), "pr_auc")


def scored_roundtrip(spark, sf):
    """Scored rows to Parquet and back, times and key normalised."""
    path = shared_path(spark, "scored")
    tables.export_scored(ranked(spark, sf), path)
    back = tables.read_scored(spark, path, SPEC)
    return back.select(SPEC.key, columns.seconds(SPEC.start).alias("start_s"), columns.seconds(SPEC.end).alias("end_s"), "risk")


def gold_features(spark, sf):
    """Labelled rows with the seven-day proxy and the seasonal calendar."""
    built = medallion.gold_features(settle(gold(spark, sf, full=True), "gold"), SPEC)
    return rounded(
        built.select(
            SPEC.key, SPEC.group, SPEC.region, "sla_target_hours", "breach", "backlog_7d_at_creation",
            "created_hour", "created_dow", "created_month", "is_weekend",
        ),
        "sla_target_hours",
    )


def one_row_per_key(spark, sf):
    """Each group and subgroup with the ticket that started first."""
    rows = tickets(spark, sf).select(SPEC.group, SPEC.subgroup, SPEC.key, SPEC.start)
    return profile.one_row_per_key(rows, SPEC.pair, [SPEC.start, SPEC.key]).drop(SPEC.start)


def filled_values(spark, sf):
    """Missing regions and durations after the fills."""
    rows = tickets(spark, sf, full=True).withColumn(SPEC.region, F.when(F.col(SPEC.region) != "ASIA", F.col(SPEC.region)))
    filled = quality.zero_fill(quality.fill_category(rows, SPEC.region), [SPEC.hours])
    return rounded(filled.select(SPEC.key, SPEC.region, SPEC.hours), SPEC.hours)


def local_times(spark, sf):
    """Event times read as New York wall clock, and instants moved to it."""
    rows = tickets(spark, sf)
    return rows.select(
        SPEC.key,
        columns.local_iso(SPEC.start, "America/New_York").alias("local_iso"),
        F.unix_seconds(columns.to_local(SPEC.start, "America/New_York").cast("timestamp")).alias("wall_s"),
    )


def finite_values(spark, sf):
    """Duration over a value that is zero for some rows; non-finite results become NULL."""
    clicks = F.when(F.col(SPEC.group) == "click", F.lit(float("inf"))).when(
        F.col(SPEC.group) == "view", F.lit(float("nan"))
    ).otherwise(F.col(SPEC.hours))
    rows = tickets(spark, sf)
    return rounded(rows.select(SPEC.key, columns.finite_or_null(clicks).alias("value")), "value")


def parsed_reasons(spark, sf):
    """Reasons from JSON text: good, broken, not a list, missing."""
    good = F.to_json(
        F.array(F.struct(F.lit("borough").alias("feature"), F.col(SPEC.subgroup).alias("value"), F.lit(0.5).alias("contribution_log_odds")))
    )
    text = (
        F.when(F.col(SPEC.group) == "click", good)
        .when(F.col(SPEC.group) == "view", F.substring(good, 1, 20))
        .when(F.col(SPEC.group) == "error", F.lit('{"feature": "borough"}'))
    )
    parsed = tickets(spark, sf).select(SPEC.key, columns.parse_reasons(text).alias("r"))
    return parsed.select(SPEC.key, F.size("r").alias("n"), F.try_element_at("r", F.lit(1))["value"].alias("first_value"))


RANKED = SCORED + [
    """ranked AS (
  SELECT unique_key, upper(agency) AS agency, complaint_type, upper(borough) AS borough, channel, status,
    created_date, closed_date, s0, s1, sla_target_hours, breach, label_state, score AS risk,
    CASE WHEN score >= 0.25 THEN 'high' ELSE 'normal' END AS risk_band
  FROM scored WHERE created_date < TIMESTAMP '2024-01-31' AND (closed_date IS NULL OR closed_date >= TIMESTAMP '2024-01-24'))"""
]


def _iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({column}) % 1000000 <> 0 THEN strftime({column}, '.%f') ELSE '' END || '-05:00'"


def _queue(where: str, limit: int, reveal: bool) -> str:
    outcome = f", breach = 1 AS breached, {_iso('closed_date')} AS closed_at" if reveal else ""
    age = f"(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(created_date)) / 3600000000.0::DOUBLE"
    return with_(
        RANKED,
        f"""SELECT unique_key, agency, complaint_type, borough, {_iso('created_date')} AS created_at,
  round({age}, 2) AS age_hours, risk, risk_band, round(sla_target_hours, 6) AS sla_threshold_hrs,
  {age} > sla_target_hours AS already_breached{outcome}
FROM ranked WHERE created_date < TIMESTAMP '{AS_OF}' AND (closed_date IS NULL OR closed_date > TIMESTAMP '{AS_OF}'){where}
ORDER BY risk DESC, unique_key LIMIT {limit}""",
    )


_PERIOD = "created_date >= TIMESTAMP '2024-01-05' AND created_date < TIMESTAMP '2024-01-21'"

CASES = {
    "replay_queue": Case(replay_queue, _queue("", 200, True)),
    "replay_queue_filtered": Case(
        replay_queue_filtered, _queue(" AND agency = 'CLICK' AND borough = 'ASIA' AND risk >= 0.2", 50, False)
    ),
    "queue_total": Case(
        queue_total,
        with_(
            RANKED,
            f"SELECT count(*) AS total FROM ranked WHERE created_date < TIMESTAMP '{AS_OF}' "
            f"AND (closed_date IS NULL OR closed_date > TIMESTAMP '{AS_OF}') AND risk >= 0.2",
        ),
    ),
    "replay_queue_many": Case(
        replay_queue_many,
        with_(
            RANKED
            + [
                """times AS (
  SELECT day + INTERVAL (h) HOUR AS t
  FROM (SELECT DISTINCT date_trunc('day', created_date)::TIMESTAMP AS day FROM tickets), generate_series(0, 21, 3) g(h))""",
                """placed AS (
  SELECT t, r.*, row_number() OVER (PARTITION BY t ORDER BY risk DESC, unique_key) AS place, count(*) OVER (PARTITION BY t) AS total
  FROM times JOIN ranked r ON created_date < t AND (closed_date IS NULL OR closed_date > t)
  WHERE t >= TIMESTAMP '2024-01-24' AND t < TIMESTAMP '2024-01-31')""",
            ],
            f"""SELECT {sec('t')} AS as_of_s, NULL::VARCHAR AS reason, CAST(place AS INTEGER) AS place, total, unique_key,
  round((epoch_us(t) - epoch_us(created_date)) / 3600000000.0::DOUBLE, 2) AS age_hours, round(risk, 6) AS risk,
  (epoch_us(t) - epoch_us(created_date)) / 3600000000.0::DOUBLE > sla_target_hours AS already_breached
FROM placed WHERE place <= 20
UNION ALL
SELECT {sec('t')}, CASE WHEN outside THEN 'as_of_out_of_range' END, NULL, CASE WHEN NOT outside THEN 0 END, NULL, NULL, NULL, NULL
FROM (SELECT t, t < TIMESTAMP '2024-01-24' OR t >= TIMESTAMP '2024-01-31' AS outside FROM times)
WHERE outside OR t NOT IN (SELECT t FROM placed)""",
        ),
    ),
    "ticket_detail": Case(
        ticket_detail,
        with_(
            RANKED,
            f"""SELECT unique_key, agency, borough, channel, status AS status_at_extract, {_iso('created_date')} AS created_at,
  round(risk, 6) AS risk, risk_band, CAST(0 AS INTEGER) AS n_reasons,
  '{{"agency":' || to_json(agency) || coalesce(',"borough":' || to_json(borough)::VARCHAR, '') ||
  coalesce(',"channel":' || to_json(channel)::VARCHAR, '') || '}}' AS feature_values, breach = 1 AS breached, label_state
FROM ranked WHERE hour(created_date) = 9""",
        ),
    ),
    "ticket_missing": Case(
        ticket_missing,
        with_(
            RANKED,
            "SELECT unique_key FROM tickets WHERE hour(created_date) = 9 AND unique_key NOT IN (SELECT unique_key FROM ranked)",
        ),
    ),
    "kpis": Case(
        kpis,
        with_(
            GOLD,
            f"SELECT agency, count(*) AS n, round(avg(breach), 3) AS breach_rate FROM gold WHERE NOT is_open AND {_PERIOD} GROUP BY agency",
        ),
    ),
    "kpis_one_group": Case(
        kpis_one_group,
        with_(
            GOLD,
            "SELECT upper(agency) AS agency, count(*) AS n, round(avg(breach), 3) AS breach_rate FROM gold "
            "WHERE NOT is_open AND agency = 'click' GROUP BY agency",
        ),
    ),
    "hotspots": Case(
        hotspots,
        with_(
            GOLD,
            "SELECT agency, complaint_type, count(*) AS n, round(avg(breach), 3) AS breach_rate FROM gold "
            f"WHERE NOT is_open AND {_PERIOD} GROUP BY agency, complaint_type HAVING count(*) >= 50 "
            "ORDER BY breach_rate DESC, n DESC, agency, complaint_type LIMIT 10",
        ),
    ),
    "hotspots_region": Case(
        hotspots_region,
        with_(
            GOLD,
            "SELECT agency, borough, count(*) AS n, round(avg(breach), 3) AS breach_rate FROM gold "
            "WHERE NOT is_open AND borough IS NOT NULL GROUP BY agency, borough "
            "ORDER BY breach_rate DESC, n DESC, agency, borough LIMIT 18",
        ),
    ),
    "metadata": Case(
        metadata,
        with_(
            FROZEN,
            " UNION ALL ".join(
                f"SELECT DISTINCT '{c}' AS column, {c} AS value FROM tickets WHERE {c} IS NOT NULL"
                for c in ("agency", "borough", "channel")
            )
            + f""" UNION ALL SELECT 'replay_from', '{CFG.replay[0]}' UNION ALL SELECT 'replay_to', '{CFG.replay[1]}'
UNION ALL SELECT 'threshold', concat_ws('|', agency, complaint_type, round(sla_target_hours, 6)::VARCHAR, target_source) FROM frozen""",
        ),
    ),
    "subgroups_by_group": Case(subgroups_by_group, with_(FROZEN, "SELECT agency, complaint_type FROM frozen")),
    "snapshot_summary": Case(
        snapshot_summary,
        with_(
            RANKED,
            "SELECT count(*) AS tickets_loaded, '2024-01-24T00:00:00-05:00' AS replay_start, "
            "'2024-01-31T00:00:00-05:00' AS replay_end_exclusive FROM ranked",
        ),
    ),
    "best_group": Case(
        best_group,
        with_(
            SCORED
            + [
                """points AS (
  SELECT agency, score, sum(breach) AS pos, sum(sum(breach)) OVER (PARTITION BY agency ORDER BY score DESC) AS tp,
    sum(count(*)) OVER (PARTITION BY agency ORDER BY score DESC) AS seen
  FROM test GROUP BY agency, score)"""
            ],
            """SELECT agency, round(sum(CAST(pos AS DOUBLE) * tp / seen) / sum(pos), 6) AS pr_auc FROM points
GROUP BY agency HAVING sum(pos) > 0 ORDER BY sum(CAST(pos AS DOUBLE) * tp / seen) / sum(pos) DESC LIMIT 1""",
        ),
    ),
    "scored_roundtrip": Case(
        scored_roundtrip, with_(RANKED, "SELECT unique_key, s0 AS start_s, s1 AS end_s, risk FROM ranked")
    ),
    "gold_features": Case(
        gold_features,
        with_(
            GOLD
            + ["flagged AS (SELECT *, CAST(closed_date IS NULL OR closed_date > created_date AS INTEGER) AS u FROM gold)"],
            """SELECT unique_key, agency, borough, round(sla_target_hours, 6) AS sla_target_hours, breach,
  CAST(coalesce(sum(u) OVER (PARTITION BY agency ORDER BY s0 RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
    AS backlog_7d_at_creation,
  CAST(hour(created_date) AS INTEGER) AS created_hour, CAST(dayofweek(created_date) + 1 AS INTEGER) AS created_dow,
  CAST(month(created_date) AS INTEGER) AS created_month, CAST(dayofweek(created_date) IN (0, 6) AS INTEGER) AS is_weekend
FROM flagged""",
        ),
    ),
    "one_row_per_key": Case(
        one_row_per_key,
        with_(
            TICKETS,
            """SELECT agency, complaint_type, unique_key FROM (
  SELECT *, row_number() OVER (PARTITION BY agency, complaint_type ORDER BY created_date, unique_key) AS r FROM tickets)
WHERE r = 1""",
        ),
    ),
    "filled_values": Case(
        filled_values,
        with_(
            TICKETS,
            "SELECT unique_key, CASE WHEN borough <> 'ASIA' THEN borough ELSE 'UNKNOWN' END AS borough, "
            "round(coalesce(resolution_hours, 0), 6) AS resolution_hours FROM tickets",
        ),
    ),
    "local_times": Case(
        local_times,
        with_(TICKETS, f"SELECT unique_key, {_iso('created_date')} AS local_iso, s0 - 5 * 3600 AS wall_s FROM tickets"),
    ),
    "finite_values": Case(
        finite_values,
        with_(
            TICKETS,
            "SELECT unique_key, CASE WHEN agency NOT IN ('click', 'view') THEN round(resolution_hours, 6) END AS value FROM tickets",
        ),
    ),
    "parsed_reasons": Case(
        parsed_reasons,
        with_(
            TICKETS,
            "SELECT unique_key, CAST(agency = 'click' AS INTEGER) AS n, "
            "CASE WHEN agency = 'click' THEN complaint_type END AS first_value FROM tickets",
        ),
    ),
}
