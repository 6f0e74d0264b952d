"""Backlog, flow, as-of and history queries (event tickets)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselens.checks.common import CFG, SPEC, Case, end_s, labeled, rounded, start_s, tickets
from caselens.checks.sql import LABELED, TICKETS, sec, with_
from caselens.functions.columns import day_number
from caselens.operators import flow, history
from caselens.operators.prefix import DAY
from caselens.storage import settle


def rows(spark, sf):
    return settle(tickets(spark, sf), "tickets")


def backlog_group(spark, sf):
    counted = flow.backlog(rows(spark, sf), SPEC, [SPEC.group], "agency_open_backlog")
    return counted.select(SPEC.key, "agency_open_backlog")


def backlog_subgroup(spark, sf):
    counted = flow.backlog(rows(spark, sf), SPEC, SPEC.pair, "complaint_open_backlog")
    return counted.select(SPEC.key, "complaint_open_backlog")


def flow_24h(spark, sf):
    counted = flow.flow_counts(rows(spark, sf), SPEC, [SPEC.group])
    return counted.select(SPEC.key, "agency_arrivals_24h", "agency_closures_24h")


def recent_unresolved_proxy(spark, sf):
    return flow.recent_unresolved_proxy(rows(spark, sf), SPEC).select(SPEC.key, "backlog_7d_at_creation")


def opened_so_far(spark, sf):
    return flow.opened_so_far(rows(spark, sf), SPEC).select(SPEC.key, "opened_so_far")


def opened_before(spark, sf):
    counted = flow.opened_so_far(rows(spark, sf), SPEC, "opened_before", strict=True)
    return counted.select(SPEC.key, "opened_before")


def open_as_of(spark, sf):
    return flow.open_as_of(tickets(spark, sf), SPEC, "2024-01-25 12:00:00").select(SPEC.key, SPEC.group, start_s(), end_s())


def open_during(spark, sf):
    return flow.open_during(tickets(spark, sf), SPEC, "2024-01-24", "2024-01-31").select(SPEC.key, start_s(), end_s())


def replay_instants(spark, sf):
    """Every third hour of the days on which tickets start, from the data."""
    days = tickets(spark, sf).select(F.to_date(SPEC.start).alias("day")).distinct()
    hours = F.explode(F.sequence(F.lit(0), F.lit(21), F.lit(3)))
    return days.select(F.col("day").cast("timestamp").alias("day"), hours.alias("h")).select(
        F.timestamp_seconds(F.unix_seconds("day") + F.col("h") * 3600).alias("as_of")
    )


def open_counts_many(spark, sf):
    """Open tickets per group at every third hour."""
    times = settle(replay_instants(spark, sf), "times")
    found = flow.open_counts_at(tickets(spark, sf), SPEC, times, [SPEC.group])
    return found.select(F.unix_seconds("as_of").alias("as_of_s"), SPEC.group, "n")


def instants_checked(spark, sf):
    """Every third hour, and which of them the replay range refuses."""
    checked = flow.instants_checked(replay_instants(spark, sf), *CFG.replay)
    return checked.select(F.unix_seconds("as_of").alias("as_of_s"), F.col("_reject_reason").alias("reason"))


def _history(spark, sf, keys):
    frame = settle(labeled(spark, sf), "labeled")
    daily = history.daily_outcomes(frame, SPEC)
    at = frame.select(*keys, day_number(SPEC.start).alias(history.DAY_COLUMN))
    found = history.trailing_history(daily, at, keys, CFG.history_days)
    return rounded(found.withColumnRenamed(history.DAY_COLUMN, "day"), history.MEDIAN, history.RATE)


def trailing_history_subgroup(spark, sf):
    return _history(spark, sf, SPEC.pair)


def trailing_history_group(spark, sf):
    return _history(spark, sf, [SPEC.group])


def history_for_starts(spark, sf):
    """History with the group's own as fallback, then zero."""
    frame = settle(labeled(spark, sf), "labeled")
    found = history.history_for_starts(frame, history.daily_outcomes(frame, SPEC), SPEC, CFG.history_days)
    return rounded(found.withColumnRenamed(history.DAY_COLUMN, "day"), history.MEDIAN, history.RATE)


def _backlog_sql(keys: list[str], out: str) -> str:
    match = " AND ".join(f"j.{k} = i.{k}" for k in keys)
    return with_(
        TICKETS,
        f"""SELECT i.unique_key, count(j.unique_key) AS {out} FROM tickets i
LEFT JOIN tickets j ON {match} AND j.s0 < i.s0 AND (j.s1 IS NULL OR j.s1 >= i.s0) GROUP BY i.unique_key""",
    )


def _history_cte(name: str, keys: list[str]) -> str:
    listed = ", ".join(f"d.{k}" for k in keys)
    match = " AND ".join(f"d.{k} = c.{k}" for k in keys)
    return f"""{name} AS (
  SELECT {listed}, d.day, quantile_disc(c.resolution_hours, 0.5) AS med, avg(c.late) AS rate
  FROM (SELECT DISTINCT {', '.join(keys)}, s0 // 86400 AS day FROM labeled) d
  LEFT JOIN outcomes c ON {match} AND c.day >= d.day - 28 AND c.day < d.day
  GROUP BY {listed}, d.day)"""


HISTORY = LABELED + [
    """outcomes AS (
  SELECT agency, complaint_type, s1 // 86400 AS day, resolution_hours,
         CAST(resolution_hours > sla_target_hours AS INTEGER) AS late
  FROM labeled WHERE NOT is_open AND sla_target_hours IS NOT NULL)""",
    _history_cte("own", ["agency", "complaint_type"]),
    _history_cte("parent", ["agency"]),
]
_H = "round({0}med, 6) AS hist_median_res_hrs_28d, round({0}rate, 6) AS hist_breach_rate_28d"

_FRAME = "(PARTITION BY agency ORDER BY s RANGE BETWEEN {0} PRECEDING AND {1})"

CASES = {
    "backlog_group": Case(backlog_group, _backlog_sql(["agency"], "agency_open_backlog")),
    "backlog_subgroup": Case(backlog_subgroup, _backlog_sql(["agency", "complaint_type"], "complaint_open_backlog")),
    "flow_24h": Case(
        flow_24h,
        with_(
            TICKETS
            + [
                f"""flows AS (
  SELECT unique_key, CAST(sum(a) OVER w AS BIGINT) AS a, CAST(sum(c) OVER w AS BIGINT) AS c, starts FROM (
    SELECT unique_key, agency, s0 AS s, 1 AS a, 0 AS c, true AS starts FROM tickets
    UNION ALL SELECT unique_key, agency, s1, 0, 1, false FROM tickets WHERE s1 IS NOT NULL)
  WINDOW w AS {_FRAME.format(DAY, "1 PRECEDING")})"""
            ],
            "SELECT unique_key, coalesce(a, 0) AS agency_arrivals_24h, coalesce(c, 0) AS agency_closures_24h "
            "FROM flows WHERE starts",
        ),
    ),
    "recent_unresolved_proxy": Case(
        recent_unresolved_proxy,
        with_(
            [TICKETS[0], TICKETS[1].replace("nxt AS closed_date,", "nxt AS closed_date, ")]
            + ["flagged AS (SELECT unique_key, agency, s0 AS s, CAST(closed_date IS NULL OR closed_date > created_date AS INTEGER) AS u FROM tickets)"],
            f"""SELECT unique_key, CAST(coalesce(sum(u) OVER {_FRAME.format(7 * DAY, "1 PRECEDING")}, 0) AS BIGINT)
  AS backlog_7d_at_creation FROM flagged""",
        ),
    ),
    "opened_so_far": Case(
        opened_so_far,
        with_(
            TICKETS,
            """SELECT unique_key, count(*) OVER (PARTITION BY agency ORDER BY s0
  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS opened_so_far FROM tickets""",
        ),
    ),
    "opened_before": Case(
        opened_before,
        with_(
            TICKETS,
            """SELECT unique_key, count(*) OVER (PARTITION BY agency ORDER BY s0
  RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS opened_before FROM tickets""",
        ),
    ),
    "open_as_of": Case(
        open_as_of,
        with_(
            TICKETS,
            """SELECT unique_key, agency, s0 AS start_s, s1 AS end_s FROM tickets
WHERE created_date < TIMESTAMP '2024-01-25 12:00:00'
  AND (closed_date IS NULL OR closed_date > TIMESTAMP '2024-01-25 12:00:00')""",
        ),
    ),
    "open_during": Case(
        open_during,
        with_(
            TICKETS,
            """SELECT unique_key, s0 AS start_s, s1 AS end_s FROM tickets
WHERE created_date < TIMESTAMP '2024-01-31' AND (closed_date IS NULL OR closed_date >= TIMESTAMP '2024-01-24')""",
        ),
    ),
    "open_counts_many": Case(
        open_counts_many,
        with_(
            TICKETS
            + [
                """times AS (
  SELECT day + INTERVAL (h) HOUR AS t
  FROM (SELECT DISTINCT date_trunc('day', created_date)::TIMESTAMP AS day FROM tickets), generate_series(0, 21, 3) g(h))"""
            ],
            f"""SELECT {sec('t')} AS as_of_s, agency, count(*) AS n FROM times
JOIN tickets ON created_date < t AND (closed_date IS NULL OR closed_date > t) GROUP BY t, agency""",
        ),
    ),
    "instants_checked": Case(
        instants_checked,
        with_(
            TICKETS,
            f"""SELECT {sec('t')} AS as_of_s,
  CASE WHEN t < TIMESTAMP '2024-01-24' OR t >= TIMESTAMP '2024-01-31' THEN 'as_of_out_of_range' END AS reason
FROM (SELECT day + INTERVAL (h) HOUR AS t
  FROM (SELECT DISTINCT date_trunc('day', created_date)::TIMESTAMP AS day FROM tickets), generate_series(0, 21, 3) g(h))""",
        ),
    ),
    "trailing_history_subgroup": Case(
        trailing_history_subgroup, with_(HISTORY, f"SELECT agency, complaint_type, day, {_H.format('')} FROM own")
    ),
    "trailing_history_group": Case(
        trailing_history_group, with_(HISTORY, f"SELECT agency, day, {_H.format('')} FROM parent")
    ),
    "history_for_starts": Case(
        history_for_starts,
        with_(
            HISTORY,
            """SELECT o.agency, o.complaint_type, o.day,
  round(coalesce(o.med, p.med, 0), 6) AS hist_median_res_hrs_28d,
  round(coalesce(o.rate, p.rate, 0), 6) AS hist_breach_rate_28d
FROM own o LEFT JOIN parent p ON o.agency = p.agency AND o.day = p.day""",
        ),
    ),
}
