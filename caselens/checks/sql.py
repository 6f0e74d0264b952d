"""Shared pieces of the comparison SQL (ANSI, run by DuckDB on the same tables)."""

from __future__ import annotations

SECONDS = "CAST(floor(epoch({0})) AS BIGINT)"


def sec(column: str) -> str:
    return SECONDS.format(column)


def with_(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


TICKETS = [
    """ev AS (
  SELECT event_id, ts, user_id, event_type, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt
  FROM events)""",
    f"""tickets AS (
  SELECT CAST(event_id AS VARCHAR) AS unique_key, ts AS created_date, nxt AS closed_date,
         event_type AS agency,
         CASE WHEN k < 40 THEN 'K-COMMON' WHEN k < 70 THEN 'K-MID' WHEN k < 90 THEN 'K-LOW'
              ELSE 'K-RARE' || CAST(k AS VARCHAR) END AS complaint_type,
         r_name AS borough, c_mktsegment AS channel,
         CASE WHEN nxt IS NULL THEN 'Open' ELSE 'Closed' END AS status,
         nxt IS NULL AS is_open,
         {sec('ts')} AS s0, {sec('nxt')} AS s1,
         ({sec('nxt')} - {sec('ts')}) / 3600.0::DOUBLE AS resolution_hours
  FROM ev
  LEFT JOIN customer ON user_id = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)""",
]


def targets(name: str, source: str, min_n: int, q: float = 0.75) -> list[str]:
    return [
        f"""{name}_agency AS (
  SELECT agency, quantile_disc(resolution_hours, {q}) AS agency_p75 FROM {source} GROUP BY agency)""",
        f"""{name} AS (
  SELECT g.agency, g.complaint_type, n_closed,
         CASE WHEN n_closed >= {min_n} THEN p ELSE agency_p75 END AS sla_target_hours, agency_p75,
         CASE WHEN n_closed >= {min_n} THEN 'group_p75' ELSE 'agency_p75_fallback' END AS target_source
  FROM (SELECT agency, complaint_type, count(*) AS n_closed, quantile_disc(resolution_hours, {q}) AS p
        FROM {source} GROUP BY agency, complaint_type) g
  LEFT JOIN {name}_agency a ON g.agency = a.agency)""",
    ]


CLOSED = ["closed AS (SELECT * FROM tickets WHERE NOT is_open)"]

GOLD = TICKETS + CLOSED + targets("gold_targets", "closed", 50) + [
    """gold AS (
  SELECT t.*, g.sla_target_hours,
         CASE WHEN is_open THEN NULL ELSE CAST(resolution_hours > g.sla_target_hours AS INTEGER) END AS breach
  FROM tickets t LEFT JOIN gold_targets g ON t.agency = g.agency AND t.complaint_type = g.complaint_type)"""
]

SPLIT = TICKETS + [
    """split AS (
  SELECT *, CASE
    WHEN created_date >= TIMESTAMP '2024-01-04' AND created_date < TIMESTAMP '2024-01-16' THEN 'train'
    WHEN created_date >= TIMESTAMP '2024-01-18' AND created_date < TIMESTAMP '2024-01-22' THEN 'val'
    WHEN created_date >= TIMESTAMP '2024-01-24' AND created_date < TIMESTAMP '2024-01-31' THEN 'test' END AS split
  FROM tickets)"""
]

FROZEN = SPLIT + ["train_closed AS (SELECT * FROM split WHERE split = 'train' AND NOT is_open)"] + targets(
    "frozen", "train_closed", 50
)

LABELED = FROZEN + [
    f"""aged AS (
  SELECT t.*, coalesce(f.sla_target_hours, a.agency_p75) AS sla_target_hours,
         ({sec("TIMESTAMP '2024-02-01'")} - s0) / 3600.0::DOUBLE AS age_at_observation_hours
  FROM split t
  LEFT JOIN frozen f ON t.agency = f.agency AND t.complaint_type = f.complaint_type
  LEFT JOIN frozen_agency a ON t.agency = a.agency)""",
    """lab AS (
  SELECT *, CASE WHEN sla_target_hours IS NULL THEN NULL
                 WHEN NOT is_open THEN CAST(resolution_hours > sla_target_hours AS INTEGER)
                 WHEN age_at_observation_hours > sla_target_hours THEN 1 END AS breach
  FROM aged)""",
    """labeled AS (
  SELECT *, CASE WHEN NOT is_open THEN 'closed_outcome' WHEN breach = 1 THEN 'open_known_breach'
                 ELSE 'open_censored' END AS label_state
  FROM lab)""",
]

SCORED = LABELED + [
    "base AS (SELECT avg(breach) AS rate FROM labeled WHERE split = 'train')",
    """rates AS (
  SELECT agency, complaint_type, avg(breach) AS group_rate
  FROM labeled WHERE split = 'train' AND breach IS NOT NULL GROUP BY agency, complaint_type)""",
    """scored AS (
  SELECT l.*, round(coalesce(group_rate, (SELECT rate FROM base)), 9) AS score
  FROM labeled l LEFT JOIN rates r ON l.agency = r.agency AND l.complaint_type = r.complaint_type)""",
    "test AS (SELECT * FROM scored WHERE split = 'test' AND breach IS NOT NULL)",
]
