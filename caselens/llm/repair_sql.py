"""SQL of the repaired conversations: the same edits by a recursion over rows that keeps the best way to each state."""

from __future__ import annotations


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text; the relation ``crc`` has the steps of the code for all bytes."""
    return (
        f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({text}) + 1), "
        f"lambda i: ascii(substr({text}, i, 1))::BIGINT)), "
        "lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])))"
    )


CRC = """crc AS (
  SELECT list(step ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, b: xor(c >> 1, 3988292384 * (c & 1))) AS step FROM range(256) t(i))
)"""


def more(state: str, cost: str, letter: str, line: str) -> str:
    """A way with one more edit: nine digits of its cost, its letters, a mark, and the text so far."""
    return (
        f"(lpad((substr({state}, 1, 9)::INTEGER + {cost})::VARCHAR, 9, '0') || substr(split_part({state}, chr(1), 1), 10) || '{letter}' "
        f"|| substr({state}, strpos({state}, chr(1))) || {line})"
    )


def inserting(z: str, s: str, u: str, a: str) -> str:
    """The ways to the states nothing, s, u and a when turns may be inserted."""

    def made(state: str, role: str) -> str:
        return more(state, "5", "I", f"chr(10) || '{role}:'")

    user = f"least({u}, {made(z, 'user')}, {made(s, 'user')}, {made(a, 'user')})"
    other = f"least({a}, {made(u, 'assistant')}, {made(made(z, 'user'), 'assistant')}, {made(made(s, 'user'), 'assistant')})"
    return f"{z} AS z, {s} AS s, {user} AS u, {other} AS a"


def drop(q: str) -> str:
    return more(f"w.{q}", "2", "D", "''")


def keep(q: str, initial: str) -> str:
    kept = more(f"w.{q}", "r.extra", "K", "chr(10) || r.role || ':' || r.text")
    return f"CASE WHEN r.fault IN (0, 3) AND left(r.role, 1) = '{initial}' THEN {kept} END"


def reroled(q: str, role: str) -> str:
    made = more(f"w.{q}", "(r.extra + 1)", "R", f"chr(10) || '{role}:' || r.text")
    return f"CASE WHEN r.fault IN (0, 3) THEN {made} END"


SQL = rf"""
WITH RECURSIVE {CRC}, keyed AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), hit AS (SELECT keyed.*, {crc32('k')} % 20 AS how FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE how WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
    unnest(range(CASE how WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE how <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged
), faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault,
    CASE WHEN left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END AS illegal
  FROM placed
), lines AS (SELECT *, CASE fault WHEN 3 THEN 5 ELSE 0 END AS extra FROM faults
), counts AS (
  SELECT conv_id, max(i) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, sum(illegal) AS illegal
  FROM lines GROUP BY conv_id
), ways AS (
  SELECT conv_id, 0::BIGINT AS i, {inserting("('000000000' || chr(1))", 'NULL::VARCHAR', 'NULL::VARCHAR', 'NULL::VARCHAR')}
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {inserting('z', 's', 'u', 'a')} FROM (
    SELECT w.conv_id, r.i, {drop('z')} AS z, least({drop('s')}, {keep('z', 's')}) AS s,
      least({drop('u')}, {', '.join(way for q in 'zsa' for way in (keep(q, 'u'), reroled(q, 'user')))}) AS u,
      least({drop('a')}, {keep('u', 'a')}, {reroled('u', 'assistant')}) AS a
    FROM ways w JOIN lines r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1)
), ends AS (
  SELECT w.conv_id, gaps, blank, duplicate, truncated, illegal, least(z, a) AS best
  FROM ways w LEFT JOIN counts c ON w.conv_id IS NOT DISTINCT FROM c.conv_id WHERE w.i = coalesce(n, 0)
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, substr(best, 1, 9)::BIGINT AS cost,
  substr(split_part(best, chr(1), 1), 10) AS audit, sha256(substr(best, strpos(best, chr(1)) + 2)) AS repaired_sha256
FROM ends
"""
