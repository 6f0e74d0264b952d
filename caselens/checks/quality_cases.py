"""Raw records, cleaning, quarantine and profiles (order-line records)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselens.checks.common import SPEC, Case, end_s, rounded, start_s
from caselens.checks.sql import sec, with_
from caselens.operators import profile, quality
from caselens.sources import tables, testdata
from caselens.storage import settle, shared_path

RAW = [
    """raw AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS unique_key,
         CASE WHEN l_linenumber = 7 AND l_quantity < 5 THEN NULL ELSE o_orderdate END AS created_date,
         CASE WHEN l_quantity > 48 THEN NULL ELSE l_shipdate END AS closed_date,
         upper(o_orderpriority) AS agency, p_type AS complaint_type,
         CASE WHEN p_size >= 10 THEN p_brand || ', size "' || CAST(p_size AS VARCHAR) || '"' END AS descriptor,
         CASE WHEN l_returnflag = 'R' THEN upper(c_mktsegment) END AS borough,
         upper(c_mktsegment) AS channel,
         CASE WHEN l_linestatus = 'F' THEN 'Closed' ELSE 'In Progress' END AS status,
         l_returnflag, l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey)""",
    f"""timed AS (
  SELECT *, {sec('created_date')} AS start_s, {sec('closed_date')} AS end_s,
         closed_date IS NULL OR status <> 'Closed' AS is_open,
         ({sec('closed_date')} - {sec('created_date')}) / 3600.0::DOUBLE AS resolution_hours
  FROM raw)""",
    """tagged AS (
  SELECT *, CASE WHEN created_date IS NULL THEN 'created_date_unparseable'
                 WHEN closed_date < created_date THEN 'closed_before_created'
                 WHEN resolution_hours > 4320 THEN 'resolution_exceeds_180d' END AS reason
  FROM timed)""",
]

ROW = "unique_key, start_s, end_s, agency, complaint_type, descriptor, borough, channel, status, is_open, "


def raw(spark, sf):
    return testdata.raw_from_orders(spark, sf)


def named_channel(df):
    return df.withColumnRenamed("open_data_channel_type", SPEC.channel)


def tagged(spark, sf):
    return quality.clean(named_channel(raw(spark, sf)), SPEC)


def rows_of(df):
    return rounded(
        df.select(
            SPEC.key, start_s(), end_s(), SPEC.group, SPEC.subgroup, SPEC.detail, SPEC.region, SPEC.channel,
            SPEC.status, SPEC.is_open, SPEC.hours, *([quality.REASON] if quality.REASON in df.columns else []),
        ),
        SPEC.hours,
    )


def silver_valid(spark, sf):
    return rows_of(quality.split_rejects(tagged(spark, sf))[0])


def silver_rejected(spark, sf):
    return rows_of(quality.split_rejects(tagged(spark, sf))[1]).withColumnRenamed(quality.REASON, "reject_reason")


def reject_counts(spark, sf):
    counted = quality.reject_counts(quality.split_rejects(tagged(spark, sf))[1])
    return counted.withColumnRenamed(quality.REASON, "reject_reason")


def open_counts(spark, sf):
    return quality.open_counts(quality.split_rejects(tagged(spark, sf))[0], SPEC)


def duration_profile(spark, sf):
    valid = settle(quality.split_rejects(tagged(spark, sf))[0].select(SPEC.is_open, SPEC.hours), "valid")
    return quality.duration_profile(valid, SPEC)


def reconcile(spark, sf):
    rows, seen = quality.watch_rejects(tagged(spark, sf), quality.reject_rules(SPEC))
    settle(rows, "tagged")
    return rounded(quality.reconcile_watched(spark, seen), "reject_rate", "acceptance_rate")


def raw_csv_scan(spark, sf):
    """Text records through quoted CSV and back, with provenance."""
    path = shared_path(spark, "csv")
    raw(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    bronze = tables.with_provenance(tables.read_raw_csv(spark, path))
    stamped = F.col("_ingested_at").isNotNull() & F.col("_source_file").contains(".csv")
    return bronze.select(
        "unique_key", "agency", "descriptor", "borough", "status",
        (F.length("created_date") > 7).alias("has_time"), stamped.alias("stamped"),
    )


def blank_counts(spark, sf):
    return profile.blank_counts(raw(spark, sf))


def duplicate_keys(spark, sf):
    lines = testdata.table(spark, sf, "lineitem")
    return profile.duplicate_keys(lines.select(F.struct("l_orderkey", "l_linenumber").alias("key")), "key")


def time_profile(spark, sf):
    profiled = profile.time_profile(raw(spark, sf), ["created_date", "closed_date"])
    return profiled.select(
        "column", F.unix_seconds("min_time").alias("min_s"), F.unix_seconds("max_time").alias("max_s"), "unparseable"
    )


def value_counts(spark, sf):
    return profile.value_counts(raw(spark, sf), ["agency", "status", "borough"])


def top_values(spark, sf):
    return profile.top_values(testdata.table(spark, sf, "part"), "p_brand", 15)


def populated_rate(spark, sf):
    return profile.populated_rate(raw(spark, sf), "due_date", "agency")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def monthly_matrix(spark, sf):
    orders = testdata.table(spark, sf, "orders")
    return profile.monthly_matrix(orders, "o_orderdate", "o_orderpriority", PRIORITIES)


def extract_slice(spark, sf):
    orders = testdata.table(spark, sf, "orders").withColumnsRenamed(
        {"o_orderdate": SPEC.start, "o_orderpriority": SPEC.group}
    )
    kept = tables.extract_slice(
        orders, SPEC, "1996-01-01", "1997-01-01", ["1-URGENT", "5-LOW"], ["o_orderkey", SPEC.group, SPEC.start]
    )
    return kept.select("o_orderkey", SPEC.group, F.unix_seconds(F.col(SPEC.start).cast("timestamp")).alias("start_s"))


def managed_table(spark, sf):
    """Namespace, overwrite, schema replacement, required-table check and table scan."""
    location = shared_path(spark, "namespace")
    space = "caselens_" + location.rsplit("-", 1)[1]
    tables.ensure_namespace(spark, space, location)
    name = f"{space}.orders"
    orders = testdata.table(spark, sf, "orders")
    tables.save_table(orders.select("o_orderkey", "o_orderstatus"), name)
    tables.save_table(orders.select("o_orderkey", "o_orderpriority"), name, replace_schema=True)
    tables.require_tables(spark, [name])
    return spark.table(name)


def records_roundtrip(spark, sf):
    """Aggregates to JSON records and back."""
    path = shared_path(spark, "records")
    tables.export_records(quality.reject_counts(quality.split_rejects(tagged(spark, sf))[1]), path)
    return tables.read_records(spark, path, f"{quality.REASON} string, n bigint").withColumnRenamed(
        quality.REASON, "reject_reason"
    )


def _blank_sql() -> str:
    blanks = {
        "unique_key": "0", "created_date": "0", "closed_date": "sum(CAST(closed_date IS NULL AS INTEGER))",
        "agency": "0", "complaint_type": "0", "descriptor": "sum(CAST(descriptor IS NULL AS INTEGER))",
        "borough": "sum(CAST(l_returnflag = 'A' AS INTEGER))", "open_data_channel_type": "0", "status": "0",
        "due_date": "sum(CAST(l_tax <= 0.07 AS INTEGER))",
    }
    return with_(RAW, "SELECT " + ", ".join(f"CAST({e} AS BIGINT) AS {c}" for c, e in blanks.items()) + " FROM tagged")


CASES = {
    "silver_valid": Case(
        silver_valid,
        with_(RAW, f"SELECT {ROW} round(resolution_hours, 6) AS resolution_hours FROM tagged WHERE reason IS NULL"),
    ),
    "silver_rejected": Case(
        silver_rejected,
        with_(
            RAW,
            f"SELECT {ROW} round(resolution_hours, 6) AS resolution_hours, reason AS reject_reason "
            "FROM tagged WHERE reason IS NOT NULL",
        ),
    ),
    "reject_counts": Case(
        reject_counts,
        with_(RAW, "SELECT reason AS reject_reason, count(*) AS n FROM tagged WHERE reason IS NOT NULL GROUP BY reason"),
    ),
    "open_counts": Case(
        open_counts, with_(RAW, "SELECT is_open, count(*) AS n FROM tagged WHERE reason IS NULL GROUP BY is_open")
    ),
    "duration_profile": Case(
        duration_profile,
        with_(
            RAW,
            """SELECT round(min(resolution_hours), 1) AS min_h, round(quantile_disc(resolution_hours, 0.5), 1) AS median_h,
  round(quantile_disc(resolution_hours, 0.75), 1) AS p75_h, round(quantile_disc(resolution_hours, 0.95), 1) AS p95_h,
  round(max(resolution_hours), 1) AS max_h FROM tagged WHERE reason IS NULL AND NOT is_open""",
        ),
    ),
    "reconcile": Case(
        reconcile,
        with_(
            RAW,
            """SELECT count(*) AS bronze_rows, count(*) FILTER (reason IS NULL) AS silver_rows,
  count(*) FILTER (reason IS NOT NULL) AS rejected_rows, true AS balanced,
  round(count(*) FILTER (reason IS NOT NULL) / count(*), 6) AS reject_rate,
  round(count(*) FILTER (reason IS NULL) / count(*), 6) AS acceptance_rate FROM tagged""",
        ),
    ),
    "raw_csv_scan": Case(
        raw_csv_scan,
        """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS unique_key,
  lower(o_orderpriority) AS agency,
  CASE WHEN p_size >= 10 THEN p_brand || ', size "' || CAST(p_size AS VARCHAR) || '"' END AS descriptor,
  CASE WHEN l_returnflag = 'N' THEN 'Unspecified' WHEN l_returnflag <> 'A' THEN lower(c_mktsegment) END AS borough,
  CASE WHEN l_linestatus = 'F' THEN 'CLOSED' ELSE 'in progress' END AS status,
  NOT (l_linenumber = 7 AND l_quantity < 5) AS has_time, true AS stamped
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey""",
    ),
    "blank_counts": Case(blank_counts, _blank_sql()),
    "duplicate_keys": Case(
        duplicate_keys,
        """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows,
  CAST(count(*) FILTER (n > 1) AS BIGINT) AS repeated_keys
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    ),
    "time_profile": Case(
        time_profile,
        with_(
            RAW,
            """SELECT 'created_date' AS column, min(start_s) AS min_s, max(start_s) AS max_s,
  CAST(count(*) FILTER (start_s IS NULL) AS BIGINT) AS unparseable FROM tagged
UNION ALL SELECT 'closed_date', min(end_s), max(end_s), CAST(0 AS BIGINT) FROM tagged""",
        ),
    ),
    "value_counts": Case(
        value_counts,
        """WITH r AS (SELECT ' ' || lower(o_orderpriority) AS agency,
  CASE WHEN l_linestatus = 'F' THEN ' CLOSED' ELSE 'in progress' END AS status,
  CASE WHEN l_returnflag = 'N' THEN ' Unspecified ' WHEN l_returnflag = 'A' THEN '' ELSE lower(c_mktsegment) END AS borough
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
SELECT 'agency' AS column, agency AS value, count(*) AS n FROM r GROUP BY 2
UNION ALL SELECT 'status', status, count(*) FROM r GROUP BY 2
UNION ALL SELECT 'borough', borough, count(*) FROM r GROUP BY 2""",
    ),
    "top_values": Case(
        top_values, "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 15"
    ),
    "populated_rate": Case(
        populated_rate,
        """WITH r AS (SELECT ' ' || lower(o_orderpriority) AS agency, CAST(l_tax > 0.07 AS INTEGER) AS filled
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT 'overall' AS level, CAST(NULL AS VARCHAR) AS agency, round(avg(filled) * 100, 1) AS populated_pct FROM r
UNION ALL SELECT 'group', agency, round(avg(filled) * 100, 1) FROM r GROUP BY agency""",
    ),
    "monthly_matrix": Case(
        monthly_matrix,
        """SELECT strftime(o_orderdate, '%Y-%m') AS month,
  count(*) FILTER (o_orderpriority = '1-URGENT') AS "1-URGENT",
  count(*) FILTER (o_orderpriority = '2-HIGH') AS "2-HIGH",
  count(*) FILTER (o_orderpriority = '3-MEDIUM') AS "3-MEDIUM",
  count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS "4-NOT SPECIFIED",
  count(*) FILTER (o_orderpriority = '5-LOW') AS "5-LOW", count(*) AS total
FROM orders GROUP BY 1""",
    ),
    "extract_slice": Case(
        extract_slice,
        f"""SELECT o_orderkey, o_orderpriority AS agency, {sec('o_orderdate')} AS start_s FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
  AND o_orderpriority IN ('1-URGENT', '5-LOW')""",
    ),
    "managed_table": Case(managed_table, "SELECT o_orderkey, o_orderpriority FROM orders"),
    "records_roundtrip": Case(
        records_roundtrip,
        with_(RAW, "SELECT reason AS reject_reason, count(*) AS n FROM tagged WHERE reason IS NOT NULL GROUP BY reason"),
    ),
}
