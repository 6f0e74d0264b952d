"""Cleaning and quarantine on literal raw rows."""

from __future__ import annotations

import pytest

from caselens.operators import profile, quality
from caselens.plans import medallion
from caselens.sources import tables
from caselens.spec import LifecycleSpec
from caselens.storage import settle

SPEC = LifecycleSpec()
COLUMNS = "unique_key string, created_date string, closed_date string, agency string, complaint_type string, descriptor string, borough string, channel string, status string"
ROWS = [
    ("bad-start", "yesterday", "2025-01-01T00:00:00.000", " ab ", " Noise ", " ", "unspecified", "phone", "closed"),
    ("blank-end", "2025-01-01T00:00:00.000", "", "AB", "Noise", "loud", "Bronx ", "Phone", " CLOSED "),
    ("missing-end", "2025-01-01T00:00:00.000", None, "ab", "Noise", None, "", "PHONE", "open"),
    ("same", "2025-01-01T00:00:00.000", "2025-01-01T00:00:00.000", "AB", "Noise", "x", "BRONX", "PHONE", "Closed"),
    ("backwards", "2025-01-01T00:00:01.000", "2025-01-01T00:00:00.000", "AB", "Noise", "x", "BRONX", "PHONE", "Closed"),
    ("180-days", "2025-01-01T00:00:00.000", "2025-06-30T00:00:00.000", "AB", "Noise", "x", "BRONX", "PHONE", "Closed"),
    ("too-long", "2025-01-01T00:00:00.000", "2025-06-30T00:00:01.000", "AB", "Noise", "x", "BRONX", "PHONE", "Closed"),
    ("no-status", "2025-01-01T00:00:00.000", "2025-01-02T00:00:00.000", "AB", "Noise", "x", "BRONX", "PHONE", None),
    ("in-progress", "2025-01-01T00:00:00.000", "2025-01-02T00:00:00.000", "AB", "Noise", "x", "BRONX", "PHONE", "in progress"),
]


@pytest.fixture(scope="module")
def cleaned(spark):
    return quality.clean(spark.createDataFrame(ROWS, COLUMNS), SPEC)


@pytest.fixture(scope="module")
def by_key(cleaned):
    return {r["unique_key"]: r for r in cleaned.collect()}


def test_first_failing_rule_wins(by_key):
    reasons = {k: r["_reject_reason"] for k, r in by_key.items() if r["_reject_reason"]}
    assert reasons == {
        "bad-start": "created_date_unparseable",
        "backwards": "closed_before_created",
        "too-long": "resolution_exceeds_180d",
    }


def test_durations(by_key):
    assert by_key["same"]["resolution_hours"] == 0.0
    assert by_key["180-days"]["resolution_hours"] == 4320.0
    assert by_key["blank-end"]["resolution_hours"] is None


def test_open_flag_is_three_valued(by_key):
    flags = {k: r["is_open"] for k, r in by_key.items()}
    assert flags["no-status"] is None
    assert flags["blank-end"] and flags["missing-end"] and flags["in-progress"]
    assert flags["same"] is False


def test_text_is_normalised(by_key):
    row = by_key["bad-start"]
    assert (row["agency"], row["complaint_type"], row["descriptor"], row["borough"], row["channel"], row["status"]) == (
        "AB", "Noise", None, None, "PHONE", "Closed",
    )
    assert by_key["missing-end"]["borough"] is None
    assert by_key["blank-end"]["borough"] == "BRONX"


def test_split_keeps_every_row(spark, cleaned):
    valid, rejected = quality.split_rejects(cleaned)
    row = quality.reconcile(cleaned, valid, rejected).first()
    watched, seen = quality.watch_rejects(cleaned, quality.reject_rules(SPEC))
    settle(watched, "watched")
    assert quality.reconcile_watched(spark, seen).first() == row
    assert (row["bronze_rows"], row["silver_rows"], row["rejected_rows"], row["balanced"]) == (9, 6, 3, True)


def test_overlong_rows_can_feed_the_backlog(cleaned):
    assert {r["unique_key"] for r in medallion.keep_overlong(cleaned).collect()} >= {"too-long", "same"}


def test_quoted_csv_and_tables(spark, tmp_path):
    text = (
        ",".join(tables.RAW_COLUMNS)
        + '\nk1,2025-01-01T00:00:00.000,2025-01-01T05:00:00.000,ab,Noise,"two\nlines, ""quoted""",Bronx,phone,closed,\n'
        + "k2,2025-01-01T00:00:00.000,,ab,Noise,plain,Unspecified,phone,open,2025-01-09T00:00:00.000\n"
        + "k3,nope,,ab,Noise,plain,Bronx,phone,open,\n"
    )
    path = tmp_path / "raw.csv"
    path.write_text(text)
    tables.ensure_namespace(spark, "plans_test", str(tmp_path / "space"))
    bronze = medallion.build_bronze(spark, str(path), "plans_test.bronze")
    assert bronze.where("unique_key = 'k1'").first()["descriptor"] == 'two\nlines, "quoted"'
    assert bronze.where("_source_file like '%raw.csv' and _ingested_at is not null").count() == 3
    blanks = profile.blank_counts(bronze).first().asDict()
    assert blanks["due_date"] == 2 and blanks["closed_date"] == 2 and "_source_file" not in blanks

    silver, rejected = medallion.build_silver(bronze, SPEC, "plans_test.silver", "plans_test.rejected")
    assert (silver.count(), rejected.count()) == (2, 1)
    # Written once, partitioned by the flag; each side reads its own partition.
    for side, kept in ((silver, "NOT _refused"), (rejected, "_refused")):
        scan = side._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(_refused" in scan and "Filter" not in scan.replace("PartitionFilters", "").replace("PushedFilters", "").replace("DataFilters", "")
    assert "_refused" not in silver.columns and quality.REASON in rejected.columns
    built = medallion.build_gold(silver, SPEC, "plans_test.gold_", min_n=1)
    tables.require_tables(spark, [f"plans_test.gold_{n}" for n in built])
    assert built["tickets_labeled"].where("unique_key = 'k1'").first()["breach"] == 0
    row = built["features"].where("unique_key = 'k2'").first()
    assert (row["backlog_7d_at_creation"], row["created_dow"], row["is_weekend"]) == (0, 4, 0)

    with pytest.raises(FileNotFoundError, match="plans_test.a, plans_test.b"):
        tables.require_tables(spark, ["plans_test.a", "plans_test.silver", "plans_test.b"])
    with pytest.raises(ValueError):
        tables.save_table(silver.select("unique_key"), "plans_test.silver")
    assert tables.save_table(silver.select("unique_key"), "plans_test.silver2").columns == ["unique_key"]
    replaced = tables.save_table(spark.range(3), "plans_test.silver2", replace_schema=True)
    assert replaced.columns == ["id"]


def test_json_list_on_one_line_and_indented(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"agency": "A", "n": 1}, {"agency": "B", "n": 2}]')
    (tmp_path / "b.json").write_text('[\n {"agency": "A", "n": 1},\n {"agency": "B", "n": 2}\n]')
    assert tables.read_records(spark, str(tmp_path / "a.json")).count() == 2
    assert tables.read_records(spark, str(tmp_path / "b.json"), multi_line=True).count() == 2


def test_profiles(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01"), ("a", "x"), ("a", " "), ("b", None), ("c", "2024-03-01")], "k string, t string"
    )
    assert profile.duplicate_keys(df, "k").first() == (2, 1)
    row = profile.time_profile(df, ["t"]).first()
    assert (str(row["min_time"])[:10], str(row["max_time"])[:10], row["unparseable"]) == ("2024-01-01", "2024-03-01", 1)
    first = profile.one_row_per_key(df.na.fill("z"), ["k"], ["t"])
    assert {r["k"]: r["t"] for r in first.collect()} == {"a": " ", "b": "z", "c": "2024-03-01"}
