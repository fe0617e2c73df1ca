"""CSV reading and table writing."""

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import SMALL
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ringtrail import schemas
from ringtrail.config import ASSESSMENTS, CIRCULAR_FLOW, config_frame, upsert_config
from ringtrail.sources import csv_files, fixtures, tables

HEADER = (
    "Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,"
    "Amount Paid,Payment Currency,Payment Format,Is Laundering\n"
)


def test_transactions_bind_by_position(spark, tmp_path):
    path = tmp_path / "trans.csv"
    path.write_text(HEADER + '2022/09/05 11:21,0223,8119F8CC0,0222,"A ""b"", c",56544.74,Saudi Riyal,56544.7,Yen,ACH,1\n')
    df = csv_files.read_transactions(spark, str(path))
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.TRANSACTIONS_RAW]
    row = df.first()
    assert row["event_timestamp"] == datetime(2022, 9, 5, 11, 21)
    assert row["from_bank"] == "0223" and row["to_account"] == 'A "b", c'
    assert row["amount_received"] == Decimal("56544.7400") and row["is_laundering"] == 1


def test_malformed_row_fails_the_load(spark, tmp_path):
    path = tmp_path / "trans.csv"
    path.write_text(HEADER + "2022/09/05 11:21,0223,8119,0222,811D,not a number,Yen,1,Yen,ACH,1\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_files.read_transactions(spark, str(path)).collect()


@pytest.mark.parametrize("row", ["2022/09/01 00:20,B1,,B2,2,5,Euro,5,Euro,ACH,0", "2022/09/01 00:20,B1,1,B2,2,,Euro,5,Euro,ACH,0"])
def test_a_missing_value_fails_the_load(spark, tmp_path, row):
    path = tmp_path / "t.csv"
    path.write_text("h\n" + row + "\n")
    with pytest.raises(Exception, match="NULL in column"):
        csv_files.read_transactions(spark, str(path)).collect()


def test_half_a_key_is_no_key(spark):
    from ringtrail.functions.columns import account_key

    rows = spark.createDataFrame([("B1", None), (None, "1"), ("B1", "1")], "b string, a string")
    assert [r[0] for r in rows.select(account_key("b", "a")).collect()] == [None, None, "B1:1"]


def test_missing_file_is_reported(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        csv_files.read_accounts(spark, str(tmp_path / "absent.csv"))


def test_csv_round_trip_of_derived_tables(spark, tmp_path):
    accounts = fixtures.derived_accounts(spark, SMALL)
    accounts.write.option("header", True).csv(str(tmp_path / "acc"))
    back = csv_files.read_accounts(spark, str(tmp_path / "acc"))
    assert back.exceptAll(accounts).count() == 0 and accounts.count() == back.count() == 50


def test_overwrite_reports_rows_and_repeats(spark, tmp_path):
    df = spark.range(7)
    for _ in range(2):
        report = tables.overwrite_table(df, str(tmp_path / "t"), "numbers")
        assert report.rows == 7 and report.rows_per_second > 0 and "7 rows" in str(report)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7


def test_replacing_one_assessment_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "entity")
    rows = [(i, "Account", f"a{i}", "r", a) for i, a in enumerate(["one_v1", "one_v1", "two_v1"])]
    df = spark.createDataFrame(rows, schemas.FINDING_ENTITY)
    tables.replace_assessment(df, path, "one_v1")
    tables.replace_assessment(df, path, "two_v1")
    read = lambda: tables.read_table(spark, path, schemas.FINDING_ENTITY)
    assert sorted(r["assessment_id"] for r in read().collect()) == ["one_v1", "one_v1", "two_v1"]
    # An empty result removes what was there.
    tables.replace_assessment(df.filter("false"), path, "one_v1")
    assert [r["assessment_id"] for r in read().collect()] == ["two_v1"]


def test_columns_added_later_read_as_null(spark, tmp_path):
    path = str(tmp_path / "old")
    old = spark.createDataFrame([(1, "Account", "a", "r")], "finding_id long, entity_type string, entity_id string, role string")
    old.write.parquet(path)
    row = tables.read_table(spark, path, schemas.GOLD_FINDING_ENTITY).first()
    assert row["entity_id"] == "a" and row["owner_party_id"] is None
    widened = tables.add_missing_columns(old, schemas.GOLD_FINDING_ENTITY)
    assert widened.columns == schemas.GOLD_FINDING_ENTITY.names and widened.first()["owner_party_id"] is None


def test_config_upsert(spark):
    from dataclasses import replace

    first, second = datetime(2024, 1, 1), datetime(2025, 1, 1)
    old = config_frame(spark, first, list(ASSESSMENTS.values())[:2])
    changed = replace(CIRCULAR_FLOW, title="New title", control_mapping={})
    added = ASSESSMENTS["laundering_exposure_v1"]
    rows = {r["assessment_id"]: r for r in upsert_config(old, config_frame(spark, second, [changed, added])).collect()}
    assert len(rows) == 3
    assert rows["circular_flow_v1"]["title"] == "New title" and rows["circular_flow_v1"]["control_mapping"] == {}
    assert rows["circular_flow_v1"]["created_at"] == first
    assert rows["mule_hub_v1"]["created_at"] == first and rows["laundering_exposure_v1"]["created_at"] == second
    assert rows["mule_hub_v1"]["finding_config"]["min_in_degree"] == 10


def test_derived_row_counts(spark):
    txns = fixtures.derived_transactions(spark, SMALL)
    row = txns.agg(
        F.count("*").alias("n"),
        F.sum("is_laundering").alias("labelled"),
        F.countDistinct("from_account").alias("payers"),
    ).first()
    assert (row["n"], row["labelled"], row["payers"]) == (6180, 265, 138)
