"""Balance rules and payloads."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from ledgerlane.config import DEFAULT_RULES
from ledgerlane.operators.checks import LoadError
from ledgerlane.operators.rules import corrected_balance
from ledgerlane.schemas import ACCOUNT_MAP
from ledgerlane.sources.payload import (
    account_readings,
    account_snapshot,
    checked_snapshot,
    encode_payload,
    payload_records,
    payload_snapshot,
    read_payload_files,
)
from ledgerlane.sources.workspace import new_run_folder
from tests.rows import at, dec

COLUMNS = {"card": "c", "coin": "b"}


@pytest.mark.parametrize(
    ("kind", "name", "balance", "expected"),
    [
        ("credit", "Visa", 10.0, -10),
        ("credit", "Visa", 0.0, 0),
        ("credit", "Visa", -5.0, -5),
        ("credit", "BTC", 0.0, 2000),
        ("credit", "BTC", 3.0, -3),
        ("bank", "BTC", 0.0, 2000),
        ("bank", "btc", 0.0, 0),
        ("bank", "ETH", 0.0, 1600),
        ("bank", "ETH", 0.5, 0.5),
        ("bank", "USDC", 999.99, 17500),
        ("bank", "USDC", 1000.0, 1000),
        (None, None, 12.0, 12),
        (None, "USDC", 1.0, 17500),
    ],
)
def test_shipped_rules(spark, kind, name, balance, expected):
    df = spark.createDataFrame([(kind, name, balance)], "k string, n string, b double")
    value = df.select(corrected_balance(DEFAULT_RULES, F.col("b"), F.col("k"), F.col("n")))
    assert value.first()[0] == expected


def test_no_rules_keep_the_balance(spark):
    df = spark.createDataFrame([("credit", "x", 3.0)], "k string, n string, b double")
    assert df.select(corrected_balance((), F.col("b"), F.col("k"), F.col("n"))).first()[0] == 3.0


def record(account_id, balance, kind="bank", name="Any", **more):
    return {
        "id": account_id,
        "accountType": kind,
        "accountName": name,
        "currentBalance": balance,
        **more,
    }


def payloads(spark, *lists):
    rows = [(1, at("2024-01-01 10:00:00"), json.dumps(records)) for records in lists]
    return spark.createDataFrame(
        rows, "portfolio_id bigint, datetime_now timestamp_ntz, payload string"
    )


def test_last_duplicate_wins_and_unmapped_accounts_are_ignored(spark):
    df = payloads(
        spark,
        [record("b", 1), record("c", 5, "credit", extra={"x": 1}), record("z", 9), record("b", 2)],
    )
    row = payload_snapshot(df, COLUMNS).first()
    assert (row["card"], row["coin"]) == (-5, 2)
    assert row["missing"] == [] and row["unreadable"] == []
    assert list(row.asDict())[2:4] == ["card", "coin"]

    by_row = account_snapshot(payload_records(df), COLUMNS).first()
    assert (by_row["card"], by_row["coin"], by_row["missing"]) == (-5, 2, [])


@pytest.mark.parametrize("through_rows", [False, True])
def test_missing_account_stops_the_load(spark, through_rows):
    df = payloads(spark, [record("b", 1)])
    wide = (
        account_snapshot(payload_records(df), COLUMNS)
        if through_rows
        else payload_snapshot(df, COLUMNS)
    )
    with pytest.raises(LoadError, match="'missing': \\['c'\\]"):
        checked_snapshot(wide, new_run_folder(spark, "test"))


@pytest.mark.parametrize("through_rows", [False, True])
def test_null_balance_stops_the_load(spark, through_rows):
    df = payloads(spark, [record("b", 1), record("c", 3), record("c", None)])
    wide = (
        account_snapshot(payload_records(df), COLUMNS)
        if through_rows
        else payload_snapshot(df, COLUMNS)
    )
    with pytest.raises(LoadError, match="'unreadable': \\['c'\\]"):
        checked_snapshot(wide, new_run_folder(spark, "test"))


@pytest.mark.parametrize("through_rows", [False, True])
@pytest.mark.parametrize("absent", ["accountType", "accountName"])
def test_account_without_type_or_name_stops_the_load(spark, through_rows, absent):
    df = payloads(spark, [record("b", 1), record("c", 5) | {absent: None}])
    wide = (
        account_snapshot(payload_records(df), COLUMNS)
        if through_rows
        else payload_snapshot(df, COLUMNS)
    )
    with pytest.raises(LoadError, match="'unreadable': \\['c'\\]"):
        checked_snapshot(wide, new_run_folder(spark, "test"))


def test_lone_record_is_no_list(spark):
    df = payloads(spark, [record("b", 1)]).withColumn("payload", F.lit(json.dumps(record("b", 1))))
    with pytest.raises(Exception, match="not a list"):
        payload_snapshot(df, COLUMNS).collect()


def test_overwritten_null_balance_is_fine(spark):
    df = payloads(spark, [record("b", 1), record("c", None), record("c", 3)])
    checked = checked_snapshot(payload_snapshot(df, COLUMNS), new_run_folder(spark, "test"))
    assert tuple(checked.first())[2:] == (3, 1)


@pytest.mark.parametrize("text", ["not json", '[{"id": "b", "currentBalance": "five"}]'])
def test_broken_payload_stops_the_job(spark, text):
    df = payloads(spark, [record("b", 1)]).withColumn("payload", F.lit(text))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        payload_snapshot(df, COLUMNS).collect()


def test_maps_per_portfolio(spark):
    df = payloads(spark, [record("b", 1), record("c", 5, "credit"), record("b", 0, name="BTC")])
    account_map = spark.createDataFrame(
        [(1, 1, "coin", "b"), (1, 2, "gone", "q"), (2, 1, "other", "b")], ACCOUNT_MAP
    )
    rows = [
        (r["position"], r["column_name"], r["balance"], r["found"])
        for r in account_readings(df, account_map).orderBy("position").collect()
    ]
    assert rows == [(1, "coin", dec("2000.00"), True), (2, "gone", None, False)]


def test_payload_files_and_json_round_trip(spark, tmp_path):
    folder = tmp_path / "portfolio_id=7"
    folder.mkdir()
    (folder / "payload.json").write_text(json.dumps([record("b", 1.5), record("c", 2)], indent=4))
    df = read_payload_files(spark, str(tmp_path))
    records = payload_records(df)
    assert [(r["portfolio_id"], r["position"], r["id"]) for r in records.collect()] == [
        (7, 0, "b"),
        (7, 1, "c"),
    ]
    text = records.groupBy("portfolio_id").agg(
        encode_payload(
            F.sort_array(
                F.collect_list(F.struct("accountName", "accountType", "currentBalance", "id"))
            )
        ).alias("payload")
    )
    encoded = json.loads(text.first()["payload"])
    assert [list(r) for r in encoded] == [sorted(r) for r in encoded]
    assert encoded[0] == record("b", 1.5)


def test_keys_are_sorted_in_whatever_order_fields_stand(spark):
    df = spark.sql(
        "SELECT array(named_struct('id', 'b', 'zeta', named_struct('y', 1, 'x', CAST(NULL AS INT)), "
        "'tags', map('q', 2, 'p', 1), 'accountName', 'n'), NULL) AS accounts, 1 AS k "
        "UNION ALL SELECT NULL, 2")
    texts = {r["k"]: r["payload"] for r in df.select(
        "k", encode_payload(F.col("accounts"), df.schema["accounts"].dataType).alias("payload")).collect()}
    assert texts[1] == json.dumps(
        [{"accountName": "n", "id": "b", "tags": {"p": 1, "q": 2}, "zeta": {"x": None, "y": 1}}, None],
        sort_keys=True, separators=(",", ":"))
    assert texts[2] is None
