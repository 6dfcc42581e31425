"""Landing, incremental loading, table writes and the ordered run."""

from __future__ import annotations

import json
from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgerlane.config import ModelConfig, weighted_spreads
from ledgerlane.operators.checks import LoadError, require_unique
from ledgerlane.plans.load import run_load
from ledgerlane.plans.run import Staging, check_staging, run_models
from ledgerlane.schemas import (
    ACCOUNT_MAP,
    ASSETT_CLASS_SPLIT,
    NETWORTH_HISTORICAL,
    investment_distribution_schema,
    snapshot_schema,
)
from ledgerlane.sources import workspace
from ledgerlane.sources.landing import (
    is_landed,
    land_run,
    landed_folder,
    landed_glob,
    latest_landed,
    read_landed,
    remove_landed,
    run_identity,
    write_landed,
)
from ledgerlane.sources.warehouse import (
    append_snapshots,
    import_columns,
    put_runs,
    read_history,
    read_table,
    with_surrogate,
)
from ledgerlane.streaming.incremental import landed_stream, load_landed_runs, load_new_files
from tests.rows import at, calendar, day, dec

SCHEMA = snapshot_schema(["broker", "coins"])


def batch(spark, *stamps, portfolio=1):
    return spark.createDataFrame(
        [(portfolio, at(s), at(s).date(), dec("1.50"), dec("-2.25")) for s in stamps], SCHEMA
    )


@pytest.fixture
def root(spark):
    return workspace.new_run_folder(spark, "landing")


def test_round_trip_keeps_microseconds_and_nulls(spark, root):
    nothing = F.lit(None).cast("decimal(18,2)")
    df = batch(spark, "2024-01-01 10:00:00.000001").withColumn("coins", nothing)
    write_landed(df, root, at("2024-01-01 10:00:00"))
    back = read_landed(spark, landed_glob(root), SCHEMA)
    assert back.collect() == df.collect()


def test_wrong_header_is_rejected_unless_bound_by_position(spark, root):
    df = batch(spark, "2024-01-01 10:00:00")
    swapped = df.select("portfolio_id", "datetime_now", "date_now", "coins", "broker")
    write_landed(swapped, root, at("2024-01-01 10:00:00"))
    with pytest.raises(Exception, match="(?i)header"):
        read_landed(spark, landed_glob(root), SCHEMA).collect()
    (row,) = read_landed(spark, landed_glob(root), SCHEMA, by_position=True).collect()
    assert (row["broker"], row["coins"]) == (dec("-2.25"), dec("1.50"))


def test_find_and_remove_landed_files(spark, root):
    for stamp in ("2024-01-01 10:15:00", "2024-02-01 10:45:00"):
        write_landed(batch(spark, stamp), root, at(stamp))
    assert "mint_02_01_2024_10-45-00.csv" in latest_landed(spark, root)
    assert remove_landed(spark, root) == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        latest_landed(spark, root)


def test_rerun_adds_nothing(spark, root):
    table, checkpoint = f"{root}/history", f"{root}/checkpoint"

    def load():
        load_new_files(landed_stream(spark, root, SCHEMA, max_files=1), table, checkpoint)
        return read_table(spark, table).count()

    write_landed(batch(spark, "2024-01-01 10:15:00"), root, at("2024-01-01 10:15:00"))
    assert (load(), load()) == (1, 1)
    write_landed(batch(spark, "2024-01-02 10:15:00"), root, at("2024-01-02 10:15:00"))
    assert (load(), load()) == (2, 2)
    history = read_table(spark, table)
    assert {r["primary_key"] for r in history.collect()} == {
        1704104100000000,
        1704190500000000,
    }


def test_loaded_files_can_be_archived(spark, root, tmp_path):
    table, checkpoint = f"{root}/history", f"{root}/checkpoint"
    for number in (1, 2, 3):
        stamp = f"2024-01-0{number} 10:15:00"
        write_landed(batch(spark, stamp), root, at(stamp))
        stream = landed_stream(spark, root, SCHEMA, clean="archive", archive=str(tmp_path / "old"))
        load_new_files(stream, table, checkpoint)
    assert read_table(spark, table).count() == 3
    assert list((tmp_path / "old").rglob("*.csv"))


def test_stream_rejects_a_wrong_header(spark, root):
    df = batch(spark, "2024-01-01 10:00:00").withColumnRenamed("coins", "other")
    write_landed(df, root, at("2024-01-01 10:00:00"))
    with pytest.raises(StreamingQueryException):
        load_new_files(landed_stream(spark, root, SCHEMA), f"{root}/t", f"{root}/c")


def test_append_is_partitioned_and_checked(spark, root):
    path = f"{root}/history"
    append_snapshots(batch(spark, "2024-01-01 10:00:00", "2024-01-02 10:00:00"), path)
    append_snapshots(batch(spark, "2024-01-02 11:00:00"), path)
    one_day = read_table(spark, path).filter(F.col("date_now") == day("2024-01-02"))
    assert one_day.count() == 2
    assert "PartitionFilters: [isnotnull(date_now" in one_day._jdf.queryExecution().toString()
    with pytest.raises(Exception, match="null in required column datetime_now"):
        nulls = batch(spark, "2024-01-01 10:00:00").withColumn(
            "datetime_now", F.lit(None).cast("timestamp_ntz")
        )
        append_snapshots(nulls, path)
    assert read_table(spark, path).count() == 3


def test_import_columns_leave_out_the_surrogate(spark):
    df = batch(spark, "2024-01-01 10:00:00")
    assert import_columns(with_surrogate(df)) == df.columns


def test_unique_check(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    with pytest.raises(LoadError, match="duplicate k"):
        require_unique(df, ["k"])
    require_unique(df.distinct(), ["k"])


def test_shared_folder_is_read_from_the_session(spark, monkeypatch):
    assert workspace.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_run_folder(spark, "a") != workspace.new_run_folder(spark, "a")


def test_ordered_run(spark, root):
    accounts = ["broker", "coins"]
    staging = Staging(
        account_data=with_surrogate(
            batch(spark, "2024-01-01 10:00:00", "2024-01-02 10:00:00").unionByName(
                batch(spark, "2024-01-01 09:00:00", portfolio=2)
            )
        ),
        networth_historical=spark.createDataFrame(
            [(1, 1, at("2023-11-01 10:00:00"), day("2023-11-01"), dec("7.00"))], NETWORTH_HISTORICAL
        ),
        investment_distribution=spark.createDataFrame(
            [(1, "A", dec("0.5"), dec("2")), (2, "B", dec("1"), dec("0"))],
            investment_distribution_schema(accounts),
        ),
        assett_class_split=spark.createDataFrame(
            [("A", dec("1"), dec("0"), dec("0"), dec("0"), dec("0"))], ASSETT_CLASS_SPLIT
        ),
        dates=calendar(spark, "2024-01-01", "2024-01-05"),
    )
    config = ModelConfig(
        networth_expr="broker + coins",
        investment_expr="broker",
        spread_exprs=weighted_spreads(accounts),
    )
    models = run_models(spark, staging, config, root, view_prefix="test_")
    assert list(models) == [
        "networth",
        "networth_comparison",
        "gains_losses",
        "stock_distribution",
        "asset_distribution",
        "asset_totals",
    ]
    assert models["networth"].count() == 4
    compared = {r["portfolio_id"]: r for r in models["networth_comparison"].collect()}
    assert compared[1]["networth_now"] == dec("-0.75")
    assert compared[1]["networth_sixty_days_ago"] == 7
    assert compared[2]["networth_sixty_days_ago"] is None
    assert models["gains_losses"].count() == 10
    assert spark.table("test_asset_totals").filter("amount is not null").count() == 5
    totals = {(r[0], r[1]): r[2] for r in models["asset_totals"].collect()}
    assert totals[1, "us_stock"] == dec("-3.75")  # 0.5 * 1.50 + 2 * -2.25

    with pytest.raises(LoadError, match="duplicate date_value"):
        twice = staging.dates.unionByName(staging.dates)
        run_models(spark, Staging(**{**staging.__dict__, "dates": twice}), config, root)


def test_stream_stops_at_a_missing_capture_time(spark, root):
    df = batch(spark, "2024-01-01 10:00:00").withColumn(
        "datetime_now", F.lit(None).cast("timestamp_ntz")
    )
    write_landed(df, root, at("2024-01-01 10:00:00"))
    with pytest.raises(StreamingQueryException):
        load_new_files(landed_stream(spark, root, SCHEMA), f"{root}/t", f"{root}/c")


def test_load_runs_follow_each_other(spark, root):
    def payload(balance):
        accounts = [
            {"id": "b", "accountType": "bank", "accountName": "x", "currentBalance": balance},
            {"id": "c", "accountType": "credit", "accountName": "y", "currentBalance": 5},
        ]
        return spark.createDataFrame(
            [(1, json.dumps(accounts)), (2, json.dumps(accounts))],
            "portfolio_id bigint, payload string",
        )

    columns = {"broker": "b", "coins": "c"}
    first, second = at("2024-01-01 10:15:00"), at("2024-01-01 10:45:00")
    assert run_load(spark, payload(10), columns, root, first).count() == 2
    with pytest.raises(LoadError):
        run_load(spark, payload(None), columns, root, at("2024-01-01 10:30:00"))
    assert run_load(spark, payload(10), columns, root, first).count() == 2
    history = run_load(spark, payload(20), columns, root, second)
    loaded = history.select("portfolio_id", "datetime_now", "broker", "coins").collect()
    rows = sorted(tuple(r) for r in loaded)
    assert rows == [(p, ts, b, -5) for p in (1, 2) for ts, b in ((first, 10), (second, 20))]


def test_an_old_file_is_loaded_after_newer_ones(spark, root):
    import os
    from pathlib import Path

    table, checkpoint = f"{root}/t", f"{root}/c"
    new, old = "2024-01-11 10:00:00", "2024-01-12 10:00:00"
    write_landed(batch(spark, new), root, at(new))
    load_new_files(landed_stream(spark, root, SCHEMA), table, checkpoint)
    write_landed(batch(spark, old), root, at(old))
    for file in Path(root).rglob("*m*/**/*.csv"):
        if "12" in str(file.parent):
            os.utime(file, (1_000_000_000, 1_000_000_000))
    load_new_files(landed_stream(spark, root, SCHEMA), table, checkpoint)
    assert spark.read.parquet(table).count() == 2


def account(account_id, balance, kind="bank"):
    return {"id": account_id, "accountType": kind, "accountName": "x", "currentBalance": balance}


def paid(spark, *rows):
    """Payload rows of (portfolio, {account id: balance})."""
    texts = [(p, json.dumps([account(i, b) for i, b in accounts.items()])) for p, accounts in rows]
    return spark.createDataFrame(texts, "portfolio_id bigint, payload string")


RUN = at("2024-01-01 10:15:00")
ONE = {"broker": "b"}


def loaded(history, *columns):
    return sorted(tuple(r) for r in history.select("portfolio_id", *columns).collect())


def test_runs_of_one_second_and_of_one_instant_all_load(spark, root):
    run_load(spark, paid(spark, (1, {"b": 1})), ONE, root, RUN)
    run_load(spark, paid(spark, (2, {"b": 2})), ONE, root, RUN + timedelta(milliseconds=500))
    history = run_load(spark, paid(spark, (3, {"b": 3})), ONE, root, RUN, name="shard-2")
    assert loaded(history, "broker") == [(1, 1), (2, 2), (3, 3)]
    with pytest.raises(ValueError, match="run name"):
        run_load(spark, paid(spark, (4, {"b": 4})), ONE, root, RUN, name="a/b")


def test_what_an_unpublished_attempt_left_is_never_loaded(spark, root):
    left = f"{landed_folder(root, RUN)}/{run_identity(RUN)}.lost"
    half = spark.createDataFrame([(9, RUN, RUN.date(), dec("9"))], snapshot_schema(ONE))
    half.write.option("header", True).csv(left)
    other = run_load(spark, paid(spark, (2, {"b": 2})), ONE, root, RUN + timedelta(minutes=30))
    assert loaded(other, "broker") == [(2, 2)]
    assert not is_landed(spark, root, RUN)
    history = run_load(spark, paid(spark, (1, {"b": 1})), ONE, root, RUN)
    assert loaded(history, "broker") == [(1, 1), (2, 2)]


def test_a_run_repeated_after_the_cleanup_adds_nothing(spark, root):
    batch = paid(spark, (1, {"b": 1}))
    run_load(spark, batch, ONE, root, RUN)
    assert remove_landed(spark, root) == 1
    assert loaded(run_load(spark, batch, ONE, root, RUN), "broker") == [(1, 1)]


def test_two_published_attempts_and_replayed_batches_count_once(spark, root):
    batch = spark.createDataFrame([(1, RUN, RUN.date(), dec("1"))], snapshot_schema(ONE))
    land_run(batch, root, RUN, list(ONE))
    land_run(batch, root, RUN, list(ONE))
    load_landed_runs(spark, root)
    assert loaded(read_history(spark, root), "broker") == [(1, 1)]
    put_runs(batch.withColumn("run_id", F.lit(run_identity(RUN))), f"{root}/history")
    assert loaded(read_history(spark, root), "broker") == [(1, 1)]


def test_a_folder_is_never_written_twice(spark, root):
    write_landed(batch(spark, "2024-01-01 10:15:00"), root, RUN)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_landed(batch(spark, "2024-01-01 10:15:00", portfolio=2), root, RUN)


def test_history_keeps_all_accounts_of_all_runs(spark, root):
    both = {"broker": "b", "card": "c"}
    run_load(spark, paid(spark, (1, {"b": 1})), ONE, root, RUN)
    run_load(spark, paid(spark, (1, {"b": 2, "c": 3})), both, root, RUN + timedelta(hours=1))
    later = RUN + timedelta(hours=2)
    history = run_load(spark, paid(spark, (1, {"c": 4})), {"card": "c"}, root, later)
    assert history.columns[3:] == ["primary_key", "broker", "card"]
    rows = history.orderBy("datetime_now").select("broker", "card").collect()
    assert [tuple(r) for r in rows] == [(1, None), (2, 3), (None, 4)]


def test_two_payloads_of_one_instant_stop_the_load(spark, root):
    with pytest.raises(LoadError, match="duplicate portfolio_id, datetime_now"):
        run_load(spark, paid(spark, (1, {"b": 1}), (1, {"b": 2})), ONE, root, RUN)
    assert not is_landed(spark, root, RUN)


def test_load_by_the_portfolios_own_ids(spark, root):
    entries = [(1, 1, "broker", "b"), (1, 2, "card", "c"), (2, 1, "broker", "z")]
    own = spark.createDataFrame(entries, ACCOUNT_MAP)
    columns = ["broker", "card"]

    def load(rows, account_map=own, minutes=0):
        moment = RUN + timedelta(minutes=minutes)
        return run_load(spark, paid(spark, *rows), columns, root, moment, account_map=account_map)

    history = load([(1, {"b": 1, "c": 2, "z": 9}), (2, {"z": 3, "c": 9})])
    assert loaded(history, *columns) == [(1, 1, 2), (2, 3, None)]
    with pytest.raises(LoadError, match="portfolio 2, accounts z"):
        load([(1, {"b": 1, "c": 2}), (2, {"b": 3})], minutes=1)
    with pytest.raises(LoadError, match="portfolio 1, accounts c"):
        load([(1, {"b": 1, "c": None})], minutes=2)
    with pytest.raises(LoadError, match="nothing in the account map of portfolio 7"):
        load([(7, {"b": 1})], minutes=3)
    stray = own.unionByName(spark.createDataFrame([(2, 2, "cash", "q")], ACCOUNT_MAP))
    with pytest.raises(LoadError, match="cash in the account map of portfolio 2"):
        load([(2, {"z": 1})], stray, minutes=4)
    twice = own.unionByName(spark.createDataFrame([(2, 2, "broker", "q")], ACCOUNT_MAP))
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        load([(2, {"z": 1})], twice, minutes=5)
    assert loaded(read_history(spark, root), *columns) == [(1, 1, 2), (2, 3, None)]


def test_a_quiet_date_gets_one_file(spark, root):
    from pathlib import Path

    rows = spark.range(10_000).selectExpr(
        "id % 100 AS portfolio_id",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(CAST(id % 30 AS INT), 0, 0, id / 100) "
        "AS datetime_now",
        "CAST(1 AS DECIMAL(18,2)) AS broker",
    )
    dated = rows.withColumn("date_now", F.to_date("datetime_now")).repartition(8)
    put_runs(dated.withColumn("run_id", F.lit("r")), f"{root}/history")
    assert len(list(Path(f"{root}/history").rglob("*.parquet"))) == 30


def test_equal_readings_stop_the_models(spark):
    rows = with_surrogate(batch(spark, "2024-01-01 10:00:00", "2024-01-01 10:00:00"))
    staging = Staging(rows, rows.limit(0), rows, rows, calendar(spark, "2024-01-01", "2024-01-02"))
    with pytest.raises(LoadError, match="duplicate portfolio_id, datetime_now, primary_key"):
        check_staging(staging, ModelConfig())


def test_an_instant_the_history_holds_stops_another_run(spark, root):
    run_load(spark, paid(spark, (1, {"b": 1}), (2, {"b": 2})), ONE, root, RUN)
    run_load(spark, paid(spark, (3, {"b": 3})), ONE, root, RUN, name="other")
    with pytest.raises(LoadError, match="duplicate portfolio_id, datetime_now.*'portfolio_id': 2"):
        run_load(spark, paid(spark, (2, {"b": 9}), (4, {"b": 4})), ONE, root, RUN, name="again")
    assert not is_landed(spark, root, RUN, "again")
    history = run_load(spark, paid(spark, (2, {"b": 9})), ONE, root, RUN + timedelta(microseconds=1))
    assert loaded(history, "broker") == [(1, 1), (2, 2), (2, 9), (3, 3)]


def test_history_stays_in_few_files_and_knows_its_runs(spark, root):
    from pathlib import Path

    from ledgerlane.sources.warehouse import compact_history, history_table

    def load(number):
        return run_load(spark, paid(spark, (1, {"b": number})), ONE, root, RUN + timedelta(minutes=number))

    for number in range(5):
        reader = load(number)
    compact_history(spark, root, day("2024-01-02"), packs_of_a_day=3)
    assert loaded(reader, "broker") == [(1, n) for n in range(5)]
    history_table(root).remove_unused(spark)
    assert len(list(Path(f"{root}/history").rglob("*.parquet"))) == 1
    assert len(history_table(root).entries(spark)) == 2
    assert loaded(load(3), "broker") == [(1, n) for n in range(5)]
    assert loaded(load(7), "broker") == [(1, n) for n in (0, 1, 2, 3, 4, 7)]


def staged(spark, rows, past=None):
    accounts = ["broker", "coins"]
    past = past or [(1, 1, at("2023-11-01 10:00:00"), day("2023-11-01"), dec("7.00"))]
    return Staging(
        rows, spark.createDataFrame(past, NETWORTH_HISTORICAL.simpleString()[7:-1].replace(":", " ")),
        spark.createDataFrame([(1, "A", dec("0.5"), dec("2"))], investment_distribution_schema(accounts)),
        spark.createDataFrame([("A", dec("1"), dec("0"), dec("0"), dec("0"), dec("0"))], ASSETT_CLASS_SPLIT),
        calendar(spark, "2024-01-01", "2024-01-05"),
    )


RUN_CONFIG = ModelConfig(
    networth_expr="broker + coins", investment_expr="broker", spread_exprs=weighted_spreads(["broker", "coins"]))


def test_models_name_bad_rows_without_a_pass_of_their_own(spark, root, monkeypatch):
    import ledgerlane.plans.run as run

    keys = []
    unique = run.require_unique
    monkeypatch.setattr(run, "require_unique", lambda df, of: (keys.append(of), unique(df, of)))
    good = with_surrogate(batch(spark, "2024-01-01 10:00:00", "2024-01-02 10:00:00"))
    run_models(spark, staged(spark, good), RUN_CONFIG, f"{root}/good")
    # Readings' own keys are not shuffled to be compared.
    assert keys == [["date_value"]]
    wrong_day = good.withColumn("date_now", F.expr("IF(primary_key % 2 = 0, date_now, date_add(date_now, 1))"))
    bad = wrong_day.unionByName(good.withColumn("date_now", F.date_add("date_now", 2)).limit(1))
    with pytest.raises(LoadError, match="date_now is not the day of datetime_now: .*2024, 1, 3"):
        run_models(spark, staged(spark, bad), RUN_CONFIG, f"{root}/bad")
    nulls = good.unionByName(good.withColumn("portfolio_id", F.lit(None).cast("bigint")).limit(1))
    with pytest.raises(LoadError, match="nulls in required columns: {'portfolio_id': None"):
        run_models(spark, staged(spark, nulls), RUN_CONFIG, f"{root}/nulls")
    past = [(1, 1, None, day("2023-11-01"), dec("7.00"))]
    with pytest.raises(LoadError, match="nulls in required columns: .*2023, 11, 1"):
        run_models(spark, staged(spark, good, past), RUN_CONFIG, f"{root}/past")
    run_models(spark, staged(spark, nulls, past), RUN_CONFIG, f"{root}/unchecked", check=False)


def test_models_find_latest_snapshots_from_the_run_day_back(spark, root):
    path = f"{root}/dated"
    append_snapshots(batch(spark, "2024-01-01 10:00:00", "2024-01-03 10:00:00"), path)
    history = read_table(spark, path, with_surrogate(batch(spark)).schema)
    plain = run_models(spark, staged(spark, history), RUN_CONFIG, f"{root}/plain")
    back = run_models(spark, staged(spark, history), RUN_CONFIG, f"{root}/back", newest=day("2024-01-03"))
    for name in ("stock_distribution", "asset_totals"):
        assert sorted(map(str, back[name].collect())) == sorted(map(str, plain[name].collect()))
