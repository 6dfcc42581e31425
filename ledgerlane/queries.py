"""Registered queries: every model and operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.config import DEFAULT_ACCOUNTS, DEFAULT_RULES, ModelConfig
from ledgerlane.functions.clock import instant, is_weekday, reading_order, time_of_day, whole_days_between
from ledgerlane.functions.money import MONEY, decimals_to_double, money
from ledgerlane.operators.asof import as_of
from ledgerlane.operators.descent import latest_by_descent
from ledgerlane.operators.latest import latest_row, morning_readings, wide_balances
from ledgerlane.operators.rules import corrected_balance
from ledgerlane.operators.spine import calendar, trading_days
from ledgerlane.plans.distribution import asset_distribution, asset_totals, stock_distribution
from ledgerlane.plans.gains import gains_losses
from ledgerlane.plans.load import run_load
from ledgerlane.plans.networth import networth, networth_comparison
from ledgerlane.plans.run import Staging, run_models, run_summary
from ledgerlane.plans.upkeep import Upkeep
from ledgerlane.schemas import PORTFOLIO
from ledgerlane.sources import driver_tables as given
from ledgerlane.sources.landing import (
    land_file,
    landed_glob,
    landed_name,
    landed_summary,
    latest_landed,
    read_landed,
    remove_landed,
    write_landed,
)
from ledgerlane.sources.payload import (
    account_readings,
    account_snapshot,
    capture_columns,
    encode_payload,
    payload_records,
    payload_snapshot,
    read_payload_files,
    stopped_at_failures,
)
from ledgerlane.sources.versions import DatedTable
from ledgerlane.sources.warehouse import append_snapshots, import_columns, read_table
from ledgerlane.sources.workspace import new_run_folder
from ledgerlane.streaming.incremental import landed_stream, load_new_files
from ledgerlane.streaming.last_wins import load_last_reports

Query = Callable[[SparkSession, str], DataFrame]

EVENT_CONFIG = ModelConfig()
ALL_EVENTS = replace(EVENT_CONFIG, keys=())
SHORT_AGES = ModelConfig(ages={"one_day_ago": 1, "seven_days_ago": 7, "twenty_days_ago": 20})
RUN_TIME = datetime(2024, 1, 31, 12, 45)


# Gains and losses


def q_gains_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = gains_losses(
        given.event_account_data(spark, sf_dir), given.event_dates(spark, sf_dir), EVENT_CONFIG
    )
    return decimals_to_double(result)


def q_gains_losses_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = gains_losses(
        given.event_account_data(spark, sf_dir), given.event_dates(spark, sf_dir), ALL_EVENTS
    )
    return decimals_to_double(result)


def q_gains_losses_straddling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates that run half a day ahead of the capture times: weekdays are those of the times."""
    readings = given.event_account_data(spark, sf_dir)
    ahead = F.to_date(F.col("datetime_now") + F.expr("INTERVAL '12' HOUR"))
    result = gains_losses(
        readings.withColumn("date_now", ahead), given.event_dates(spark, sf_dir), EVENT_CONFIG
    )
    return decimals_to_double(result)


KEPT_CONFIG = replace(SHORT_AGES, networth_expr="investment")


def _kept(spark: SparkSession, sf_dir: str, config: ModelConfig, model: str) -> DataFrame:
    """A model after two loads of events: days from 20 January on, then all days before and one in eight of any day."""
    folder = new_run_folder(spark, "kept")
    wide = given.typed_event_data(spark, sf_dir)
    schema = wide.schema
    history = DatedTable(f"{folder}/history")
    late, early = F.col("primary_key") % 8 == 0, F.col("date_now") < F.lit("2024-01-20").cast("date")
    nothing = wide.select(*given.NETWORTH_COLUMNS).limit(0).withColumnRenamed("investment", "networth")
    for number, part in enumerate((~late & ~early, late | early)):
        entries = history.entries(spark)
        history.publish(spark, entries, history.write(wide.filter(part)), [f"load-{number}"])
        keeper = Upkeep(
            spark, history, schema, nothing, given.event_dates(spark, sf_dir), config, f"{folder}/models"
        )
        found = keeper.run([model])[model]
    return found


def q_gains_losses_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_to_double(_kept(spark, sf_dir, KEPT_CONFIG, "gains_losses"))


def q_networth_comparison_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same loads; invested is what purchases brought."""
    config = replace(
        KEPT_CONFIG, investment_expr="CASE WHEN event_type = 'purchase' THEN investment ELSE 0 END"
    )
    return decimals_to_double(_kept(spark, sf_dir, config, "networth_comparison"))


def q_morning_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = morning_readings(
        given.event_account_data(spark, sf_dir), "investment", EVENT_CONFIG.cutoff, [PORTFOLIO]
    )
    return decimals_to_double(readings)


def q_date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trading_days(given.event_dates(spark, sf_dir))


def q_reading_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time functions on every event."""
    ts = F.col("ts")
    return given.table(spark, sf_dir, "events").select(
        "event_id",
        is_weekday(F.to_date(ts)).alias("on_weekday"),
        F.weekday(ts).alias("days_after_monday"),
        F.date_sub(F.to_date(ts), 1).alias("day_before"),
        F.extract(F.lit("HOUR"), time_of_day(ts)).cast("bigint").alias("hours_since_midnight"),
        whole_days_between(instant(RUN_TIME), ts).cast("bigint").alias("whole_days_old"),
    )


# Net worth


def _order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return networth(*given.order_networth(spark, sf_dir), given.ORDER_CONFIG)


def q_networth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_to_double(_order_series(spark, sf_dir))


def q_networth_pre_investment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An expression over the historical rows, too."""
    config = replace(given.ORDER_CONFIG, pre_investment_expr="networth * 0.25")
    return decimals_to_double(networth(*given.order_networth(spark, sf_dir), config))


def _compared(series: DataFrame, config: ModelConfig) -> DataFrame:
    folder = new_run_folder(series.sparkSession, "networth-daily")
    return decimals_to_double(networth_comparison(series, config, folder))


def q_networth_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(_order_series(spark, sf_dir), given.ORDER_CONFIG)


def q_networth_comparison_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(_order_series(spark, sf_dir), replace(given.ORDER_CONFIG, keys=()))


def q_networth_comparison_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other ages, on readings spread over the day."""
    return _compared(given.event_networth(spark, sf_dir), SHORT_AGES)


def q_networth_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's net worth as it was when each of their items was shipped."""
    orders = given.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias(PORTFOLIO))
    shipped = given.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_shipdate").alias("instant")
    ).join(orders, "o_orderkey")
    found = as_of(_order_series(spark, sf_dir), shipped, [PORTFOLIO], ["networth", "investment_amount"])
    return decimals_to_double(found)


def q_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_row(given.event_account_data(spark, sf_dir), [PORTFOLIO])
    return decimals_to_double(newest)


def _dated_history(spark: SparkSession, snapshots: DataFrame) -> DataFrame:
    path = new_run_folder(spark, "history")
    append_snapshots(snapshots, path)
    return read_table(spark, path, snapshots.schema)


def q_latest_snapshot_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a dated history, newest dates first, until every portfolio is found."""
    history = _dated_history(spark, given.event_account_data(spark, sf_dir))
    users = given.table(spark, sf_dir, "events").select(F.col("user_id").alias(PORTFOLIO))
    newest = latest_by_descent(history, users, RUN_TIME.date(), new_run_folder(spark, "descent"))
    return decimals_to_double(newest)


# Distributions


def q_stock_distribution_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default thirteen accounts, each portfolio's latest snapshot row found by descent."""
    history = _dated_history(spark, given.event_snapshots(spark, sf_dir))
    held = given.held_weights(spark, sf_dir, DEFAULT_ACCOUNTS)
    latest = latest_by_descent(history, held, RUN_TIME.date(), new_run_folder(spark, "descent"))
    return decimals_to_double(stock_distribution(held, latest, EVENT_CONFIG))


def _single_stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = wide_balances(
        given.event_balances(spark, sf_dir),
        [],
        "account",
        F.col("balance"),
        F.col("reading_order"),
        {a: a for a in given.EVENT_ACCOUNTS},
    )
    return stock_distribution(given.part_weights(spark, sf_dir), latest, given.SINGLE_CONFIG)


def _held_stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = wide_balances(
        given.order_balances(spark, sf_dir),
        [PORTFOLIO],
        "account",
        F.col("balance"),
        F.col("reading_order"),
        given.ORDER_ACCOUNTS,
    )
    return stock_distribution(given.held_weights(spark, sf_dir), latest, given.HELD_CONFIG)


def _single_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = given.part_class_split(spark, sf_dir)
    return asset_distribution(_single_stocks(spark, sf_dir), split, given.SINGLE_CONFIG)


def _held_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = given.part_class_split(spark, sf_dir)
    return asset_distribution(_held_stocks(spark, sf_dir), split, given.HELD_CONFIG)


def q_stock_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_to_double(_single_stocks(spark, sf_dir))


def q_asset_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_to_double(_single_assets(spark, sf_dir))


def q_asset_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_to_double(asset_totals(_single_assets(spark, sf_dir), given.SINGLE_CONFIG))


def q_stock_distribution_by_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_to_double(_held_stocks(spark, sf_dir))


def q_asset_distribution_by_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_to_double(_held_assets(spark, sf_dir))


def q_asset_totals_by_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_to_double(asset_totals(_held_assets(spark, sf_dir), given.HELD_CONFIG))


# Payloads and snapshots


def q_payload_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k BIGINT", {"mode": "FAILFAST"})
    return given.table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = given.event_payload_accounts(spark, sf_dir)
    payload = encode_payload(F.col("accounts"), accounts.schema["accounts"].dataType)
    return accounts.select(PORTFOLIO, "primary_key", "datetime_now", payload.alias("payload"))


def q_payload_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files: each day's newest payload, written as a file of its own and read back from there.

    The day of the month stands for the portfolio.
    """
    folder = new_run_folder(spark, "payloads")
    order = reading_order(F.col("datetime_now"), F.col("primary_key"))
    day = F.dayofmonth("datetime_now").cast("bigint").alias(PORTFOLIO)
    newest = _payloads(spark, sf_dir).groupBy(day).agg(F.max_by("payload", order).alias("payload"))
    newest.write.partitionBy(PORTFOLIO).text(folder)
    files = read_payload_files(spark, folder).withColumn(PORTFOLIO, F.col(PORTFOLIO).cast("bigint"))
    wide = payload_snapshot(files, given.PAYLOAD_ACCOUNTS)
    return decimals_to_double(stopped_at_failures(wide))


def q_payload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_records(_payloads(spark, sf_dir)).select(
        "primary_key", "position", "id", "accountType", "accountName", "currentBalance"
    )


def q_payload_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = payload_snapshot(_payloads(spark, sf_dir), given.PAYLOAD_ACCOUNTS)
    return decimals_to_double(stopped_at_failures(wide))


def q_account_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    account_map = given.event_account_map(spark, sf_dir)
    return decimals_to_double(account_readings(_payloads(spark, sf_dir), account_map))


def q_account_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = account_snapshot(
        given.event_records(spark, sf_dir),
        {a: a for a in given.EVENT_ACCOUNTS},
        given.EVENT_RULES,
        keys=[PORTFOLIO],
    )
    missing = F.array_join("missing", ",").alias("missing")
    captured = wide.select(
        PORTFOLIO, *capture_columns(RUN_TIME), *given.EVENT_ACCOUNTS, missing
    )
    return decimals_to_double(captured)


def q_balance_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shipped rules; small values become zero so that each rule fires."""
    event = F.col("event_type")
    name = (
        F.when(event == "click", "BTC").when(event == "error", "ETH").when(event == "view", "USDC")
    )
    records = given.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("user_id") % 3 == 0, "credit").otherwise("bank").alias("accountType"),
        name.otherwise("Savings").alias("accountName"),
        money((F.floor(F.col("value") / 10) - 1) * 100).alias("currentBalance"),
    )
    balance = corrected_balance(
        DEFAULT_RULES, F.col("currentBalance"), F.col("accountType"), F.col("accountName")
    )
    return records.select("event_id", balance.cast("double").alias("balance"))


# Landing and loading

LANDED = T.StructType(
    [
        T.StructField(PORTFOLIO, T.LongType()),
        T.StructField("primary_key", T.LongType()),
        T.StructField("datetime_now", T.TimestampNTZType()),
        T.StructField("date_now", T.DateType()),
        T.StructField("investment", MONEY),
    ]
)


def q_landed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.table(spark, sf_dir, "events").select(
        "event_id", landed_name(F.col("ts")).alias("file_name")
    )


def q_landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_run_folder(spark, "landing")
    write_landed(given.event_account_data(spark, sf_dir), root, RUN_TIME)
    return decimals_to_double(read_landed(spark, landed_glob(root), LANDED))


def q_landing_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header order differs from table order: fields are bound by position."""
    table = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("datetime_now", T.TimestampNTZType()),
            T.StructField("checking", MONEY),
            T.StructField("savings", MONEY),
        ]
    )
    root = new_run_folder(spark, "landing")
    landed = given.table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("datetime_now"),
        money(F.col("value")).alias("savings"),
        money(F.col("value") * 2).alias("checking"),
    )
    write_landed(landed, root, RUN_TIME)
    return decimals_to_double(read_landed(spark, landed_glob(root), table, by_position=True))


def q_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings, a load after each, and one more load that finds nothing."""
    root = new_run_folder(spark, "landing")
    history, checkpoint = f"{root}/history", f"{root}/checkpoint"
    snapshots = given.event_account_data(spark, sf_dir)
    later = F.col("datetime_now") >= F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'")

    def load() -> None:
        load_new_files(landed_stream(spark, root, LANDED), history, checkpoint)

    write_landed(snapshots.filter(~later), root, RUN_TIME)
    load()
    write_landed(snapshots.filter(later), root, RUN_TIME + timedelta(minutes=30))
    load()
    load()
    return decimals_to_double(read_table(spark, history, LANDED))


REPORTED = T.StructType(
    [*LANDED.fields, T.StructField("reported", T.IntegerType())]
)


def q_last_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings by a stream: every third is reported again in a second batch, every seventh in a third.

    The stream stops after each batch and is started anew for the next one.
    """
    root = new_run_folder(spark, "reports")
    first = given.event_account_data(spark, sf_dir)
    table = DatedTable(f"{root}/readings")
    for number, every in enumerate((1, 3, 7)):
        batch = first.filter(F.col("primary_key") % every == 0).select(
            PORTFOLIO, "primary_key", "datetime_now", "date_now",
            (F.col("investment") * (number + 1)).cast(MONEY).alias("investment"),
            F.lit(number).alias("reported"),
        )
        batch.write.mode("append").parquet(f"{root}/reports")
        stream = spark.readStream.schema(REPORTED).parquet(f"{root}/reports")
        load_last_reports(
            stream, "reported", table, f"{root}/checkpoint", (PORTFOLIO, "primary_key", "datetime_now"), "60 days"
        )
    return decimals_to_double(table.read(spark, REPORTED))


def q_landed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run landed as one file of the fixed name, found by name and read back."""
    root = new_run_folder(spark, "landing")
    land_file(given.event_account_data(spark, sf_dir), root, RUN_TIME)
    landed = read_landed(spark, latest_landed(spark, root), LANDED)
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    return decimals_to_double(landed.withColumn("file_name", name))


def q_landed_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the landing folder holds, per landed file name."""
    root = new_run_folder(spark, "landing")
    snapshots = given.event_account_data(spark, sf_dir)
    later = F.col("datetime_now") >= F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'")
    write_landed(snapshots.filter(~later), root, RUN_TIME)
    write_landed(snapshots.filter(later), root, RUN_TIME + timedelta(minutes=30))
    return landed_summary(read_landed(spark, landed_glob(root), LANDED))


def q_extract_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads all the way into the history table."""
    root = new_run_folder(spark, "load")
    payloads = _payloads(spark, sf_dir).drop("primary_key")
    history = run_load(spark, payloads, given.PAYLOAD_ACCOUNTS, root, RUN_TIME)
    return decimals_to_double(history)


def q_repeated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches of one second, two of them of one instant; all repeated, also after a cleanup."""
    root = new_run_folder(spark, "load")
    payloads = _payloads(spark, sf_dir)

    def run(part: int) -> DataFrame:
        batch = payloads.filter(F.col("primary_key") % 4 == part).drop("primary_key")
        moment = RUN_TIME + timedelta(milliseconds=500 * (part // 2))
        return run_load(spark, batch, given.PAYLOAD_ACCOUNTS, root, moment, name=f"part{part}")

    for part in range(4):
        run(part)
    run(0)
    remove_landed(spark, root)
    return decimals_to_double(run(3))


def q_history_schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs with two, three and one account: the history has all of them."""
    root = new_run_folder(spark, "load")
    payloads = _payloads(spark, sf_dir)
    maps = (("checking", "bitcoin"), ("checking", "bitcoin", "dollars"), ("dollars",))
    for part, names in enumerate(maps):
        batch = payloads.filter(F.col("primary_key") % 3 == part).drop("primary_key")
        columns = {n: given.PAYLOAD_ACCOUNTS[n] for n in names}
        history = run_load(spark, batch, columns, root, RUN_TIME + timedelta(minutes=30 * part))
    return decimals_to_double(history)


def q_extract_load_by_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads into the history, each portfolio by its own account ids."""
    root = new_run_folder(spark, "load")
    payloads = _payloads(spark, sf_dir).drop("primary_key")
    present = given.event_account_map(spark, sf_dir).filter("column_name <> 'lost'")
    columns = ["card", "dollars", "bitcoin"]
    history = run_load(spark, payloads, columns, root, RUN_TIME, account_map=present)
    return decimals_to_double(history)


def q_snapshot_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch append to the dated history, read back per date partition."""
    path = new_run_folder(spark, "history")
    snapshots = given.event_account_data(spark, sf_dir)
    append_snapshots(snapshots, path)
    history = read_table(spark, path, LANDED).select(*import_columns(snapshots))
    per_day = history.groupBy("date_now").agg(
        F.count("*").alias("readings"),
        F.sum("investment").alias("investment"),
        F.max("datetime_now").alias("last_reading"),
    )
    return decimals_to_double(per_day)


# The ordered run


def _order_staging(spark: SparkSession, sf_dir: str) -> Staging:
    """Orders as wide snapshots of three accounts, and what customers hold."""
    history, orders = given.order_networth(spark, sf_dir)

    def amount(status: str) -> Column:
        return money(F.when(F.col("o_orderstatus") == status, F.col("networth")).otherwise(0))

    span = orders.agg(F.min("date_now"), F.max("date_now"))
    return Staging(
        account_data=orders.select(
            PORTFOLIO,
            "primary_key",
            "datetime_now",
            "date_now",
            *[amount(status).alias(name) for name, status in given.ORDER_ACCOUNTS.items()],
        ),
        networth_historical=history,
        investment_distribution=given.held_weights(spark, sf_dir),
        assett_class_split=given.part_class_split(spark, sf_dir),
        dates=calendar(span),
    )


def q_model_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All models over orders, lineitem and part: rows and total per column."""
    config = replace(
        given.HELD_CONFIG,
        networth_expr=" + ".join(given.ORDER_ACCOUNTS),
        investment_expr="filled + opened",
    )
    folder = new_run_folder(spark, "models")
    return run_summary(run_models(spark, _order_staging(spark, sf_dir), config, folder))


QUERIES: dict[str, Query] = {
    "gains_losses": q_gains_losses,
    "gains_losses_global": q_gains_losses_global,
    "gains_losses_straddling": q_gains_losses_straddling,
    "gains_losses_kept": q_gains_losses_kept,
    "networth": q_networth,
    "networth_pre_investment": q_networth_pre_investment,
    "networth_comparison": q_networth_comparison,
    "networth_comparison_global": q_networth_comparison_global,
    "networth_comparison_ages": q_networth_comparison_ages,
    "networth_as_of": q_networth_as_of,
    "networth_comparison_kept": q_networth_comparison_kept,
    "stock_distribution": q_stock_distribution,
    "asset_distribution": q_asset_distribution,
    "asset_totals": q_asset_totals,
    "stock_distribution_by_portfolio": q_stock_distribution_by_portfolio,
    "stock_distribution_latest": q_stock_distribution_latest,
    "asset_distribution_by_portfolio": q_asset_distribution_by_portfolio,
    "asset_totals_by_portfolio": q_asset_totals_by_portfolio,
    "account_snapshot": q_account_snapshot,
    "account_readings": q_account_readings,
    "balance_rules": q_balance_rules,
    "latest_snapshot": q_latest_snapshot,
    "latest_snapshot_descent": q_latest_snapshot_descent,
    "morning_readings": q_morning_readings,
    "date_spine": q_date_spine,
    "reading_times": q_reading_times,
    "payload_parse": q_payload_parse,
    "payload_records": q_payload_records,
    "payload_snapshot": q_payload_snapshot,
    "payload_files": q_payload_files,
    "landed_names": q_landed_names,
    "landing_roundtrip": q_landing_roundtrip,
    "landing_by_position": q_landing_by_position,
    "incremental_load": q_incremental_load,
    "landed_discovery": q_landed_discovery,
    "landed_file": q_landed_file,
    "last_reports": q_last_reports,
    "extract_load": q_extract_load,
    "repeated_load": q_repeated_load,
    "history_schema_change": q_history_schema_change,
    "extract_load_by_map": q_extract_load_by_map,
    "snapshot_append": q_snapshot_append,
    "model_run": q_model_run,
}
