"""Staging tables derived from the given parquet tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.config import DEFAULT_ACCOUNTS, BalanceRule, ModelConfig, weighted_spreads
from ledgerlane.functions.clock import reading_order
from ledgerlane.functions.money import FRACTION, WEIGHT, money
from ledgerlane.operators.spine import calendar
from ledgerlane.schemas import CLASSES, PORTFOLIO

EVENT_ACCOUNTS = ("click", "error", "purchase", "signup", "view")
ORDER_ACCOUNTS = {"filled": "F", "opened": "O", "pending": "P"}

# Orders from this date on act as snapshots, earlier ones as history.
HISTORY_ENDS = "TIMESTAMP_NTZ'1998-01-01 00:00:00'"

# Thresholds chosen so that every rule fires on the given values.
EVENT_RULES = (
    BalanceRule(">", 0, account_type="credit"),
    BalanceRule("<", 50, account_name="click", value=2000),
    BalanceRule("<", 50, account_name="error", value=1600),
    BalanceRule("<", 100, account_name="view", value=17500),
)

# Accounts of the payloads built from events; "a9" is never in a payload's map.
PAYLOAD_ACCOUNTS = {"checking": "a1", "bitcoin": "a2", "dollars": "a3"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_account_data(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Events as snapshots with one amount, and more of their columns if named."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias(PORTFOLIO),
        F.col("event_id").alias("primary_key"),
        F.col("ts").alias("datetime_now"),
        F.to_date("ts").alias("date_now"),
        money(F.col("value")).alias("investment"),
        *more,
    )


def typed_event_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the type of each event; events without an id are left out."""
    return event_account_data(spark, sf_dir, "event_type").filter(F.col("primary_key").isNotNull())


NETWORTH_COLUMNS = (PORTFOLIO, "primary_key", "datetime_now", "date_now", "investment")


def event_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first to the last event."""
    events = table(spark, sf_dir, "events")
    return calendar(events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))))


def order_networth(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as net worth history and, from the turning date on, snapshots."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias(PORTFOLIO),
        F.col("o_orderkey").alias("primary_key"),
        F.col("o_orderdate").alias("datetime_now"),
        F.to_date("o_orderdate").alias("date_now"),
        money(F.col("o_totalprice")).alias("networth"),
        "o_orderstatus",
    )
    turning = F.col("datetime_now") < F.expr(HISTORY_ENDS)
    return rows.filter(turning).drop("o_orderstatus"), rows.filter(~turning)


ORDER_CONFIG = ModelConfig(
    pre_investment_expr="0",
    networth_expr="networth",
    investment_expr="CASE WHEN o_orderstatus = 'F' THEN networth ELSE 0 END",
)


def event_networth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a net worth series with sub-day timestamps."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias(PORTFOLIO),
        F.col("event_id").alias("primary_key"),
        F.col("ts").alias("datetime_stamp"),
        F.to_date("ts").alias("date_stamp"),
        money(F.col("value")).alias("networth"),
        money(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0)).alias(
            "investment_amount"
        ),
    )


def event_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as single account readings: portfolio, account, balance, order."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias(PORTFOLIO),
        F.col("event_type").alias("account"),
        money(F.col("value")).alias("balance"),
        reading_order(F.col("ts"), F.col("event_id")).alias("reading_order"),
    )


def order_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as single account readings; the status is the account."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias(PORTFOLIO),
        F.col("o_orderstatus").alias("account"),
        money(F.col("o_totalprice")).alias("balance"),
        reading_order(F.col("o_orderdate"), F.col("o_orderkey")).alias("reading_order"),
    )


def _weight(symbol: Column, number: int) -> Column:
    return (F.pmod(symbol * number, F.lit(7)) * F.lit(0.01)).cast(WEIGHT)


def part_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the securities of one portfolio, weighted over five accounts."""
    symbol = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        symbol.alias("stock_symbol"),
        *[_weight(symbol, i).alias(f"{a}_weight") for i, a in enumerate(EVENT_ACCOUNTS, 1)],
    )


def held_weights(
    spark: SparkSession, sf_dir: str, accounts: Iterable[str] = tuple(ORDER_ACCOUNTS)
) -> DataFrame:
    """The parts a customer has ordered as that portfolio's securities."""
    bought = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("o_custkey").alias(PORTFOLIO), F.col("l_partkey").alias("stock_symbol"))
        .distinct()
    )
    symbol = F.col("stock_symbol")
    return bought.select(
        PORTFOLIO,
        "stock_symbol",
        *[_weight(symbol, i).alias(f"{a}_weight") for i, a in enumerate(accounts, 1)],
    )


def event_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as wide snapshots of the default accounts; errors lack the last one's balance."""
    amounts = [
        money(F.col("value") * number).alias(account) for number, account in enumerate(DEFAULT_ACCOUNTS[:-1], 1)
    ]
    last = F.when(F.col("event_type") != "error", F.col("value") * len(DEFAULT_ACCOUNTS))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias(PORTFOLIO),
        F.col("event_id").alias("primary_key"),
        F.col("ts").alias("datetime_now"),
        F.to_date("ts").alias("date_now"),
        *amounts,
        money(last).alias(DEFAULT_ACCOUNTS[-1]),
    )


def part_class_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split of a part over the classes; the ECONOMY type has none."""
    fraction = [
        (F.pmod(F.col("p_size") * j, F.lit(11)) * F.lit(0.1)).cast(FRACTION).alias(c)
        for j, c in enumerate(CLASSES, 1)
    ]
    return (
        table(spark, sf_dir, "part")
        .filter(F.col("p_type") != "ECONOMY")
        .select(F.col("p_partkey").alias("stock_symbol"), *fraction)
    )


SINGLE_CONFIG = ModelConfig(keys=(), spread_exprs=weighted_spreads(EVENT_ACCOUNTS))
HELD_CONFIG = ModelConfig(spread_exprs=weighted_spreads(ORDER_ACCOUNTS))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as account records of their user, newest last."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias(PORTFOLIO),
        F.col("event_type").alias("id"),
        F.when(F.col("user_id") % 2 == 0, "credit").otherwise("bank").alias("accountType"),
        F.col("event_type").alias("accountName"),
        money(F.col("value")).alias("currentBalance"),
        reading_order(F.col("ts"), F.col("event_id")).alias("position"),
    )


def _record(account_id: str, name: str, kind: Column, balance: Column) -> Column:
    return F.struct(
        F.lit(name).alias("accountName"),
        kind.alias("accountType"),
        balance.cast("double").alias("currentBalance"),
        F.lit(account_id).alias("id"),
    )


def event_payload_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One list of account records per event.

    a1 is a credit card of even users, a2 bitcoin (zero for clicks), a3 a dollar
    coin that errors report a second time, a9 an account nobody mapped.
    """
    value = money(F.col("value"))
    kind = F.when(F.col("user_id") % 2 == 0, "credit").otherwise("bank")
    bank = F.lit("bank")
    first = F.array(
        _record("a1", "Main", kind, value),
        _record("a2", "BTC", bank, F.when(F.col("event_type") == "click", 0).otherwise(value)),
        _record("a3", "USDC", bank, value * 10),
        _record("a9", "Other", bank, value),
    )
    again = F.array(_record("a3", "USDC", bank, value * 20))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias(PORTFOLIO),
        F.col("event_id").alias("primary_key"),
        F.col("ts").alias("datetime_now"),
        F.when(F.col("event_type") == "error", F.concat(first, again))
        .otherwise(first)
        .alias("accounts"),
    )


def event_account_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps that differ: even users map two accounts, odd users three, one of
    which ("a7") never arrives."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias(PORTFOLIO)).distinct()

    def entry(position: int, name: str, account_id: str) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(account_id).alias("account_id"),
        )

    even = F.array(entry(1, "card", "a1"), entry(2, "dollars", "a3"))
    odd = F.array(entry(1, "dollars", "a3"), entry(2, "bitcoin", "a2"), entry(3, "lost", "a7"))
    return users.select(
        PORTFOLIO, F.explode(F.when(F.col(PORTFOLIO) % 2 == 0, even).otherwise(odd)).alias("entry")
    ).select(PORTFOLIO, "entry.*")
