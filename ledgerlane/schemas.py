"""Declared schemas of the staging tables. Nothing is inferred from data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

from ledgerlane.functions.money import FRACTION, MONEY, WEIGHT

PORTFOLIO = "portfolio_id"

ACCOUNT_RECORD = T.StructType(
    [
        T.StructField("accountName", T.StringType()),
        T.StructField("accountType", T.StringType()),
        T.StructField("currentBalance", T.DoubleType()),
        T.StructField("id", T.StringType()),
    ]
)

PAYLOAD = T.ArrayType(ACCOUNT_RECORD)

ACCOUNT_MAP = T.StructType(
    [
        T.StructField(PORTFOLIO, T.LongType(), False),
        T.StructField("position", T.IntegerType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("account_id", T.StringType(), False),
    ]
)

NETWORTH_HISTORICAL = T.StructType(
    [
        T.StructField(PORTFOLIO, T.LongType(), False),
        T.StructField("primary_key", T.LongType(), False),
        T.StructField("datetime_now", T.TimestampNTZType(), False),
        T.StructField("date_now", T.DateType(), False),
        T.StructField("networth", MONEY),
    ]
)

CLASSES = ("us_stock", "foreign_stock", "bonds", "cryptocurrency", "stablecoin")

ASSETT_CLASS_SPLIT = T.StructType(
    [T.StructField("stock_symbol", T.StringType(), False)]
    + [T.StructField(name, FRACTION) for name in CLASSES]
)

DATES = T.StructType([T.StructField("date_value", T.DateType(), False)])


def snapshot_schema(accounts: Iterable[str], portfolio: bool = True) -> T.StructType:
    """A landed snapshot: capture columns, then one amount per account in map order."""
    fields = [T.StructField(PORTFOLIO, T.LongType())] if portfolio else []
    fields += [
        T.StructField("datetime_now", T.TimestampNTZType()),
        T.StructField("date_now", T.DateType()),
    ]
    return T.StructType(fields + [T.StructField(a, MONEY) for a in accounts])


def investment_distribution_schema(accounts: Iterable[str]) -> T.StructType:
    """Weight of every account in every security a portfolio holds."""
    return T.StructType(
        [
            T.StructField(PORTFOLIO, T.LongType(), False),
            T.StructField("stock_symbol", T.StringType(), False),
        ]
        + [T.StructField(f"{a}_weight", WEIGHT) for a in accounts]
    )
