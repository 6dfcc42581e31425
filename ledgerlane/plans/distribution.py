"""Amount per security, per security and asset class, and per asset class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.config import ModelConfig
from ledgerlane.functions.money import add_all, cents
from ledgerlane.operators.reshape import columns_to_rows
from ledgerlane.operators.skew import attach_by_key, attach_single
from ledgerlane.schemas import CLASSES


def stock_distribution(
    investment_distribution: DataFrame, latest: DataFrame, config: ModelConfig
) -> DataFrame:
    """Sum of the spreads of every security, from the latest snapshot.

    ``latest`` has one row per portfolio. A security of a portfolio without a
    snapshot, or with a null in any spread, gets a null amount.
    """
    keys = list(config.keys)
    if keys:
        attached = attach_by_key(investment_distribution, latest, keys, ["stock_symbol"])
    else:
        attached = attach_single(investment_distribution, latest)
    spreads = attached.selectExpr(
        *keys, "stock_symbol", *[f"({e}) AS {name}" for name, e in config.spread_exprs.items()]
    )
    total = cents(add_all(F.col(name) for name in config.spread_exprs))
    return spreads.select(*keys, "stock_symbol", total.alias("total_amount"))


def asset_distribution(
    stocks: DataFrame, assett_class_split: DataFrame, config: ModelConfig, salted: bool = False
) -> DataFrame:
    """Amounts per asset class of every security.

    A symbol without a split keeps null amounts; several split rows of a symbol
    give several result rows. No broadcast hint: the planner broadcasts the
    split when its size allows, otherwise adaptive execution splits hot symbols.
    With ``salted`` a symbol that many portfolios hold is dealt out by portfolio,
    which reads the symbols of ``stocks`` once more: for a table that is stored.
    """
    if salted and config.keys:
        joined = attach_by_key(stocks, assett_class_split, ["stock_symbol"], config.keys)
    else:
        joined = stocks.join(assett_class_split, "stock_symbol", "left")
    return joined.select(
        *config.keys,
        "stock_symbol",
        "total_amount",
        *[cents(F.col(c) * F.col("total_amount")).alias(f"amount_{c}") for c in CLASSES],
    )


def asset_totals(distribution: DataFrame, config: ModelConfig) -> DataFrame:
    """One row per asset class; nulls are ignored, all-null stays null.

    One aggregation for all classes, then the single wide row is turned into
    rows. No securities, no rows - also without keys.
    """
    keys = list(config.keys)
    wide = (
        distribution.groupBy(*keys)
        .agg(
            F.count("*").alias("_securities"),
            *[F.sum(f"amount_{c}").alias(c) for c in CLASSES],
        )
        .filter(F.col("_securities") > 0)
    )
    return columns_to_rows(wide, keys, CLASSES, "assett_class", "amount")
