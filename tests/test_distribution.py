"""Distributions on hand-made securities."""

from __future__ import annotations

from dataclasses import replace

import pytest

from ledgerlane.config import ModelConfig, weighted_spreads
from ledgerlane.functions.money import cents
from ledgerlane.operators.skew import attach_by_key
from ledgerlane.plans.distribution import asset_distribution, asset_totals, stock_distribution
from ledgerlane.schemas import ASSETT_CLASS_SPLIT, investment_distribution_schema
from tests.rows import dec

ACCOUNTS = ("broker", "coins")
CONFIG = ModelConfig(spread_exprs=weighted_spreads(ACCOUNTS))
SINGLE = replace(CONFIG, keys=())
LATEST = "portfolio_id bigint, broker decimal(18,2), coins decimal(18,2)"


def weights(spark, rows):
    rows = [(p, s, dec(a), dec(b)) for p, s, a, b in rows]
    return spark.createDataFrame(rows, investment_distribution_schema(ACCOUNTS))


def latest(spark, rows):
    return spark.createDataFrame([(p, dec(a), dec(b)) for p, a, b in rows], LATEST)


def split(spark, rows):
    return spark.createDataFrame([(s, *map(dec, f)) for s, *f in rows], ASSETT_CLASS_SPLIT)


def test_null_in_one_spread_makes_the_amount_null(spark):
    held = weights(
        spark, [(1, "A", 0.5, 0.25), (1, "B", 0.5, None), (2, "A", 1, 1), (3, "A", 1, 1)]
    )
    newest = latest(spark, [(1, 10, 20), (2, 10, None)])
    rows = {
        (r["portfolio_id"], r["stock_symbol"]): r["total_amount"]
        for r in stock_distribution(held, newest, CONFIG).collect()
    }
    assert rows == {(1, "A"): 10, (1, "B"): None, (2, "A"): None, (3, "A"): None}


def test_single_portfolio_form(spark):
    held = weights(spark, [(1, "A", 0.5, 0.25), (1, "B", 0.1, 0)]).drop("portfolio_id")
    newest = latest(spark, [(1, 10, 20)]).drop("portfolio_id")
    result = stock_distribution(held, newest, SINGLE)
    rows = {r["stock_symbol"]: r["total_amount"] for r in result.collect()}
    assert rows == {"A": 10, "B": 1}
    nothing = stock_distribution(held, newest.filter("false"), SINGLE)
    assert {r["total_amount"] for r in nothing.collect()} == {None}


def test_two_snapshots_are_refused_by_the_single_form(spark):
    held = weights(spark, [(1, "A", 0.5, 0.25)]).drop("portfolio_id")
    newest = latest(spark, [(1, 10, 20), (2, 30, 40)]).drop("portfolio_id")
    with pytest.raises(Exception, match="SCALAR_SUBQUERY"):
        stock_distribution(held, newest, SINGLE).collect()


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(dec("2.345"),), (dec("-2.345"),)], "x decimal(9,4)")
    assert [r[0] for r in df.select(cents(df["x"])).collect()] == [dec("2.35"), dec("-2.35")]


def stocks(spark, rows):
    return spark.createDataFrame(
        [(p, s, dec(a)) for p, s, a in rows],
        "portfolio_id bigint, stock_symbol string, total_amount decimal(18,2)",
    )


def test_unmatched_and_duplicate_split_rows(spark):
    table = stocks(spark, [(1, "A", 100), (1, "B", 50), (1, "C", None)])
    splits = split(
        spark, [("A", 0.5, 0.1, 0.2, 0.1, 0.1), ("A", 1, 0, 0, 0, 0), ("C", 1, 0, 0, 0, 0)]
    )
    rows = asset_distribution(table, splits, CONFIG).collect()
    amounts = sorted(
        (r["stock_symbol"], r["amount_us_stock"] is None, r["amount_us_stock"] or 0) for r in rows
    )
    assert amounts == [("A", False, 50), ("A", False, 100), ("B", True, 0), ("C", True, 0)]


def test_totals_ignore_nulls_and_keep_all_null_classes(spark):
    table = stocks(spark, [(1, "A", 100), (1, "B", 50), (2, "B", 50)])
    splits = split(spark, [("A", 0.5, 0.1, None, 0.1, 0.1)])
    distribution = asset_distribution(table, splits, CONFIG)
    rows = {(r[0], r[1]): r[2] for r in asset_totals(distribution, CONFIG).collect()}
    assert rows[1, "us_stock"] == 50 and rows[1, "bonds"] is None
    assert rows[2, "us_stock"] is None
    assert len(rows) == 10


def test_no_securities_no_totals(spark):
    empty = asset_distribution(stocks(spark, []), split(spark, []), CONFIG)
    assert asset_totals(empty, CONFIG).count() == 0
    assert asset_totals(empty.drop("portfolio_id"), SINGLE).count() == 0


def test_salted_join_equals_plain_left_join(spark):
    big = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 50 END AS portfolio_id", "id AS item"
    )
    small = spark.range(40).selectExpr("id AS portfolio_id", "id * 2 AS twice")
    expected = big.join(small, "portfolio_id", "left")
    actual = attach_by_key(big, small, ["portfolio_id"], ["item"])
    assert actual.columns == expected.columns
    assert actual.exceptAll(expected).count() == 0
    assert expected.exceptAll(actual).count() == 0
