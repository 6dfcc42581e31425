"""Net worth series and comparison on hand-made rows and against brute force."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from ledgerlane.config import ModelConfig
from ledgerlane.operators.latest import latest_row
from ledgerlane.plans.networth import networth, networth_comparison
from ledgerlane.sources.workspace import new_run_folder
from tests.rows import SERIES, dec, series, snapshots

CONFIG = ModelConfig()


def compared(spark, table, config=CONFIG):
    return networth_comparison(table, config, new_run_folder(spark, "test")).collect()


def test_series_keeps_duplicates_and_evaluates_expressions(spark):
    history = snapshots(spark, [(1, "2023-01-01 10:00:00", 5, 1)]).withColumnRenamed(
        "investment", "networth"
    )
    current = snapshots(spark, [(1, "2024-01-01 10:00:00", 8, 2)] * 2)
    config = replace(
        CONFIG,
        pre_investment_expr="networth / 2",
        networth_expr="investment * 2",
        investment_expr="investment + 1",
    )
    result = networth(history, current, config)
    rows = sorted((r["networth"], r["investment_amount"]) for r in result.collect())
    assert rows == [(dec("5.00"), dec("2.50")), (16, 9), (16, 9)]


def test_misspelt_expression_fails_before_any_job(spark):
    current = snapshots(spark, [(1, "2024-01-01 10:00:00", 8)])
    history = current.withColumnRenamed("investment", "networth")
    with pytest.raises(Exception, match="no_such_column"):
        networth(history, current, replace(CONFIG, networth_expr="no_such_column"))


def test_empty_series(spark):
    empty = spark.createDataFrame([], SERIES)
    assert compared(spark, empty) == []
    assert [tuple(r) for r in compared(spark, empty, replace(CONFIG, keys=()))] == [(None,) * 6]


def test_under_and_exactly_thirty_days(spark):
    table = series(
        spark,
        [
            (1, "2024-03-31 12:00:00", 100, 1),
            (1, "2024-03-01 13:00:00", 90, 2),  # 29 days 23 hours
            (2, "2024-03-31 12:00:00", 100, 1),
            (2, "2024-03-01 12:00:00", 80, 3),  # 30 days
        ],
    )
    rows = {r["portfolio_id"]: r for r in compared(spark, table)}
    assert rows[1]["networth_thirty_days_ago"] is None
    assert rows[1]["investment_amount_sixty_days_ago"] is None
    assert rows[2]["networth_thirty_days_ago"] == 80
    assert rows[2]["investment_amount_thirty_days_ago"] == 3


def test_limit_inside_a_day_needs_the_earlier_reading_of_that_day(spark):
    table = series(
        spark,
        [
            (1, "2024-03-31 12:00:00", 100, 1),
            (1, "2024-03-01 18:00:00", 90, 2),
            (1, "2024-03-01 11:59:59.999999", 80, 3),
            (1, "2024-03-01 06:00:00", 70, 4),
            (1, "2024-02-29 23:00:00", 60, 5),
        ],
    )
    (row,) = compared(spark, table)
    assert row["networth_thirty_days_ago"] == 80
    (single,) = compared(spark, table, replace(CONFIG, keys=()))
    assert single["networth_thirty_days_ago"] == 80


def test_tied_timestamps_take_both_values_from_one_row(spark):
    table = series(
        spark,
        [
            (1, "2024-03-31 12:00:00", 100, 1, 7),
            (1, "2024-03-31 12:00:00", 50, None, 8),
            (1, "2024-01-31 12:00:00", 10, 20, 9),
            (1, "2024-01-31 12:00:00", 30, 40, 3),
        ],
    )
    (row,) = compared(spark, table)
    assert (row["networth_now"], row["investment_amount_now"]) == (50, None)
    assert row["networth_sixty_days_ago"] == 10
    assert row["investment_amount_sixty_days_ago"] == 20


def test_latest_row_of_each_portfolio(spark):
    table = snapshots(
        spark,
        [
            (1, "2024-01-01 10:00:00", 5, 1),
            (1, "2024-01-02 10:00:00", None, 2),
            (1, "2024-01-02 10:00:00", 6, 1),
            (2, "2024-01-01 10:00:00", 7, 3),
        ],
    )
    newest = latest_row(table, ["portfolio_id"])
    rows = {r["portfolio_id"]: r["investment"] for r in newest.collect()}
    assert rows == {1: None, 2: 7}
    assert latest_row(table, []).count() == 1
    assert latest_row(table.filter("false"), []).count() == 0
    unique = table.filter("primary_key <> 1 or date_now = DATE'2024-01-01'")
    assert latest_row(unique, ["portfolio_id"], tie_breaker=None).count() == 2
    assert latest_row(table.filter("false"), [], tie_breaker=None).count() == 0


def expected_comparison(rows, ages):
    result = {}
    for portfolio in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == portfolio]
        now = max(r[2] for r in own)
        picked = []
        for days in [0, *ages]:
            old = [r for r in own if (now - r[2]).days >= days]
            picked.append(max(old, key=lambda r: (r[2], r[1])) if old else None)
        result[portfolio] = tuple(
            None if r is None else r[column] for column in (4, 5) for r in picked
        )
    return result


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for key in range(500):
        portfolio = 1 if rng.random() < 0.34 else rng.randint(2, 12)
        ts = start + timedelta(hours=rng.randint(0, 24 * 25))
        # On one seed the date label disagrees with the timestamp here and there.
        label = (ts + timedelta(days=rng.choice([0, 0, 1]) if seed == 3 else 0)).date()
        rows.append((portfolio, key, ts, label, Decimal(rng.randint(0, 999)), Decimal(key)))
    table = spark.createDataFrame(rows, SERIES)
    config = replace(CONFIG, ages={"a": 1, "b": 2, "c": 11})
    actual = {r["portfolio_id"]: tuple(r)[1:] for r in compared(spark, table, config)}
    assert actual == expected_comparison(rows, [1, 2, 11])

    (single,) = compared(spark, table, replace(config, keys=()))
    as_one = [(0, *r[1:]) for r in rows]
    assert tuple(single) == expected_comparison(as_one, [1, 2, 11])[0]
