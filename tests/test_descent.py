"""Newest rows by descent over date partitions."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest

from ledgerlane.operators.descent import OLDEST, latest_by_descent, windows_back
from ledgerlane.operators.latest import latest_row
from ledgerlane.sources.warehouse import append_snapshots, read_table
from ledgerlane.sources.workspace import new_run_folder
from tests.rows import SNAPSHOT, dec, snapshots

NEWEST = date(2024, 3, 31)


def dated(spark, rows):
    path = new_run_folder(spark, "history")
    append_snapshots(rows, path)
    return path, read_table(spark, path)


def descended(spark, history, wanted, keys=("portfolio_id",), **options):
    result = latest_by_descent(history, wanted, NEWEST, new_run_folder(spark, "descent"), keys, **options)
    return sorted(tuple(r) for r in result.select(*keys, "datetime_now", "primary_key", "investment").collect())


def plainly(history, keys=("portfolio_id",)):
    newest = latest_row(history, list(keys)).select(*keys, "datetime_now", "primary_key", "investment")
    return sorted(tuple(r) for r in newest.collect())


@pytest.mark.parametrize("days, growth", [(1, 4), (1, 1), (7, 2), (30, 10)])
def test_windows_hold_every_date_once(days, growth):
    if growth == 1:
        windows = [w for w, _ in zip(windows_back(NEWEST, days, growth), range(400))]
    else:
        windows = list(windows_back(NEWEST, days, growth))
        assert windows[-1][0] is None and len(windows) < 20
    assert windows[0][1] is None
    for (first, _), (_, before) in zip(windows, windows[1:]):
        assert first == before and (first is None or first > OLDEST)


def test_silent_portfolios_are_found_and_absent_ones_end_the_search(spark):
    rows = snapshots(spark, [
        (1, "2024-03-31 10:00:00", 1), (1, "2024-03-31 12:00:00", 2), (1, "2024-03-30 23:00:00", 3),
        (2, "2024-03-29 10:00:00", 4), (3, "2019-01-01 10:00:00", 5), (4, "2031-01-01 10:00:00", 6),
        (5, "1850-01-01 10:00:00", 7), (6, "2024-03-31 10:00:00", None), (7, "2024-03-31 10:00:00", 8),
    ])
    _, history = dated(spark, rows)
    wanted = spark.createDataFrame([(p,) for p in (1, 2, 3, 4, 5, 6, 99, 1)], "portfolio_id bigint")
    expected = [r for r in plainly(history) if r[0] != 7]
    assert len(expected) == 6
    assert descended(spark, history, wanted) == expected
    assert descended(spark, history, wanted.filter("portfolio_id = 99")) == []
    assert descended(spark, history.filter("false"), wanted) == []


def test_only_the_newest_partitions_are_read(spark):
    rows = snapshots(spark, [(p, f"2024-03-{d:02} 10:00:00", p * d) for d in range(1, 32) for p in range(4)])
    path, history = dated(spark, rows)
    expected = plainly(history)
    for folder in Path(path).glob("date_now=*"):
        if folder.name < "date_now=2024-03-31":
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"unreadable")
    wanted = spark.createDataFrame([(p,) for p in range(4)], "portfolio_id bigint")
    assert descended(spark, read_table(spark, path, rows.schema), wanted) == expected
    with pytest.raises(Exception, match="(?i)parquet"):
        descended(spark, read_table(spark, path, rows.schema), wanted.unionByName(
            spark.createDataFrame([(9,)], "portfolio_id bigint")))


def test_without_keys_the_first_days_settle_it(spark):
    rows = snapshots(spark, [(1, "2024-03-20 10:00:00", 1, 1), (2, "2024-03-20 10:00:00", 2, 2)])
    _, history = dated(spark, rows)
    assert descended(spark, history, None, keys=()) == plainly(history, ())
    assert descended(spark, history.filter("false"), None, keys=()) == []


@pytest.mark.parametrize("seed", range(2))
def test_descent_equals_the_full_pass(spark, seed):
    rng = random.Random(seed)
    rows = []
    for key in range(600):
        portfolio = 1 if rng.random() < 0.34 else rng.randint(2, 60)
        ts = datetime(2024, 3, 31, 23) - timedelta(hours=int(rng.expovariate(1 / (40 * portfolio))))
        rows.append((portfolio, key, ts, ts.date(), dec(rng.randint(0, 99))))
    _, history = dated(spark, spark.createDataFrame(rows, SNAPSHOT))
    wanted = history.select("portfolio_id").distinct()
    for options in ({}, {"days": 3, "growth": 2}):
        assert descended(spark, history, wanted, **options) == plainly(history)
