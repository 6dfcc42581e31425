"""As-of join at any instants, against brute force."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta

import pytest

from ledgerlane.operators.asof import as_of
from ledgerlane.queries import QUERIES
from tests.rows import SERIES, at, dec, series
from tests.test_plans import plan_of

VALUES = ["networth", "investment_amount"]


def asked(spark, rows):
    return spark.createDataFrame(
        [(p, None if t is None else at(t) if isinstance(t, str) else t, tag) for p, t, tag in rows],
        "portfolio_id bigint, instant timestamp_ntz, tag int")


def found(df):
    return sorted(((r["tag"], r["datetime_stamp"], r["networth"], r["investment_amount"]) for r in df.collect()), key=str)


def expected(readings, instants):
    out = []
    for portfolio, instant, tag in instants:
        old = [r for r in readings if r[0] == portfolio and instant is not None and r[2] <= instant]
        best = max(old, key=lambda r: (r[2], r[1])) if old else (None,) * 6
        out.append((tag, best[2], best[4], best[5]))
    return sorted(out, key=str)


def test_borders_ties_nulls_and_far_carries(spark):
    readings = series(spark, [
        (1, "2024-03-01 10:00:00", 10, None, 1), (1, "2024-03-01 10:00:00", 11, 2, 2), (1, "2024-03-02 00:00:00", 12, 3, 3),
        (2, "1901-05-05 05:05:05", 20, 1, 4), (2, "2024-03-01 23:59:59.999999", None, 9, 5), (3, "2024-01-01 00:00:00", 30, 1, 6),
    ])
    instants = asked(spark, [
        (1, "2024-03-01 10:00:00", 1), (1, "2024-03-01 09:59:59.999999", 2), (1, "2024-03-01 23:59:59", 3),
        (1, "2024-03-02 00:00:00", 4), (1, "2031-03-02 00:00:00", 5), (1, "1969-12-31 23:00:00", 6),
        (2, "2024-03-01 23:59:59.999998", 7), (2, "2024-03-01 23:59:59.999999", 8), (2, "1901-05-05 05:05:05", 9),
        (2, "1969-12-31 23:59:59", 10), (3, "9999-12-31 00:00:00", 11), (4, "2024-03-01 00:00:00", 12), (1, None, 13),
        (None, "2024-03-01 00:00:00", 14), (1, "2024-03-01 10:00:00", 15), (1, "2024-03-01 10:00:00", 15),
    ])
    rows = [tuple(r) for r in readings.collect()]
    wanted = [tuple(r) for r in instants.collect()]
    result = as_of(readings, instants, ["portfolio_id"], VALUES)
    assert result.columns == ["portfolio_id", "instant", "tag", "datetime_stamp", *VALUES]
    assert found(result) == expected(rows, wanted)
    assert as_of(readings, instants.filter("false"), ["portfolio_id"], VALUES).count() == 0
    assert {r[1] for r in found(as_of(readings.filter("false"), instants, ["portfolio_id"], VALUES))} == {None}


@pytest.mark.parametrize("seed, days", [(1, 1), (2, 1), (3, 5)])
def test_against_brute_force(spark, seed, days):
    rng = random.Random(seed)
    start = datetime(1969, 12, 1) if seed == 1 else datetime(2024, 1, 1)
    readings, instants = [], []
    for key in range(500):
        portfolio = 1 if rng.random() < 0.34 else rng.randint(2, 9)
        ts = start + timedelta(hours=int(rng.paretovariate(0.6)) % 40_000)
        # Labels that disagree with the time do no harm.
        readings.append((portfolio, key, ts, (ts + timedelta(days=rng.randint(0, 1))).date(), dec(rng.randint(0, 99)), dec(key)))
        instants.append((rng.randint(1, 10), start + timedelta(hours=rng.randint(-9, 42_000)), key))
    table = spark.createDataFrame(readings, SERIES)
    result = as_of(table, asked(spark, instants), ["portfolio_id"], VALUES, days=days)
    assert found(result) == expected(readings, instants)


def test_no_window_holds_a_whole_portfolio(spark):
    plan = plan_of(QUERIES["networth_as_of"](spark, "/root/testdata/sf0.001"))
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert windows
    for line in windows:
        assert "windowspecdefinition(portfolio_id#" in line
        assert re.search(r"windowspecdefinition\(portfolio_id#\d+L, _(bucket|parent)#", line)
    # Every shuffle is by portfolio and a stretch of time, or an instant.
    assert not re.search(r"hashpartitioning\(portfolio_id#\d+L, \d+\)", plan)


def test_plain_keys_meet_their_instants_in_one_shuffle(spark):
    """Keys that are not hot take neither the ladder nor a join; hot ones do, and both give what brute force gives."""
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    readings, instants = [], []
    for number in range(400):
        ts = start + timedelta(hours=rng.randint(0, 3000))
        readings.append((number % 100, number, ts, ts.date(), dec(number), dec(1)))
        instants.append((rng.randint(0, 110), start + timedelta(hours=rng.randint(0, 3000)), number))
    result = as_of(spark.createDataFrame(readings, SERIES), asked(spark, instants), ["portfolio_id"], VALUES)
    plan = plan_of(result)
    assert "Join" not in plan and plan.count("windowspecdefinition") == 1
    assert found(result) == expected(readings, instants)

    hot = [(7, 1000 + n, start + timedelta(hours=n), start.date(), dec(n), dec(2)) for n in range(600)]
    more = [(7, start + timedelta(hours=3 * n, minutes=1), 1000 + n) for n in range(300)]
    hot_result = as_of(
        spark.createDataFrame(readings + hot, SERIES), asked(spark, [*instants, *more, (None, start, -1), (7, None, -2)]),
        ["portfolio_id"], VALUES)
    assert "Join" in plan_of(hot_result)
    assert found(hot_result) == expected(readings + hot, [*instants, *more, (None, start, -1), (7, None, -2)])
