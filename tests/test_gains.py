"""Gains and losses on hand-made readings and against brute force."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, datetime, time, timedelta
from decimal import Decimal

import pytest

from ledgerlane.config import ModelConfig
from ledgerlane.operators.latest import morning_readings
from ledgerlane.plans.gains import gains_losses
from tests.rows import SNAPSHOT, calendar, day, dec, snapshots

CONFIG = ModelConfig()


def by_day(df, portfolio=1):
    return {
        r["date_value"]: r for r in df.collect() if r.asDict().get("portfolio_id", 1) == portfolio
    }


# 2024-01-05 is a Friday.


def test_cutoff_is_inclusive(spark):
    readings = snapshots(
        spark,
        [
            (1, "2024-01-02 13:30:00.000000", 1),
            (1, "2024-01-02 13:30:00.000001", 2),
        ],
    )
    row = morning_readings(readings, "investment", time(13, 30), ["portfolio_id"]).first()
    assert (row["last_value"], row["first_value"]) == (dec("1.00"), dec("1.00"))


def test_friday_ends_on_saturday_and_monday_looks_back_to_friday(spark):
    readings = snapshots(
        spark,
        [
            (1, "2024-01-05 13:15:00", 100),
            (1, "2024-01-06 00:15:00", 104),
            (1, "2024-01-08 09:00:00", 90),
            (1, "2024-01-09 09:00:00", 91),
        ],
    )
    rows = by_day(gains_losses(readings, calendar(spark, "2024-01-01", "2024-01-09"), CONFIG))
    assert rows[day("2024-01-05")]["gains_losses"] == 4
    assert rows[day("2024-01-08")]["previous_day_gains"] == 4
    assert rows[day("2024-01-09")]["previous_day_gains"] == 1
    assert day("2024-01-06") not in rows
    assert len(rows) == 7


def test_missing_next_morning_is_not_skipped(spark):
    readings = snapshots(
        spark,
        [
            (1, "2024-01-01 09:00:00", 10),
            (1, "2024-01-02 09:00:00", 12),
            (1, "2024-01-04 09:00:00", 15),
        ],
    )
    rows = by_day(gains_losses(readings, calendar(spark, "2024-01-01", "2024-01-05"), CONFIG))
    monday, tuesday, wednesday = (rows[day(f"2024-01-0{d}")] for d in (1, 2, 3))
    assert monday["gains_losses"] == 2
    assert tuesday["post_investment"] is None and tuesday["gains_losses"] is None
    assert tuesday["previous_day_gains"] == 2
    assert wednesday["pre_investment"] is None and wednesday["post_investment"] == 15
    assert wednesday["previous_day_gains"] is None


def test_single_reading_serves_both_days(spark):
    readings = snapshots(spark, [(1, "2024-01-02 08:00:00", 7)])
    rows = by_day(gains_losses(readings, calendar(spark, "2024-01-01", "2024-01-03"), CONFIG))
    assert rows[day("2024-01-02")]["pre_investment"] == 7
    assert rows[day("2024-01-01")]["post_investment"] == 7


def test_null_at_the_picked_reading_stays_null(spark):
    readings = snapshots(
        spark, [(1, "2024-01-02 08:00:00", 7), (1, "2024-01-02 09:00:00", None)]
    )
    rows = by_day(gains_losses(readings, calendar(spark, "2024-01-02", "2024-01-02"), CONFIG))
    assert rows[day("2024-01-02")]["pre_investment"] is None


def test_tied_readings_use_the_key(spark):
    readings = snapshots(
        spark,
        [
            (1, "2024-01-02 08:00:00", 1, -5),
            (1, "2024-01-02 08:00:00", 2, 9_000_000_000_000_000_000),
            (1, "2024-01-02 08:00:00", 3, -9_000_000_000_000_000_000),
        ],
    )
    row = morning_readings(readings, "investment", time(13, 30), ["portfolio_id"]).first()
    assert (row["last_value"], row["first_value"]) == (2, 3)


def test_portfolio_with_only_afternoons_keeps_its_calendar(spark):
    readings = snapshots(spark, [(1, "2024-01-02 18:00:00", 1), (2, "2024-01-02 08:00:00", 1)])
    result = gains_losses(readings, calendar(spark, "2024-01-01", "2024-01-05"), CONFIG)
    assert [r["pre_investment"] for r in by_day(result, 1).values()] == [None] * 5


def test_global_form_without_readings_shows_the_calendar(spark):
    readings = spark.createDataFrame([], SNAPSHOT)
    config = replace(CONFIG, keys=())
    result = gains_losses(readings, calendar(spark, "2024-01-01", "2024-01-05"), config)
    assert result.count() == 5
    assert result.filter("pre_investment is not null").count() == 0
    keyed = gains_losses(readings, calendar(spark, "2024-01-01", "2024-01-05"), CONFIG)
    assert keyed.count() == 0


def test_session_time_zone_does_not_matter(spark):
    readings = snapshots(
        spark,
        [(1, "2024-03-10 02:30:00", 1, 1), (1, "2024-03-10 03:00:00", 2, 2)],
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = morning_readings(readings, "investment", time(13, 30), ["portfolio_id"]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row["first_value"], row["last_value"]) == (1, 2)


def expected_gains(readings, days, portfolios, cutoff):
    """The definition, one cell at a time."""
    mornings = {}
    for portfolio, key, ts, amount in readings:
        if ts.time() <= cutoff:
            mornings.setdefault((portfolio, ts.date()), []).append((ts, key, amount))
    result = {}
    for portfolio in portfolios:
        previous = None
        for d in sorted(x for x in days if x.weekday() < 5):
            own = mornings.get((portfolio, d))
            following = mornings.get((portfolio, d + timedelta(days=1)))
            pre = max(own)[2] if own else None
            post = min(following)[2] if following else None
            gain = None if pre is None or post is None else post - pre
            result[portfolio, d] = (pre, post, gain, previous)
            previous = gain
    return result


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("tie_breaker", ["primary_key", None])
def test_against_brute_force(spark, seed, tie_breaker):
    rng = random.Random(seed)
    start = datetime(2024, 2, 20)
    readings, used = [], set()
    for key in range(600):
        portfolio = 1 if rng.random() < 0.34 else rng.randint(2, 8)
        step = rng.randint(0, 40 * 24)
        ts = start + timedelta(hours=step)
        if tie_breaker is None and (portfolio, ts) in used:
            continue
        used.add((portfolio, ts))
        readings.append((portfolio, key, ts, Decimal(rng.randint(1, 10**6)) / 100))
    # A calendar with holes that neither starts nor ends with the readings.
    days = [date(2024, 2, 25) + timedelta(days=i) for i in range(50)]
    days = [d for d in days if rng.random() < 0.9]

    account_data = spark.createDataFrame(
        [(p, k, ts, ts.date(), v) for p, k, ts, v in readings], SNAPSHOT
    )
    dates = spark.createDataFrame([(d,) for d in days], "date_value date")
    config = replace(CONFIG, tie_breaker=tie_breaker)
    actual = {
        (r["portfolio_id"], r["date_value"]): tuple(r)[2:]
        for r in gains_losses(account_data, dates, config).collect()
    }
    portfolios = {p for p, *_ in readings}
    assert actual == expected_gains(readings, days, portfolios, config.cutoff)
