"""The newest row of every portfolio, from the newest date partitions of a history alone."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.operators.latest import latest_row
from ledgerlane.schemas import PORTFOLIO

# Windows older than this are read as one.
OLDEST = date(1900, 1, 1)


def windows_back(newest: date, days: int, growth: int) -> Iterator[tuple[date | None, date | None]]:
    """Half-open date ranges (from, before), newest first, that together hold every date.

    The first is open to later dates, the last to earlier ones, and each is `growth` times as
    long as the one before it, so a thousand years take about nine of them.
    """
    before, first, length = None, newest - timedelta(days=days - 1), days
    while first > OLDEST:
        yield first, before
        length *= growth
        before = first
        first = before - timedelta(days=length) if length < (before - OLDEST).days else OLDEST
    yield None, before


def in_window(history: DataFrame, day: str, window: tuple[date | None, date | None]) -> DataFrame:
    """Rows of a date range; on a table partitioned by `day`, no other partition is listed or read."""
    first, before = window
    if first is not None:
        history = history.filter(F.col(day) >= F.lit(first))
    if before is not None:
        history = history.filter(F.col(day) < F.lit(before))
    return history


def latest_by_descent(
    history: DataFrame,
    wanted: DataFrame,
    newest: date,
    folder: str,
    keys: Sequence[str] = (PORTFOLIO,),
    ts: str = "datetime_now",
    tie_breaker: str | None = "primary_key",
    day: str = "date_now",
    days: int = 1,
    growth: int = 4,
    before: str | None = None,
) -> DataFrame:
    """``latest_row`` of the keys listed in ``wanted``, from a history partitioned by ``day``.

    Rounds go back in time from ``newest`` (later dates belong to the first
    round). Each reads one range of dates, keeps the newest row of every key
    that is still missing, and hands what is missing then to the next round.
    It stops when no key is left, or when all dates were read because a wanted
    key has no row at all. Nearly all portfolios have a reading on the last
    days, so nearly nothing is read but these days; a portfolio that has been
    silent for years costs rounds in which the few missing keys prune
    everything else where it lies.

    ``day`` must be the day of ``ts`` (the loader checks that). Both the rows
    found and the keys missing are stored below ``folder``, so a lost executor
    repeats no round, and a job looks at a key list that is as large as what
    is missing. Without ``keys`` the first range with a row ends the search.

    ``before`` names a column of ``wanted`` with a day of each key: only rows of
    earlier days count for it. A key must then be listed once.
    """
    spark = history.sparkSession
    keys = list(keys)
    found: list[str] = []
    bound = [] if before is None else [before]
    missing = wanted.select(*keys, *bound).distinct() if keys else None
    for number, window in enumerate(windows_back(newest, days, growth)):
        part = in_window(history, day, window)
        if before is not None:
            part = part.join(missing, keys).filter(F.col(day) < F.col(before)).drop(before)
        elif number and keys:
            # Few keys are missing now: they prune rows before anything is combined.
            part = part.join(missing, keys, "left_semi")
        rows = latest_row(part, keys, ts, tie_breaker)
        if not number and keys and before is None:
            # Nearly all keys are wanted: combined rows are fewer than readings.
            rows = rows.join(missing, keys, "left_semi")
        found.append(f"{folder}/found-{number}")
        rows.write.parquet(found[-1])
        got = spark.read.schema(rows.schema).parquet(found[-1])
        if not keys:
            if not got.isEmpty():
                break
            continue
        left = missing.join(got, keys, "left_anti")
        left.write.parquet(f"{folder}/missing-{number}")
        missing = spark.read.schema(left.schema).parquet(f"{folder}/missing-{number}")
        if missing.isEmpty():
            break
    return spark.read.schema(rows.schema).parquet(*found)
