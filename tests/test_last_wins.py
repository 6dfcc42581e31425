"""Last report wins across micro-batches, and single landed files."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlane.queries import LANDED, REPORTED
from ledgerlane.sources.landing import land_file, latest_landed, read_landed
from ledgerlane.sources.versions import DatedTable
from ledgerlane.sources.workspace import new_run_folder
from ledgerlane.streaming.last_wins import load_last_reports, upsert
from tests.rows import at, dec

KEYS = ("portfolio_id", "datetime_now")


def reports(spark, *rows):
    """(portfolio, time, amount, arrival)"""
    return spark.createDataFrame(
        [(p, 0, at(t), at(t).date(), dec(v), n) for p, t, v, n in rows], REPORTED)


@pytest.fixture
def root(spark):
    return new_run_folder(spark, "reports")


def load(spark, root, *rows):
    if rows:
        reports(spark, *rows).repartition(3).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(REPORTED).parquet(f"{root}/in")
    query = load_last_reports(stream, "reported", DatedTable(f"{root}/t"), f"{root}/checkpoint", KEYS)
    kept = DatedTable(f"{root}/t").read(spark, REPORTED)
    return sorted((r["portfolio_id"], r["datetime_now"].hour, int(r["investment"])) for r in kept.collect()), query


def test_a_later_report_replaces_the_earlier_one_over_restarts(spark, root):
    first = [(1, "2024-01-01 10:00:00", 1, 1), (1, "2024-01-01 10:00:00", 2, 2), (2, "2024-01-01 10:00:00", 5, 1)]
    assert load(spark, root, *first)[0] == [(1, 10, 2), (2, 10, 5)]
    assert load(spark, root, (1, "2024-01-01 10:00:00", 3, 3), (1, "2024-01-01 11:00:00", 4, 3))[0] == [
        (1, 10, 3), (1, 11, 4), (2, 10, 5)]
    # An older report that comes late does not win; nothing new changes nothing.
    assert load(spark, root, (1, "2024-01-01 10:00:00", 9, 2))[0] == [(1, 10, 3), (1, 11, 4), (2, 10, 5)]
    assert load(spark, root)[0] == [(1, 10, 3), (1, 11, 4), (2, 10, 5)]


def test_state_is_dropped_when_its_time_is_over(spark, root):
    load(spark, root, (1, "2024-01-01 10:00:00", 1, 1))
    load(spark, root, (1, "2024-03-01 10:00:00", 2, 2))
    _, query = load(spark, root, (1, "2024-03-02 10:00:00", 3, 3))
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 2


def test_a_repeated_batch_is_put_once(spark, root):
    table = DatedTable(f"{root}/t")
    upsert(reports(spark, (1, "2024-01-01 10:00:00", 1, 1)), table, "batch-0", KEYS, "reported")
    upsert(reports(spark, (1, "2024-01-01 10:00:00", 9, 9)), table, "batch-0", KEYS, "reported")
    assert [int(r["investment"]) for r in table.read(spark, REPORTED).collect()] == [1]


def test_a_run_lands_as_one_file_or_not_at_all(spark, root):
    rows = reports(spark, *[(p, "2024-01-01 10:00:00", p, 0) for p in range(40)]).drop("reported").repartition(4)
    run = at("2024-01-01 10:15:00")
    broken = rows.withColumn("investment", F.when(F.col("portfolio_id") == 39, F.raise_error("lost")).otherwise(F.col("investment")))
    with pytest.raises(Exception, match="lost"):
        land_file(broken, root, run)
    assert not [f for f in Path(root).rglob("*") if f.is_file()]
    path = land_file(rows, root, run)
    assert path.endswith("account-data/mint_01_01_2024_10-15-00.csv") and Path(path).is_file()
    assert latest_landed(spark, root).endswith("mint_01_01_2024_10-15-00.csv")
    assert read_landed(spark, path, LANDED).count() == 40
    with pytest.raises(FileExistsError):
        land_file(rows, root, run)
    assert [f.name for f in Path(root).iterdir()] == ["account-data"]
