"""Dated tables whose changes are published by one record, and models kept up to date from them."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlane.config import ModelConfig
from ledgerlane.plans.gains import gains_losses
from ledgerlane.plans.networth import networth, networth_comparison
from ledgerlane.plans.upkeep import Upkeep
from ledgerlane.sources import versions
from ledgerlane.sources.versions import DatedTable
from ledgerlane.sources.workspace import new_run_folder
from tests.rows import SNAPSHOT, calendar, dec

SCHEMA = "k bigint, v bigint, date_now date"


@pytest.fixture
def table(spark):
    return DatedTable(f"{new_run_folder(spark, 'dated')}/t")


def rows(spark, *found):
    return spark.createDataFrame([(k, v, date(2024, 1, d)) for k, v, d in found], SCHEMA)


def put(spark, table, df, names=(), **options):
    entries = table.entries(spark)
    return table.publish(spark, entries, table.write(df), names, **options)


def seen(spark, table, **options):
    schema = rows(spark).schema
    return sorted((r["k"], r["v"], r["date_now"].day) for r in table.read(spark, schema, **options).collect())


def test_appends_and_replacements(spark, table):
    assert seen(spark, table) == [] and table.entries(spark) == []
    put(spark, table, rows(spark, (1, 1, 1), (1, 2, 2)), ["a"])
    second = put(spark, table, rows(spark, (2, 3, 2)), ["b"])
    assert seen(spark, table) == [(1, 1, 1), (1, 2, 2), (2, 3, 2)]
    assert seen(spark, table, days=[date(2024, 1, 2), date(2030, 1, 1)]) == [(1, 2, 2), (2, 3, 2)]
    assert seen(spark, table, only={second.pack}) == [(2, 3, 2)]
    # Day 2 is replaced, day 3 new, and day 1 emptied, all in one step.
    put(spark, table, rows(spark, (9, 9, 2), (9, 8, 3)), ["c"], base=second.version, replaced=[date(2024, 1, 1)])
    assert seen(spark, table) == [(9, 8, 3), (9, 9, 2)]
    assert table.names(table.entries(spark)) == {"a", "b", "c"}


def test_what_was_not_published_is_not_read(spark, table):
    put(spark, table, rows(spark, (1, 1, 1)))
    table.write(rows(spark, (5, 5, 1)))
    assert seen(spark, table) == [(1, 1, 1)]
    assert len(table.remove_unused(spark)) == 1
    assert seen(spark, table) == [(1, 1, 1)]


def test_a_reader_during_a_replacement_sees_old_or_new(spark, table):
    put(spark, table, rows(spark, *[(k, k, 1) for k in range(50)]))
    before = table.read(spark, rows(spark).schema)
    entries = table.entries(spark)
    change = table.write(rows(spark, *[(k, -k, 1) for k in range(50)]))
    during = table.read(spark, rows(spark).schema)
    table.publish(spark, entries, change, base=entries[-1].version)
    after = table.read(spark, rows(spark).schema)
    sums = [df.agg(F.sum("v"), F.count("*")).first() for df in (before, during, after)]
    assert [tuple(s) for s in sums] == [(1225, 50), (1225, 50), (-1225, 50)]


def test_appends_during_a_compaction_stay(spark, table, monkeypatch):
    for k in range(3):
        put(spark, table, rows(spark, (k, k, 1), (k, k, 9)))
    whole = DatedTable.write

    def write_and_append(self, df, cluster=()):
        change = whole(self, df, cluster)
        if len(self.entries(spark)) == 3:
            late = whole(self, rows(spark, (7, 7, 1)))
            self.publish(spark, self.entries(spark), late)
        return change

    monkeypatch.setattr(DatedTable, "write", write_and_append)
    table.compact(spark, rows(spark).schema, date(2024, 1, 5), packs_of_a_day=3)
    monkeypatch.undo()
    wanted = sorted([(k, k, d) for k in range(3) for d in (1, 9)] + [(7, 7, 1)])
    assert seen(spark, table) == wanted
    table.fold_log(spark)
    assert seen(spark, table) == wanted


def files(table):
    return [f for f in Path(table.path).rglob("*.parquet")]


def test_compaction_bounds_files_and_keeps_rows(spark, table):
    wanted = []
    for run in range(24):
        own = [(run, d, d) for d in range(1, 5)]
        wanted += own
        put(spark, table, rows(spark, *own), [f"run-{run}"])
        if run % 6 == 5:
            reader = table.read(spark, rows(spark).schema)
            table.compact(spark, rows(spark).schema, date(2024, 1, 4), packs_of_a_day=4)
            table.fold_log(spark)
            assert len(table.entries(spark)) <= 1 + 3 + 2 * run
            assert reader.count() == len(wanted)
    assert seen(spark, table) == sorted(wanted)
    assert len(files(table)) > 96
    table.remove_unused(spark)
    live = table.live(table.entries(spark))
    assert all(len(of) < 4 for day, of in live.items() if day < date(2024, 1, 4))
    # Closed days hold a file or three, the open day one for each run.
    assert len(files(table)) <= 24 + 3 * 3 + 24
    assert seen(spark, table) == sorted(wanted)
    assert len(table.names(table.entries(spark))) == 24
    assert len(versions.subfolders(spark, f"{table.path}-log")) == 1


# Models kept up to date

CONFIG = replace(ModelConfig(), networth_expr="investment * 2", ages={"a": 1, "b": 9, "c": 30})


def readings(rng, keys, first, last, portfolios):
    start, out = datetime.fromisoformat(first), []
    hours = int((datetime.fromisoformat(last) - start).total_seconds() // 3600)
    for key in keys:
        portfolio = portfolios[0] if rng.random() < 0.34 else rng.choice(portfolios)
        ts = start + timedelta(hours=rng.randint(0, hours), minutes=rng.choice([0, 0, 30]))
        out.append((portfolio, key, ts, ts.date(), dec(rng.randint(0, 999)) if rng.random() < 0.95 else None))
    return out


def full(spark, everything, past, days, config):
    account_data = spark.createDataFrame(everything, SNAPSHOT)
    series = networth(past, account_data, config)
    return {
        "gains_losses": gains_losses(account_data, days, config),
        "networth_comparison": networth_comparison(series, config, new_run_folder(spark, "full")),
    }


def sorted_rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("tie_breaker, n_loads", [("primary_key", 5), (None, 2)])
def test_upkeep_equals_the_full_models_over_late_loads(spark, table, tie_breaker, n_loads):
    rng = random.Random(5)
    config = replace(CONFIG, tie_breaker=tie_breaker)
    past = [(p, 10_000 + p, datetime(2023, 12, 1, 10), date(2023, 12, 1), dec(p)) for p in (1, 2, 50)]
    past = spark.createDataFrame(past, SNAPSHOT).withColumnRenamed("investment", "networth")
    loads = [
        readings(rng, range(0, 150), "2024-01-10 00:00:00", "2024-01-19 23:00:00", [1, 2, 3, 4]),
        readings(rng, range(150, 170), "2024-01-20 00:00:00", "2024-01-23 23:00:00", [1, 2, 5]),
        # Late: days before all others, a portfolio never seen, and days in between.
        readings(rng, range(170, 190), "2024-01-04 00:00:00", "2024-01-12 12:00:00", [2, 3, 6]),
        [],
        readings(rng, range(190, 195), "2024-02-01 00:00:00", "2024-02-01 20:00:00", [1]),
    ]
    if tie_breaker is None:
        unique = set()
        loads = [[r for r in load if not ((r[0], r[2]) in unique or unique.add((r[0], r[2])))] for load in loads]
    everything = []
    folder = new_run_folder(spark, "kept")
    for number, load in enumerate(loads[:n_loads]):
        everything += load
        if load:
            put(spark, table, spark.createDataFrame(load, SNAPSHOT), [f"run-{number}"])
        days = calendar(spark, "2024-01-03", "2024-01-26" if number < 4 else "2024-02-02")
        keeper = Upkeep(spark, table, spark.createDataFrame([], SNAPSHOT).schema, past, days, config, folder)
        packs = {e.pack for e in keeper.gains.entries(spark)}
        kept, wanted = keeper.run(), full(spark, everything, past, days, config)
        for name, df in wanted.items():
            assert sorted_rows(kept[name], df.columns) == sorted_rows(df, df.columns), (name, number)
        new = [e for e in keeper.gains.entries(spark) if e.pack and e.pack not in packs]
        if number == 1:
            # Four changed days: these, the days before them, and the trading days after either.
            assert {d for e in new if e.base is not None for d in e.days} == {
                date(2024, 1, d) for d in (19, 22, 23, 24)}
        if number == 3:
            assert not new


def test_runs_compacted_before_they_were_taken_up_are_not_lost(spark, table):
    rng = random.Random(9)
    past = spark.createDataFrame([], SNAPSHOT).withColumnRenamed("investment", "networth")
    days = calendar(spark, "2024-01-08", "2024-01-19")
    folder, everything, schema = new_run_folder(spark, "kept"), [], spark.createDataFrame([], SNAPSHOT).schema
    for number in range(4):
        load = readings(rng, range(20 * number, 20 * number + 20), "2024-01-08 00:00:00", "2024-01-18 23:00:00", [1, 2, 3])
        everything += load
        put(spark, table, spark.createDataFrame(load, SNAPSHOT), [f"run-{number}"])
        if number == 2:
            continue
        if number == 3:
            table.compact(spark, schema, date(2024, 1, 15), packs_of_a_day=2)
            table.fold_log(spark)
        kept = Upkeep(spark, table, schema, past, days, CONFIG, folder).run()
        for name, df in full(spark, everything, past, days, CONFIG).items():
            assert sorted_rows(kept[name], df.columns) == sorted_rows(df, df.columns), (name, number)


def rows_scanned(df) -> int:
    """How many rows the file scan of a query without a shuffle hands on."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaf = plan.collectLeaves().apply(0)
    return leaf.metrics().get("numOutputRows").get().value()


def test_clustered_files_are_skipped(spark, table):
    """One portfolio has a third of the day's rows; the others' rows are found in a few of the files."""
    readings = spark.range(600_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 997 + 1 END AS k", "id AS v", "DATE'2024-01-01' AS date_now")
    small = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        for part in range(2):
            put(spark, table, readings.filter(F.col("v") % 2 == part).repartition(4))
        schema = rows(spark).schema
        plain = rows_scanned(table.read(spark, schema).filter("k = 500"))
        table.compact(spark, schema, date(2024, 1, 2), packs_of_a_day=2, cluster=("k", "v"))
        clustered = table.read(spark, schema)
        found = clustered.filter("k = 500")
        assert rows_scanned(found) < plain / 10
        assert found.count() == readings.filter("k = 500").count()
        assert clustered.agg(F.sum("v"), F.count("*")).first() == readings.agg(F.sum("v"), F.count("*")).first()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    table.remove_unused(spark)
    sizes = [len_ for len_ in (spark.read.parquet(str(f)).count() for f in files(table)) if len_]
    # The hot portfolio is cut by the second column: no file holds its 200,000 rows.
    assert len(sizes) >= 16 and max(sizes) < 100_000
