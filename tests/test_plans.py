"""Physical plans: what would hurt on a large cluster must not appear."""

from __future__ import annotations

import re
from dataclasses import replace

import pytest

from ledgerlane.queries import QUERIES
from ledgerlane.config import ModelConfig
from ledgerlane.plans.gains import gains_losses
from ledgerlane.plans.networth import daily_networth, networth, networth_comparison
from ledgerlane.session import shuffle_partitions
from ledgerlane.sources import driver_tables as given
from ledgerlane.sources.warehouse import append_snapshots, read_table
from ledgerlane.sources.workspace import new_run_folder

KEYED = [
    "gains_losses",
    "networth",
    "networth_comparison",
    "networth_comparison_ages",
    "stock_distribution_by_portfolio",
    "asset_distribution_by_portfolio",
    "asset_totals_by_portfolio",
    "account_snapshot",
    "account_readings",
    "latest_snapshot",
    "morning_readings",
    "payload_snapshot",
]


def plan_of(df) -> str:
    """The physical plan without the bodies of scalar subqueries."""
    lines, skip = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth > skip:
            continue
        skip = None
        if line.lstrip(" :+-").startswith("Subquery"):
            skip = depth
            continue
        lines.append(line)
    return "\n".join(lines)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in plan


@pytest.mark.parametrize("name", KEYED)
def test_keyed_queries_never_meet_in_one_task(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    # Only the calendar may be sorted in one task.
    plan = re.sub(r"lag\(date_value(.*\n)+?.*Range", "", plan)
    assert "SinglePartition" not in plan


def test_payloads_become_snapshots_without_a_shuffle(spark, sf_dir):
    from ledgerlane.queries import _payloads
    from ledgerlane.sources.payload import payload_snapshot

    plan = plan_of(payload_snapshot(_payloads(spark, sf_dir), given.PAYLOAD_ACCOUNTS))
    assert "Exchange" not in plan
    assert plan.count("from_json") == 1


def test_readings_are_combined_before_every_shuffle(spark, sf_dir):
    events = given.event_account_data(spark, sf_dir)
    plan = plan_of(gains_losses(events, given.event_dates(spark, sf_dir), ModelConfig()))
    assert plan.count("hashpartitioning(portfolio_id") == 2
    assert "SortAggregate" not in plan
    # The filled rows are the top of the plan: nothing moves or sorts them.
    filled = plan[: plan.index("Generate explode")]
    assert "Exchange" not in filled and "Sort" not in filled and "Window" not in filled
    # Their number cannot be foreseen from bytes, so partitions are not merged.
    assert "REPARTITION_BY_NUM" in plan
    for model in (
        daily_networth(given.event_networth(spark, sf_dir), ModelConfig()),
        daily_networth(
            given.event_networth(spark, sf_dir), replace(ModelConfig(), tie_breaker=None)
        ),
    ):
        plan = plan_of(model)
        assert plan.count("hashpartitioning(portfolio_id") == 2 and "SortAggregate" not in plan
        assert re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*partial_max", plan)


def test_totals_scan_each_table_once(spark, sf_dir):
    plan = plan_of(QUERIES["asset_totals_by_portfolio"](spark, sf_dir))
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1
    assert len(re.findall(r"FileScan parquet \[p_partkey", plan)) == 1


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    plan = QUERIES["networth"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
    assert "o_orderpriority" not in plan.split("Physical Plan")[1]


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(10 * 1024**4, 8) > 50_000


def test_comparison_prunes_the_dates_it_does_not_need(spark, sf_dir):
    history = new_run_folder(spark, "history")
    append_snapshots(given.event_account_data(spark, sf_dir), history)
    account_data = read_table(spark, history)
    empty_past = account_data.filter("false").withColumnRenamed("investment", "networth")
    config = replace(ModelConfig(), networth_expr="investment", ages={"week_ago": 7})
    series = networth(empty_past, account_data, config)
    result = networth_comparison(series, config, new_run_folder(spark, "daily"))
    assert "dynamicpruning" in result._jdf.queryExecution().toString()

    twin = given.event_networth(spark, sf_dir)
    expected = networth_comparison(twin, config, new_run_folder(spark, "daily"))
    columns = ["portfolio_id", "networth_now", "networth_week_ago"]
    assert sorted(result.select(columns).collect()) == sorted(expected.select(columns).collect())


def test_hot_day_is_split_between_join_tasks(spark):
    """One portfolio with a third of all readings, all of them on one day."""
    rows = spark.range(300_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 997 + 1 END AS portfolio_id",
        "id AS primary_key",
        "CASE WHEN id % 3 = 0 AND id > 0 THEN TIMESTAMP_NTZ'2024-01-10 00:00:00' "
        "+ make_dt_interval(0, 0, 0, id * 0.28) "
        "ELSE TIMESTAMP_NTZ'2024-01-20 12:00:00' - make_dt_interval(CAST(id % 41 AS INT)) END "
        "AS datetime_stamp",
        "CAST(id AS DECIMAL(18,2)) AS networth",
        "CAST(0 AS DECIMAL(18,2)) AS investment_amount",
    ).selectExpr("*", "CAST(datetime_stamp AS DATE) AS date_stamp")
    config = replace(ModelConfig(), ages={"earlier": 10})
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        result = networth_comparison(rows, config, new_run_folder(spark, "daily"))
        picked = {r["portfolio_id"]: r["networth_earlier"] for r in result.collect()}
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert "skew=true" in plan
    # The newest reading (id 0) is at noon, so is the limit ten days before it.
    assert picked[0] == 154_284


def test_salted_join_shuffles_both_sides_by_salt(spark, sf_dir):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = plan_of(QUERIES["stock_distribution_by_portfolio"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # Direct shuffles on both sides are what lets a hot portfolio be split.
    assert len(re.findall(r"hashpartitioning\(portfolio_id#\d+L, _salt#", plan)) == 2
    assert re.search(r"SortMergeJoin \[portfolio_id#\d+L, _salt#", plan)


def test_latest_row_neither_sorts_nor_reads_unused_columns(spark, sf_dir):
    from ledgerlane.operators.latest import latest_row

    events = given.table(spark, sf_dir, "events").drop("props", "event_type")
    newest = latest_row(events, ["user_id"], "ts", "event_id").select("user_id", "ts")
    plan = plan_of(newest)
    assert "SortAggregate" not in plan and not re.search(r"\bvalue#", plan)
    assert "SortAggregate" not in plan_of(latest_row(events, ["user_id"], "ts", "event_id"))


def skewed(spark, rows: int = 300_000):
    """A third of all rows belong to portfolio 0, and a third to symbol 0."""
    return spark.range(rows).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 9973 + 1 END AS portfolio_id",
        "CASE WHEN id % 3 = 1 THEN 0 ELSE id % 7919 + 1 END AS stock_symbol", "id")


@pytest.mark.parametrize("key, other", [("portfolio_id", "stock_symbol"), ("stock_symbol", "portfolio_id")])
def test_only_the_hot_key_is_salted(spark, key, other):
    from pyspark.sql import functions as F

    from ledgerlane.operators.skew import attach_by_key

    big = skewed(spark)
    few = big.select(key).distinct().filter(F.col(key) % 5 != 1).withColumn("found", F.col(key) * 2)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        joined = attach_by_key(big, few, [key], [other, "id"])
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        wanted = big.join(few, key, "left")
        assert joined.count() == wanted.count() == 300_000
        total = F.sum(F.coalesce("found", F.lit(-1)) * F.col("id"))
        assert joined.agg(total).first() == wanted.agg(total).first()
        # The copied side: one row a key, and the hot key once for each salt.
        right = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate explode" in right
        copies = few.count() + 15
        plan = attach_by_key(big, few, [key], [other, "id"])
        plan.write.format("noop").mode("overwrite").save()
        salted = few.withColumn("hot", F.array_contains(skew_hot(big, key), F.xxhash64(key)))
        assert salted.filter("hot").count() == 1 and few.count() + 15 * salted.filter("hot").count() == copies
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    # Without salting one task would hold a third: 100,000 rows.
    assert max(sizes) < 40_000


def skew_hot(df, key):
    from ledgerlane.operators.skew import hot_keys

    return hot_keys(df, [key])


def test_days_are_filled_in_by_their_number(spark, sf_dir):
    """A dense row looks its day up by place: a date as join key would be hashed once for each of them."""
    plan = plan_of(QUERIES["gains_losses"](spark, sf_dir))
    assert re.search(r"BroadcastHashJoin \[(cast\()?_day#", plan)
    assert not re.search(r"BroadcastHashJoin \[date_value#", plan)


def test_kept_events_bring_their_types_along(spark, tmp_path):
    """The type stands in the event's own row: no join by event, and a repeated id makes no further rows."""
    rows = [(1, "2024-01-02 10:00:00", 5, "view", 2.5)] * 2 + [(None, "2024-01-03 10:00:00", 6, "purchase", 1.0)]
    events = spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string, value double")
    events.withColumn("ts", events["ts"].cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    wide = given.typed_event_data(spark, str(tmp_path))
    assert "Join" not in plan_of(wide)
    assert [(r["primary_key"], r["event_type"]) for r in wide.collect()] == [(1, "view")] * 2
