"""All six models, built in dependency order."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.config import ModelConfig
from ledgerlane.operators.checks import Watch, require_none, require_not_null, require_unique
from ledgerlane.operators.descent import latest_by_descent
from ledgerlane.operators.latest import latest_row
from ledgerlane.operators.reshape import columns_to_rows
from ledgerlane.plans.distribution import asset_distribution, asset_totals, stock_distribution
from ledgerlane.plans.gains import gains_losses
from ledgerlane.plans.networth import networth, networth_comparison
from ledgerlane.sources.warehouse import read_table, write_model
from ledgerlane.sources.workspace import new_run_folder


@dataclass(frozen=True)
class Staging:
    """The staging tables a run reads."""

    account_data: DataFrame
    networth_historical: DataFrame
    investment_distribution: DataFrame
    assett_class_split: DataFrame
    dates: DataFrame


def check_staging(staging: Staging, config: ModelConfig) -> None:
    """Raise if a table breaks what the models rely on, before anything is built.

    For tables that others load: it reads the stamps of the whole history and
    shuffles its keys. The loader of this package keeps readings unique when it
    loads them, and ``run_models`` watches the rest while it builds.
    """
    stamps = [*config.keys, "datetime_now", "date_now"]
    require_not_null(staging.account_data, stamps)
    require_not_null(staging.networth_historical, stamps)
    # Weekdays and mornings are read off datetime_now, days off date_now: they must be of one day.
    of_two_days = F.col("date_now") != F.to_date("datetime_now")
    require_none(
        staging.account_data.filter(of_two_days).select(stamps), "date_now is not the day of datetime_now"
    )
    require_unique(staging.dates, ["date_value"])
    # Equal readings would be picked at random, and by different models differently.
    tie = [] if config.tie_breaker is None else [config.tie_breaker]
    require_unique(staging.account_data, [*config.keys, "datetime_now", *tie])


def run_models(
    spark: SparkSession,
    staging: Staging,
    config: ModelConfig,
    folder: str,
    views: Collection[str] = ("networth",),
    view_prefix: str | None = None,
    check: bool = True,
    newest: date | None = None,
) -> dict[str, DataFrame]:
    """Build every model, store it below ``folder`` and return it read from there.

    Each model reads the result of the ones before it: the comparison sees this
    run's net worth, and the shared part of the distributions is computed once.
    Written tables also cut the lineage, so a lost executor never recomputes an
    earlier model. Models named in ``views`` are not stored: net worth is a
    projection of its sources, and a second copy of the whole history would
    lose their date partitions. With ``view_prefix`` every model also becomes
    a temporary view.

    ``check`` counts missing stamps and dates of another day than their times
    while the models are written, and raises with examples before any model is
    handed out; a double day in the calendar stops the run at once. That
    readings are unique by portfolio, time and tie breaker is the loader's care.

    ``newest`` is the day of the run. With it the latest snapshots are searched
    from that day back, for the portfolios that hold securities; the account
    data must then be partitioned by ``date_now``. Without it one pass over the
    whole table picks them.
    """
    stamps = [*config.keys, "datetime_now", "date_now"]
    missing = reduce(or_, [F.col(c).isNull() for c in stamps])
    snapshots = Watch(
        staging.account_data,
        {"nulls in required columns": missing,
         "date_now is not the day of datetime_now": F.col("date_now") != F.to_date("datetime_now")},
        stamps,
    )
    past = Watch(staging.networth_historical, {"nulls in required columns": missing}, stamps)
    if check:
        require_unique(staging.dates, ["date_value"])
    built: dict[str, DataFrame] = {}

    def build(name: str, make: Callable[[], DataFrame]) -> None:
        model = make()
        if name not in views:
            write_model(model, f"{folder}/{name}")
            model = read_table(spark, f"{folder}/{name}", model.schema)
        built[name] = model
        if view_prefix is not None:
            model.createOrReplaceTempView(f"{view_prefix}{name}")

    build(
        "networth",
        lambda: networth(staging.networth_historical, staging.account_data, config),
    )
    build(
        "networth_comparison",
        lambda: networth_comparison(
            networth(past.frame, staging.account_data, config) if check else built["networth"],
            config, f"{folder}/networth_daily",
        ),
    )
    account_data = snapshots.frame if check else staging.account_data
    build("gains_losses", lambda: gains_losses(account_data, staging.dates, config))
    if check:
        past.require()
        snapshots.require()

    def latest() -> DataFrame:
        if newest is None:
            return latest_row(staging.account_data, config.keys, "datetime_now", config.tie_breaker)
        return latest_by_descent(
            staging.account_data, staging.investment_distribution, newest, new_run_folder(spark, "descent"),
            config.keys, "datetime_now", config.tie_breaker,
        )

    build(
        "stock_distribution",
        lambda: stock_distribution(staging.investment_distribution, latest(), config),
    )
    build(
        "asset_distribution",
        lambda: asset_distribution(
            built["stock_distribution"], staging.assett_class_split, config,
            salted="stock_distribution" not in views,
        ),
    )
    build("asset_totals", lambda: asset_totals(built["asset_distribution"], config))
    return built


def run_summary(models: dict[str, DataFrame]) -> DataFrame:
    """Row count of every model and total of each of its amounts (long form)."""
    parts = []
    for name, df in models.items():
        amounts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
        totals = df.agg(
            F.count("*").alias("row_count"),
            *[F.sum(a).cast("double").alias(a) for a in amounts],
        )
        parts.append(
            columns_to_rows(totals, ["row_count"], amounts, "column_name", "total").select(
                F.lit(name).alias("model"), "column_name", "row_count", "total"
            )
        )
    return reduce(DataFrame.unionByName, parts)
