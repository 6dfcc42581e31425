"""Gains and comparison kept up to date by change.

Between runs stand mergeable states: one row per portfolio and day with the day's first and last
morning reading and its newest one. A run takes the newly loaded runs from the history's log, merges
their rows into the states of the days they have, and recomputes what depends on these days: gains of
the days themselves and of their neighbours, and the comparison by going back from each portfolio's
newest day. Every step has a log of its own, so a run that failed anywhere is completed by the next.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.config import ModelConfig
from ledgerlane.functions.clock import days_before, not_later_than
from ledgerlane.operators.descent import latest_by_descent
from ledgerlane.operators.latest import order_of, pick_latest
from ledgerlane.operators.spine import trading_days
from ledgerlane.plans.gains import taken_on_trading_days
from ledgerlane.plans.networth import AMOUNTS, networth
from ledgerlane.sources.versions import DatedTable, Entry
from ledgerlane.sources.warehouse import read_table, write_model
from ledgerlane.sources.workspace import new_run_folder

DAY = "date_now"
MODELS = ("gains_losses", "networth_comparison")


def day_states(readings: DataFrame, config: ModelConfig) -> DataFrame:
    """One row per portfolio and day. Readings have a value for gains, amounts, and whether they are of a morning."""
    order = order_of(readings, "datetime_now", config.tie_breaker)
    shaped = readings.withColumn("order", order).withColumn("early", F.when(F.col("_morning"), F.col("order")))
    return shaped.groupBy(*config.keys, DAY).agg(
        F.min("early").alias("first_order"),
        F.min(F.when(F.col("_morning"), F.col("datetime_now"))).alias("first_time"),
        F.min_by("_value", "early").alias("first_value"),
        F.max("early").alias("last_order"),
        F.max(F.when(F.col("_morning"), F.col("datetime_now"))).alias("last_time"),
        F.max_by("_value", "early").alias("last_value"),
        F.max("order").alias("newest_order"),
        F.max("datetime_now").alias("datetime_stamp"),
        F.bool_or("_captured").alias("captured"),
        *[c.alias(a) for a, c in zip(AMOUNTS, pick_latest(AMOUNTS, "order"), strict=True)],
    )


def merged(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of the same portfolio and day as one."""
    return states.groupBy(*keys, DAY).agg(
        F.min("first_order").alias("first_order"),
        F.min("first_time").alias("first_time"),
        F.min_by("first_value", "first_order").alias("first_value"),
        F.max("last_order").alias("last_order"),
        F.max("last_time").alias("last_time"),
        F.max_by("last_value", "last_order").alias("last_value"),
        F.max("newest_order").alias("newest_order"),
        F.max("datetime_stamp").alias("datetime_stamp"),
        F.bool_or("captured").alias("captured"),
        *[c.alias(a) for a, c in zip(AMOUNTS, pick_latest(AMOUNTS, "newest_order"), strict=True)],
    )


def _snapshot_readings(account_data: DataFrame, config: ModelConfig) -> DataFrame:
    amounts = zip(AMOUNTS, (config.networth_expr, config.investment_expr), strict=True)
    return account_data.select(
        *_carried(config), "datetime_now", DAY,
        F.expr(config.investment_expr).alias("_value"),
        not_later_than(F.col("datetime_now"), config.cutoff).alias("_morning"), F.lit(True).alias("_captured"),
        *[F.expr(f"CAST(({text}) AS DECIMAL(18,2))").alias(name) for name, text in amounts],
    )


def _past_readings(networth_historical: DataFrame, config: ModelConfig, value: T.DataType) -> DataFrame:
    """Historical net worth has no part in gains."""
    amounts = zip(AMOUNTS, ("networth", config.pre_investment_expr), strict=True)
    return networth_historical.select(
        *_carried(config), "datetime_now", DAY, F.lit(None).cast(value).alias("_value"), F.lit(False).alias("_morning"),
        F.lit(False).alias("_captured"),
        *[F.expr(f"CAST(({text}) AS DECIMAL(18,2))").alias(name) for name, text in amounts],
    )


def _carried(config: ModelConfig) -> list[str]:
    return [*config.keys] + ([] if config.tie_breaker is None else [config.tie_breaker])


@dataclass(frozen=True)
class Upkeep:
    """What is kept, and where.

    ``history`` is the dated table the loader feeds, ``schema`` that of its rows; ``networth_historical``
    never changes. The models lie below ``folder``. Dates must be the days of their timestamps.
    """

    spark: SparkSession
    history: DatedTable
    schema: T.StructType
    networth_historical: DataFrame
    dates: DataFrame
    config: ModelConfig
    folder: str

    @property
    def states(self) -> DatedTable:
        return DatedTable(f"{self.folder}/states")

    @property
    def gains(self) -> DatedTable:
        return DatedTable(f"{self.folder}/gains_losses", "date_value")

    def run(self, models: Collection[str] = MODELS) -> dict[str, DataFrame]:
        """Bring models up to date with the history; returns them. Each catches up by itself."""
        if not self.config.keys:
            raise ValueError("models are kept up to date per portfolio")
        loaded = self.history.entries(self.spark)
        states = self.absorb(loaded)
        built = {}
        if "gains_losses" in models:
            built["gains_losses"] = self.refresh_gains(states)
        if "networth_comparison" in models:
            built["networth_comparison"] = self.refresh_comparison(states, loaded)
        return built

    # States

    def absorb(self, loaded: list[Entry]) -> list[Entry]:
        """Merge the runs that were loaded since into the states of their days; returns the states' log."""
        spark, table = self.spark, self.states
        entries = table.entries(spark)
        new = self.history.names(loaded) - table.names(entries)
        if entries and not new:
            return entries
        live = self.history.live(loaded)
        brought = [e for e in loaded if new.intersection(e.names)]
        whole = all(any(e is o for o in live[day]) for e in brought for day in e.days)
        named = {name for e in brought if e.pack for name in e.names}
        by_change = bool(entries) and whole and new <= named
        if by_change:
            # The log knows the days of new runs, and their packs hold nothing else.
            rows = self.history.read(spark, self.schema, loaded, only={e.pack for e in brought})
            days = sorted({day for e in brought for day in e.days})
        else:
            # The first run, or runs that were compacted with others before they were taken up.
            rows = self.history.read(spark, self.schema, loaded)
            days = sorted(live)
        readings = _snapshot_readings(rows, self.config)
        if not by_change:
            value = readings.schema["_value"].dataType
            readings = readings.unionByName(_past_readings(self.networth_historical, self.config, value))
        fresh = day_states(readings, self.config)
        if by_change:
            fresh = merged(fresh.unionByName(table.read(spark, fresh.schema, entries, days)), self.config.keys)
        change = table.write(fresh)
        version = entries[-1].version if entries else 0
        replaced = days if by_change else sorted({*days, *table.live(entries)})
        table.publish(spark, entries, change, new, base=version, replaced=replaced)
        return table.entries(spark)

    def _state_schema(self) -> T.StructType:
        nothing = _snapshot_readings(self.spark.createDataFrame([], self.schema), self.config)
        return day_states(nothing, self.config).schema

    # Gains

    def refresh_gains(self, states: list[Entry]) -> DataFrame:
        """Recompute the trading days that states changed for, and those the calendar gained."""
        spark, table, keys = self.spark, self.gains, list(self.config.keys)
        entries = table.entries(spark)
        done = max((int(name) for name in table.names(entries)), default=0)
        # One row per trading day: a DATE column has at most 3.7 million values.
        calendar = sorted(r["date_value"] for r in trading_days(self.dates).collect())
        held = set(table.live(entries))
        changed = {day for e in states if e.version > done for day in e.days}
        previous = dict(zip(calendar[1:], calendar, strict=False))
        one = timedelta(days=1)

        def needed(day: date) -> dict[str, date]:
            of = {"pre": day, "post": day + one}
            if day in previous:
                of |= {"previous_pre": previous[day], "previous_post": previous[day] + one}
            return of

        due = {day: needed(day) for day in calendar}
        due = {day: of for day, of in due.items() if day not in held or changed.intersection(of.values())}
        gone = held.difference(calendar)
        schema = self._state_schema()
        if due or gone:
            touched = table.live(states)
            sources = {s for of in due.values() for s in of.values()}
            known = self._portfolios(table, entries, schema)
            seen = self.states.read(spark, schema, states, sorted(changed.intersection(touched)))
            new = seen.filter("captured").select(*keys).distinct().join(known, keys, "left_anti")
            new.write.parquet(path := new_run_folder(spark, "new-portfolios"))
            new = read_table(spark, path, new.schema)
            cells = self._cells(known.unionByName(new), due)
            roles = spark.createDataFrame(
                [(s, day, role) for day, of in due.items() for role, s in of.items()],
                f"{DAY} date, date_value date, role string",
            )
            own = taken_on_trading_days(self.states.read(spark, schema, states, sorted(sources.intersection(touched))))
            parts = own.join(F.broadcast(roles), DAY).select(
                *keys, "date_value", "role",
                F.when(F.col("role").isin("pre", "previous_pre"), F.col("last_value"))
                .otherwise(F.col("first_value")).alias("value"),
            )
            change = table.write(_as_gains(cells.unionByName(parts, allowMissingColumns=True), keys))
            # Portfolios that were not there before stand on all other days, too, with nothing.
            others = {day: {} for day in calendar if day not in due}
            appended = None
            if others and not new.isEmpty():
                empty = self._cells(new, others).withColumn("value", F.lit(None).cast(schema["last_value"].dataType))
                appended = table.write(_as_gains(empty.withColumn("role", F.lit("pre")), keys))
            version = entries[-1].version if entries else 0
            table.publish(spark, entries, change, [str(states[-1].version)], version, [*due, *gone], appended)
        value = schema["last_value"].dataType
        return table.read(spark, _as_gains(self._no_parts(keys, value), keys).schema)

    def _no_parts(self, keys: list[str], value: T.DataType) -> DataFrame:
        fields = [f for f in self.schema.fields if f.name in keys]
        fields += [T.StructField("date_value", T.DateType()), T.StructField("role", T.StringType())]
        return self.spark.createDataFrame([], T.StructType([*fields, T.StructField("value", value)]))

    def _portfolios(self, table: DatedTable, entries: list[Entry], schema: T.StructType) -> DataFrame:
        """Portfolios that have rows already: every day holds all of them."""
        keys = list(self.config.keys)
        own = T.StructType([f for f in schema.fields if f.name in keys])
        live = table.live(entries)
        return table.read(self.spark, own, entries, [min(live)] if live else [])

    def _cells(self, portfolios: DataFrame, days: dict[date, dict]) -> DataFrame:
        """Every portfolio on every one of the days, by a list that each row carries."""
        wanted = self.spark.createDataFrame([(day,) for day in days], "date_value date")
        ends = F.sequence(F.lit(min(days)), F.lit(max(days))) if days else F.array().cast("array<date>")
        return portfolios.withColumn("date_value", F.explode(ends)).join(F.broadcast(wanted), "date_value", "left_semi")

    # Comparison

    def refresh_comparison(self, states: list[Entry], loaded: list[Entry]) -> DataFrame:
        """Each portfolio's newest reading and the newest ones at the ages, by going back from the newest day."""
        spark, keys, config = self.spark, list(self.config.keys), self.config
        schema = self._state_schema()
        rows = self.states.read(spark, schema, states)
        folder = new_run_folder(spark, "upkeep")
        live = self.states.live(states)
        path = f"{self.folder}/networth_comparison"
        picked = [*keys, "datetime_stamp", *AMOUNTS]
        if live:
            everyone = self._everyone(rows, keys, folder)
            newest = latest_by_descent(
                rows, everyone, max(live), f"{folder}/now", keys, "datetime_stamp", None).select(*picked)
        else:
            newest = rows.select(*picked)
        result = newest.select(*keys, *[F.col(a).alias(f"{a}_now") for a in AMOUNTS])
        for name, days in config.ages.items():
            limits = newest.select(*keys, days_before(F.col("datetime_stamp"), days).alias("limit"))
            limits = limits.withColumn("limit_day", F.to_date("limit"))
            aged = self._at(limits, rows, loaded, keys, f"{folder}/{name}") if live else newest
            result = result.join(
                aged.select(*keys, *[F.col(a).alias(f"{a}_{name}") for a in AMOUNTS]), keys, "left")
        columns = [f"{a}_{name}" for a in AMOUNTS for name in ("now", *config.ages)]
        write_model(result.select(*keys, *columns), path)
        return read_table(spark, path, result.select(*keys, *columns).schema)

    def _everyone(self, rows: DataFrame, keys: list[str], folder: str) -> DataFrame:
        rows.select(*keys).distinct().write.parquet(f"{folder}/everyone")
        return read_table(self.spark, f"{folder}/everyone", T.StructType([rows.schema[k] for k in keys]))

    def _at(self, limits: DataFrame, rows: DataFrame, loaded: list[Entry], keys: list[str], folder: str) -> DataFrame:
        """Each portfolio's newest reading up to its limit.

        Of the limit's own day single readings decide, of earlier days the states.
        """
        spark = self.spark
        limits.write.parquet(f"{folder}-limits")
        limits = read_table(spark, f"{folder}-limits", limits.schema)
        # Distinct days, few in number: portfolios of one load share them.
        days = sorted(r[0] for r in limits.select("limit_day").distinct().collect() if r[0] is not None)
        on_day = networth(
            self.networth_historical.filter(F.col(DAY).isin(days)),
            self.history.read(spark, self.schema, loaded, days), self.config,
        )
        order = order_of(on_day, "datetime_stamp", self.config.tie_breaker)
        same_day = (
            on_day.withColumn("order", order).join(limits, keys)
            .filter((F.col("date_stamp") == F.col("limit_day")) & (F.col("datetime_stamp") <= F.col("limit")))
            .groupBy(*keys).agg(
                F.max("datetime_stamp").alias("datetime_stamp"),
                *[c.alias(a) for a, c in zip(AMOUNTS, pick_latest(AMOUNTS, "order"), strict=True)])
        )
        same_day.write.parquet(f"{folder}-same-day")
        same_day = read_table(spark, f"{folder}-same-day", same_day.schema)
        if not days:
            return same_day
        earlier = latest_by_descent(
            rows, limits.join(same_day, keys, "left_anti"), max(days) - timedelta(days=1), f"{folder}-earlier", keys,
            "datetime_stamp", None, before="limit_day")
        return same_day.unionByName(earlier.select(*same_day.columns))


def _as_gains(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of (portfolio, day, role, value) as the columns of gains."""

    def of(role: str) -> Column:
        return F.max(F.when(F.col("role") == role, F.col("value")))

    cells = parts.groupBy(*keys, "date_value").agg(
        of("pre").alias("pre_investment"), of("post").alias("post_investment"),
        (of("post") - of("pre")).alias("gains_losses"),
        (of("previous_post") - of("previous_pre")).alias("previous_day_gains"),
    )
    return cells.select(
        *keys, "date_value", "pre_investment", "post_investment", "gains_losses", "previous_day_gains")
