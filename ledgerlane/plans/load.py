"""Extract and load: payloads to landed snapshots to the history table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.config import DEFAULT_RULES, BalanceRule
from ledgerlane.operators.checks import LoadError, require_none
from ledgerlane.schemas import PORTFOLIO, snapshot_schema
from ledgerlane.sources.landing import land_run, run_identity, run_record
from ledgerlane.sources.payload import (
    capture_columns,
    payload_snapshot,
    payload_snapshot_by_map,
    stopped_at_failures,
)
from ledgerlane.sources.versions import Entry
from ledgerlane.sources.warehouse import history_table, schema_of_accounts
from ledgerlane.streaming.incremental import put_landed


def run_load(
    spark: SparkSession,
    payloads: DataFrame,
    columns: Mapping[str, str] | Sequence[str],
    root: str,
    run_ts: datetime,
    rules: Iterable[BalanceRule] = DEFAULT_RULES,
    name: str = "",
    account_map: DataFrame | None = None,
) -> DataFrame:
    """One run: shape, check, land, load. Returns the history so far.

    ``payloads`` has the portfolio, the payload text and, if captures differ in
    time, ``datetime_now``; otherwise all are stamped with the run's time.
    ``columns`` maps column names to account ids that all portfolios share.
    With ``account_map`` (rows of portfolio, column_name, account_id) each
    portfolio has its own ids, and ``columns`` names the table's columns.

    Below ``root`` lie the landed files, the record of landed runs, the history
    and the loader's checkpoint. A run is named by its time, to the
    microsecond, and ``name``: batches of one instant need different names, and
    repeating a run lands nothing again. A run that fails before it is
    published leaves the history as it was; one that fails later is completed
    by the next. Two payloads of one portfolio and instant stop it, in the
    batch or with what the history holds of the batch's days.
    """
    # What is published is loaded first, so the history's log says what was landed.
    runs, epoch = run_record(root).rows(spark)
    log = put_landed(spark, root, runs, history_table(root).entries(spark))
    if "datetime_now" in payloads.columns:
        stamps = ["datetime_now", F.to_date("datetime_now").alias("date_now")]
    else:
        stamps = capture_columns(run_ts)
    stamped = payloads.select(PORTFOLIO, *stamps, "payload")
    if run_identity(run_ts, name) not in history_table(root).names(log):
        require_new_readings(stamped, root, log)
        if account_map is None:
            wide = payload_snapshot(stamped, columns, rules)
        else:
            wide = payload_snapshot_by_map(stamped, account_map, list(columns), rules)
        try:
            runs.append(land_run(stopped_at_failures(wide), root, run_ts, list(columns), name, epoch))
        except PySparkException as error:
            if "USER_RAISED_EXCEPTION" in str(error):
                raise LoadError(str(error)) from error
            raise
        log = put_landed(spark, root, runs[-1:], log)
    schema = schema_of_accounts(r["accounts"] for r in sorted(runs, key=lambda r: r["run_id"]))
    return history_table(root).read(spark, schema, log)


def require_new_readings(stamped: DataFrame, root: str, log: list[Entry]) -> None:
    """Raise if a portfolio and instant of the batch stands there twice, or is in the history already.

    Of the history only the stamps on the batch's days are read: equal instants
    are of equal days.
    """
    spark = stamped.sparkSession
    stamps = [PORTFOLIO, "datetime_now"]
    own = stamped.select(*stamps, "date_now", F.lit(True).alias("new"))
    table = history_table(root)
    held = table.read(spark, snapshot_schema([]), log) if table.live(log) else None
    if held is not None:
        # A DATE column has few distinct values, so they may be broadcast.
        days = own.select("date_now").distinct()
        held = held.join(F.broadcast(days), "date_now", "left_semi")
        own = own.unionByName(held.select(*stamps, "date_now", F.lit(False).alias("new")))
    twice = own.groupBy(*stamps).agg(F.count("*").alias("rows"), F.bool_or("new").alias("new"))
    require_none(
        twice.filter((F.col("rows") > 1) & F.col("new")).drop("new"), f"duplicate {', '.join(stamps)}"
    )
