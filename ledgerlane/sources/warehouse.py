"""Warehouse tables as partitioned parquet."""

from __future__ import annotations

from collections.abc import Collection, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions.clock import micros_since_epoch
from ledgerlane.operators.checks import required
from ledgerlane.schemas import PORTFOLIO, snapshot_schema
from ledgerlane.sources.landing import fold_runs, landed_runs
from ledgerlane.sources.versions import DatedTable, Entry

SURROGATE = "primary_key"
NEVER_NULL = (PORTFOLIO, "datetime_now", "date_now")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def import_columns(table: DataFrame) -> list[str]:
    """Columns a load supplies: all but the surrogate key. Reads no rows."""
    return table.drop(SURROGATE).columns


def with_surrogate(snapshots: DataFrame) -> DataFrame:
    """Key rows by capture time in microseconds.

    Snapshots are unique per portfolio and capture time, so (portfolio, key) is
    unique, and a repeated load gives the same keys.
    """
    if SURROGATE in snapshots.columns:
        return snapshots
    key = micros_since_epoch(F.col("datetime_now")).cast("bigint")
    return snapshots.withColumn(SURROGATE, key)


def with_required(snapshots: DataFrame) -> DataFrame:
    """Stop the load at a snapshot without portfolio or capture time."""
    return snapshots.select(
        *[required(c) if c in NEVER_NULL else F.col(c) for c in snapshots.columns]
    )


def append_snapshots(snapshots: DataFrame, path: str) -> None:
    """Append to a history partitioned by date.

    A history is fed either by this or by the incremental loader: readers of
    the loader's table see only the files in its own commit log.
    The rebalance hint lets adaptive execution give a busy date several files
    and put quiet dates together, without a fixed partition count.
    """
    (
        with_surrogate(with_required(snapshots))
        .hint("rebalance", "date_now")
        .write.mode("append")
        .partitionBy("date_now")
        .parquet(path)
    )


def history_table(root: str) -> DatedTable:
    return DatedTable(f"{root}/history")


def put_runs(
    snapshots: DataFrame,
    path: str,
    names: Collection[str] | None = None,
    entries: list[Entry] | None = None,
) -> list[Entry]:
    """Put runs (column ``run_id``) into the history at once; returns its log.

    The history's log names the runs it holds, so a run that is put again adds
    nothing. ``names`` lists the runs, ``entries`` is the log, if the caller knows them.
    """
    spark = snapshots.sparkSession
    table = DatedTable(path)
    entries = table.entries(spark) if entries is None else entries
    if names is None:
        names = [r["run_id"] for r in snapshots.select("run_id").distinct().collect()]
    new = sorted(set(names) - table.names(entries))
    if not new:
        return entries
    if len(new) < len(set(names)):
        snapshots = snapshots.filter(F.col("run_id").isin(new))
    change = table.write(with_surrogate(with_required(snapshots.drop("run_id"))))
    return [*entries, table.publish(spark, entries, change, names=new)]


def history_schema(runs: DataFrame) -> T.StructType:
    """Schema of a history fed by these runs: every account any of them had.

    Accounts stand in the order in which runs brought them. One row per
    distinct account list reaches the driver, not one per run.
    """
    lists = runs.groupBy("accounts").agg(F.min("run_id").alias("first")).orderBy("first").collect()
    return schema_of_accounts(row["accounts"] for row in lists)


def schema_of_accounts(lists: Iterable[Iterable[str]]) -> T.StructType:
    """Schema of a history whose runs had these accounts, in the order of the runs."""
    schema = snapshot_schema(dict.fromkeys(a for accounts in lists for a in accounts))
    return T.StructType([*schema.fields[:3], T.StructField(SURROGATE, T.LongType()), *schema.fields[3:]])


def read_history(spark: SparkSession, root: str, entries: list[Entry] | None = None) -> DataFrame:
    """The history of all loaded runs, by its declared schema.

    An account that a run did not have yet, or no longer had, is null there.
    What is loaded or compacted later does not show in it.
    """
    return history_table(root).read(spark, history_schema(landed_runs(spark, root)), entries)


def compact_history(spark: SparkSession, root: str, closed_before: date, packs_of_a_day: int = 8) -> None:
    """Keep the number of files in bounds: closed days into sized files, both records into one file each.

    To be called between loads. Files of closed days are clustered by portfolio and time. A day that is loaded in few packs is left alone. Nothing
    is deleted; ``history_table(root).remove_unused`` does that when old readers are gone.
    """
    table = history_table(root)
    table.compact(
        spark, history_schema(landed_runs(spark, root)), closed_before, packs_of_a_day, (PORTFOLIO, "datetime_now")
    )
    table.fold_log(spark)
    fold_runs(spark, root)


def write_model(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
