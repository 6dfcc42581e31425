"""Landed CSV files: write, find, read back, remove."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.sources.versions import Record, delete, matching, move_new

# Folder, name prefix and name format of landed files.
FOLDER = "account-data"
FIND_PREFIX = "m"
NAME_FORMAT = "'mint_'MM_dd_yyyy_HH-mm-ss'.csv'"

# Microseconds survive the round trip through text.
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# The record of landed runs lies outside the landing folder, so that cleaning up keeps it.
RUN_LOG_FOLDER = "runs"
RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("accounts", T.ArrayType(T.StringType())),
    ]
)


def landed_name(ts: Column) -> Column:
    """Path of a file landed at that time, relative to the landing root."""
    return F.concat(F.lit(f"{FOLDER}/"), F.date_format(ts, NAME_FORMAT))


def landed_folder(root: str, run_ts: datetime) -> str:
    return f"{root}/{FOLDER}/{run_ts.strftime('mint_%m_%d_%Y_%H-%M-%S.csv')}"


def run_identity(run_ts: datetime, name: str = "") -> str:
    """Names a run by its full time and, if several share one instant, by a given name."""
    if not re.fullmatch(r"[A-Za-z0-9_-]*", name):
        raise ValueError(f"run name {name!r} has characters other than letters, digits, _ and -")
    stamp = run_ts.strftime("%Y%m%dT%H%M%S%f")
    return f"{stamp}-{name}" if name else stamp


def _write_csv(df: DataFrame, folder: str) -> None:
    writer = df.write.mode("errorifexists").option("header", True)
    writer.option("timestampNTZFormat", CSV_TIMESTAMP).csv(folder)


def write_landed(df: DataFrame, root: str, run_ts: datetime) -> str:
    """Write a batch as CSV with a header below the landing root.

    One folder per second; Spark writes one file per partition into it, so a
    large batch is landed by all executors. A folder that exists is an error:
    it may hold another batch, or be half written. ``land_run`` can be repeated.
    """
    folder = landed_folder(root, run_ts)
    _write_csv(df, folder)
    return folder


def land_file(df: DataFrame, root: str, run_ts: datetime) -> str:
    """Land a batch as one file under exactly the fixed name; returns its path.

    For batches that one task can write. Spark commits the file to a folder that readers skip, and a
    rename puts it in its place: before that nothing is visible, whatever failed. A name that exists is an error.
    """
    spark = df.sparkSession
    path = landed_folder(root, run_ts)
    attempt = f"{root}/_landing-{uuid.uuid4().hex}"
    try:
        _write_csv(df.coalesce(1), attempt)
        (written,) = matching(spark, f"{attempt}/part-*")
        move_new(spark, written, path)
    finally:
        delete(spark, attempt)
    return path


def land_run(
    df: DataFrame,
    root: str,
    run_ts: datetime,
    accounts: Sequence[str],
    name: str = "",
    epoch: int | None = None,
) -> Row:
    """Land a run's batch, then publish it by one row in the record of runs; returns that row.

    Every attempt writes to a folder of its own below the run's landed name.
    What a failed attempt leaves is never published, so nobody reads it.
    ``epoch`` is the record's newest one, if the caller has read it.
    """
    run_id = run_identity(run_ts, name)
    folder = f"{landed_folder(root, run_ts)}/{run_id}.{uuid.uuid4().hex}"
    _write_csv(df, folder)
    columns = F.array(*[F.lit(a) for a in accounts]).cast("array<string>")
    entry = df.sparkSession.range(0, 1, 1, 1).select(
        F.lit(run_id).alias("run_id"), F.lit(folder).alias("folder"), columns.alias("accounts")
    )
    runs = run_record(root)
    runs.append(entry, runs.newest_epoch(df.sparkSession) if epoch is None else epoch)
    return Row(run_id=run_id, folder=folder, accounts=list(accounts))


def run_record(root: str) -> Record:
    return Record(f"{root}/{RUN_LOG_FOLDER}", RUN_LOG)


def landed_runs(spark: SparkSession, root: str) -> DataFrame:
    """The record of runs: one row per published attempt, also of files removed since."""
    return run_record(root).read(spark).select(*RUN_LOG.names)


def fold_runs(spark: SparkSession, root: str) -> None:
    """Rewrite the record of runs as one file; of several attempts of a run one stays."""
    runs = run_record(root)
    once = landed_runs(spark, root).groupBy("run_id").agg(
        F.max_by("folder", "folder").alias("folder"), F.max_by("accounts", "folder").alias("accounts")
    )
    runs.fold(once.select(*RUN_LOG.names), runs.newest_epoch(spark))


def is_landed(spark: SparkSession, root: str, run_ts: datetime, name: str = "") -> bool:
    """Whether that run was published (also if its files were removed since)."""
    runs = landed_runs(spark, root).filter(F.col("run_id") == run_identity(run_ts, name))
    return not runs.isEmpty()


def landed_glob(root: str) -> str:
    return f"{root}/{FOLDER}/{FIND_PREFIX}*"


def latest_landed(spark: SparkSession, root: str) -> str:
    """The last landed file in name order; raises if there is none.

    The names put the month before the year, so across years the last name is
    not the newest file. Incremental loading does not rely on it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load(landed_glob(root)).select("path")
    path = files.agg(F.max("path")).first()[0]
    if path is None:
        raise FileNotFoundError(landed_glob(root))
    return path


def csv_options(by_position: bool) -> dict[str, str]:
    """Reader options. A wrong header is an error unless binding by position."""
    return {
        "header": "true",
        "mode": "FAILFAST",
        "timestampNTZFormat": CSV_TIMESTAMP,
        "enforceSchema": str(by_position).lower(),
    }


def read_landed(
    spark: SparkSession, path: str | list[str], schema: T.StructType, by_position: bool = False
) -> DataFrame:
    """Read landed files with a declared schema.

    ``by_position`` ignores header names and binds fields in schema order, which
    silently swaps balances if the orders differ; by default such a file is
    rejected.
    """
    return spark.read.schema(schema).options(**csv_options(by_position)).csv(path)


def landed_summary(landed: DataFrame) -> DataFrame:
    """Per landed name: its readings and the last of them. ``landed`` was read from files."""
    name = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return landed.groupBy(name.alias("landed")).agg(
        F.count("*").alias("readings"), F.max("datetime_now").alias("last_reading")
    )


def remove_landed(spark: SparkSession, root: str) -> int:
    """Delete all landed batches; returns how many names there were.

    The record of runs stays: a run that is repeated afterwards lands nothing.
    Only loaded batches should be removed, a load that misses files stops.
    """
    found = matching(spark, landed_glob(root))
    for path in found:
        delete(spark, path)
    return len(found)
