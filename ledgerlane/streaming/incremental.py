"""Load newly landed files exactly once."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlane.schemas import snapshot_schema
from ledgerlane.sources.landing import csv_options, landed_glob, read_landed, run_record
from ledgerlane.sources.versions import Entry
from ledgerlane.sources.warehouse import history_table, put_runs, with_required, with_surrogate

# A restored or copied backlog may be any age; the checkpoint alone says what was loaded.
ANY_AGE = "36500d"


def landed_stream(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    by_position: bool = False,
    clean: str = "off",
    archive: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Stream of landed files. ``clean`` is off, archive or delete: what happens
    to a file once it has been loaded."""
    reader = spark.readStream.schema(schema).options(**csv_options(by_position))
    reader = reader.option("cleanSource", clean).option("maxFileAge", ANY_AGE)
    if archive is not None:
        reader = reader.option("sourceArchiveDir", archive)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(landed_glob(root))


def load_new_files(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append everything not loaded yet, then stop.

    For files that others land. They must appear whole, that is be renamed into
    place; runs of this package are loaded from their record instead, below.
    The checkpoint remembers the files, and the file sink's commit log makes a
    repeated batch replace itself, so a rerun or a restart after a lost
    executor adds nothing twice. Stateless: nothing is shuffled or kept.
    """
    query = (
        with_surrogate(with_required(stream))
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date_now")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def load_landed_runs(spark: SparkSession, root: str) -> list[Entry]:
    """Put every published run that is not in the history yet into it; returns the history's log."""
    runs, _ = run_record(root).rows(spark)
    return put_landed(spark, root, runs, history_table(root).entries(spark))


def put_landed(spark: SparkSession, root: str, runs: Iterable[Row], entries: list[Entry]) -> list[Entry]:
    """Put those of the published runs into the history that its log does not name; returns the log.

    What is new is the record of runs less the names in the history's log, so
    neither a crash at any point nor a lost checkpoint loses or doubles a row:
    a run's rows and its name become visible together. The record has one
    row per run, whatever the size of the runs.
    """
    table = history_table(root)
    names = table.names(entries)
    # Attempts of one run hold the same rows: one of them is loaded.
    new = {r["run_id"]: (tuple(r["accounts"]), r["folder"]) for r in runs if r["run_id"] not in names}
    by_accounts: dict[tuple[str, ...], dict[str, str]] = defaultdict(dict)
    for run_id, (accounts, folder) in new.items():
        by_accounts[accounts][run_id] = folder
    for accounts, folders in by_accounts.items():
        landed = read_landed(spark, list(folders.values()), snapshot_schema(accounts))
        attempt = F.element_at(F.split("_metadata.file_path", "/"), -2)
        run_id = F.substring_index(attempt, ".", 1)
        entries = put_runs(landed.withColumn("run_id", run_id), table.path, list(folders), entries)
    return entries
