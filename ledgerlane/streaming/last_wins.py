"""The last report of a reading wins, also when it comes in a later micro-batch or after a restart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlane.functions.clock import micros_since_epoch
from ledgerlane.schemas import PORTFOLIO
from ledgerlane.sources.versions import DatedTable
from ledgerlane.sources.workspace import new_run_folder

# Reports of one reading that come further apart than this are not compared any more.
PATIENCE = "2 days"


def last_reports(
    stream: DataFrame,
    arrival: str,
    keys: Sequence[str] = (PORTFOLIO, "datetime_now"),
    event_time: str = "datetime_now",
    patience: str = PATIENCE,
) -> DataFrame:
    """Each reading as its report of greatest ``arrival`` has it.

    Keyed state holds one report per reading until the watermark has passed its time by ``patience``;
    then the state is dropped. The aggregation combines a batch's reports before they meet the state,
    so a reading that is reported a million times at once is one row of each task.
    """
    rest = [c for c in stream.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.col(arrival))
    # Watermarks need a timestamp with a zone: the wall clock is read as if it were UTC.
    clock = F.timestamp_micros(micros_since_epoch(F.col(event_time)).cast("bigint"))
    return (
        stream.withColumn("_clock", clock).withWatermark("_clock", patience)
        .groupBy(*keys, "_clock").agg(last.alias("last"))
        .select(*keys, "last.*").select(*stream.columns)
    )


def upsert(batch: DataFrame, table: DatedTable, name: str, keys: Sequence[str], arrival: str) -> None:
    """Put rows into a dated table, in place of those with the same keys; a batch put again changes nothing.

    Only the days of the batch are read and replaced, and readers see all of the change at once. A
    row that the table has from a later arrival stays.
    """
    spark = batch.sparkSession
    entries = table.entries(spark)
    if name in table.names(entries):
        return
    schema = T.StructType(batch.schema.fields)
    # Distinct days of a batch: few, and a DATE column has no more than 3.7 million.
    days = sorted(r[0] for r in batch.select(table.day).distinct().collect())
    held = table.read(spark, schema, entries, days)
    rest = [c for c in schema.names if c not in keys]
    merged = (
        held.unionByName(batch).groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.col(arrival)).alias("last"))
        .select(*keys, "last.*").select(*schema.names)
    )
    base = entries[-1].version if entries else 0
    table.publish(spark, entries, table.write(merged), [name], base, days)


def load_last_reports(
    stream: DataFrame,
    arrival: str,
    table: DatedTable,
    checkpoint: str,
    keys: Sequence[str] = (PORTFOLIO, "datetime_now"),
    patience: str = PATIENCE,
) -> StreamingQuery:
    """Bring everything that has come since into the table, then stop.

    Update mode hands on the readings that changed in a micro-batch. The batch's number names its change in
    the table's log, so a batch that is repeated after a failure is put once.
    """

    def put(batch: DataFrame, number: int) -> None:
        # The batch is read three times; written down, it is computed once and survives lost executors.
        folder = new_run_folder(batch.sparkSession, "reports")
        batch.write.parquet(folder)
        changed = batch.sparkSession.read.schema(batch.schema).parquet(folder)
        if not changed.isEmpty():
            upsert(changed, table, f"{checkpoint}#{number}", keys, arrival)

    query = (
        last_reports(stream, arrival, keys, patience=patience)
        .writeStream.foreachBatch(put)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
