"""Contiguous shards of near equal size, from global byte prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.llm.common import stored

ORDER = ("doc_id", "text_crc32", "size")


def shard_by_bytes(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Put every row of (doc_id, text) into one of `shards` contiguous ranges of doc_id.

    A row's size is the UTF-8 length of its text plus 1; a null text has size 1
    and the CRC of no bytes. Rows are laid end to end in the order doc_id (null
    first), CRC, size, and a row belongs to the shard that holds its middle byte
    when the whole is cut at equal targets. So a shard differs from the target by
    less than one row on either end.

    Only (doc_id, size, CRC) is shuffled. Equal rows travel as one counted row, so
    a much repeated row is no hot key. Range partitions are summed one by one; the
    running total over those sums (one row for each partition) is the only
    ordered step outside a partition, and a row's offset is its partition's offset
    plus a running sum inside it. Equal rows are interchangeable. An empty table
    gives no rows; other columns are ignored.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    runs = (
        docs.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"),
                    F.crc32(body).alias("text_crc32"))
        .groupBy(*ORDER).agg(F.count(F.lit(1)).alias("copies"))
    )
    ranged = stored(
        runs.repartitionByRange(*ORDER).withColumn("part", F.spark_partition_id()), "shards"
    )

    weight = F.col("size") * F.col("copies")
    totals = ranged.groupBy("part").agg(
        F.sum(weight).alias("part_bytes"), F.sum("copies").alias("part_rows")
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    totals = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes").over(everything).alias("all_bytes"),
    )

    inside = (
        Window.partitionBy("part").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        ranged.withColumn("bytes_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .withColumn("rows_inside", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
        # One row for each partition of the range shuffle.
        .join(F.broadcast(totals), "part")
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("offset",
                    F.col("bytes_before") + F.col("bytes_inside") + F.col("copy") * F.col("size"))
        .withColumn("row", F.col("rows_before") + F.col("rows_inside") + F.col("copy"))
        .withColumn("shard", F.expr(
            f"cast(least({shards - 1}, ((2 * offset + size) * {shards}) div (2 * all_bytes)) as int)"
        ))
    )
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first_row")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
