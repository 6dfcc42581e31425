"""As-of join: for each (key, instant) the newest reading at or before it, at any list of instants.

Readings and instants of a key meet side by side in the order of time. That is one shuffle of the two, and
fits all keys but hot ones: those with more rows than an average shuffle partition.

For hot keys time is cut into buckets. Inside its own bucket an instant meets single readings; what lies before
the bucket is carried over its border as one row per bucket. Carrying goes up a ladder: FAN buckets make one
of the next level, and a level looks only among the siblings of one parent. So no window, join or task ever
holds a hot key's whole history, however long it is and however hot the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.operators.latest import order_of
from ledgerlane.operators.skew import hot_keys
from ledgerlane.sources.workspace import new_run_folder

# Children of a parent bucket. With buckets of a day, four levels span more days than a DATE can name.
FAN = 64
LEVELS = 4
# Instants without an answer (null, or of a null key) meet no reading; they are dealt over so many windows.
UNANSWERED = 4096


def bucket_of(ts: Column, days: int) -> Column:
    """Number of the bucket of so many days since the year 1: never negative, so the ladder has one top."""
    since = F.date_diff(F.to_date(ts), F.lit("0001-01-01").cast("date"))
    return F.floor(since / F.lit(days)).cast("int")


def as_of(
    readings: DataFrame,
    instants: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    ts: str = "datetime_stamp",
    at: str = "instant",
    tie_breaker: str | None = "primary_key",
    days: int = 1,
) -> DataFrame:
    """Every row of ``instants`` (keys, ``at`` and more) with the ``ts`` and values of its reading.

    The reading is the newest of the key with ``ts <= at``; among equal times the
    greater tie breaker wins. Null where there is none, also for a null instant
    or key. Rows of ``instants`` are kept as they are, repeated ones too.

    Buckets are those of ``ts`` itself, so a date label of another day does no harm. Hot keys are found by a
    pass over the key columns (``hot_keys``: at most as many as shuffle partitions); their rows are stored once.
    """
    keys = list(keys)
    picked = ["_ts", *[f"_v_{v}" for v in values]]
    entry = F.struct(
        order_of(readings, ts, tie_breaker).alias("_order"), F.col(ts).alias("_ts"),
        *[F.col(v).alias(f"_v_{v}") for v in values],
    )
    known = reduce(and_, [F.col(k).isNotNull() for k in keys], F.lit(True))
    columns = [*keys, at, *[c for c in instants.columns if c not in (*keys, at)]]
    rows = (
        readings.filter(F.col(ts).isNotNull() & known)
        .select(*keys, F.col(ts).alias("_ts"), entry.alias("_entry"), F.lit(False).alias("_asked"))
        .unionByName(
            instants.select(
                *keys, F.col(at).alias("_ts"), F.lit(None).alias("_entry"), F.lit(True).alias("_asked"),
                F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in columns]).alias("_instant")),
            allowMissingColumns=True)
    )
    answered = F.col("_ts").isNotNull() & known
    spark = readings.sparkSession
    # Without keys there is one history, and it is as hot as can be.
    hot = spark.range(1).select(hot_keys(rows.filter(answered), keys)).first()[0] if keys else None
    found = []
    if hot is None or hot:
        is_hot = answered if hot is None else answered & F.xxhash64(*keys).isin(hot)
        kept = rows.filter(is_hot)
        folder = new_run_folder(spark, "as-of-hot")
        kept.write.parquet(folder)
        found.append(_by_buckets(spark.read.schema(kept.schema).parquet(folder), keys, picked, days))
        rows = rows.filter(~is_hot)
    # A reading comes before an instant of the same time; of readings of one time the greatest is the last.
    in_time = Window.partitionBy(*keys, "_bucket").orderBy("_ts", "_asked", "_entry")
    up_to = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(UNANSWERED)).cast("int")
    found.append(
        rows.withColumn("_bucket", F.when(answered, F.lit(-1)).otherwise(spread))
        .withColumn("_found", F.last("_entry", ignorenulls=True).over(up_to)).filter("_asked")
        .select("_instant", "_found")
    )
    return reduce(DataFrame.unionByName, found).select(
        "_instant.*", F.col("_found._ts").alias(ts), *[F.col(f"_found._v_{v}").alias(v) for v in values])


def _by_buckets(rows: DataFrame, keys: list[str], picked: list[str], days: int) -> DataFrame:
    """(_instant, _found) of readings and instants of hot keys.

    Readings are combined map-side to one row per key and bucket before they are shuffled for the carry;
    single readings travel only if an instant lies in their bucket.
    """
    rows = rows.withColumn("_bucket", bucket_of(F.col("_ts"), days))
    shaped, instants = rows.filter("NOT _asked"), rows.filter("_asked")

    # What is asked: distinct instants of a key, each in a bucket.
    asked = instants.select(*keys, "_bucket", "_ts").distinct()
    buckets = asked.select(*keys, "_bucket").distinct()

    # Inside the bucket: instants among the bucket's readings, in order of time; a reading at the instant counts.
    own = shaped.join(buckets, [*keys, "_bucket"], "left_semi")
    both = own.select(*keys, "_bucket", "_ts", "_asked", "_entry").unionByName(
        asked.withColumns({"_asked": F.lit(True), "_entry": F.lit(None)}))
    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy("_ts", "_asked", "_entry")
    up_to = in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (
        both.withColumn("_inside", F.last("_entry", ignorenulls=True).over(up_to)).filter("_asked")
        .select(*keys, "_bucket", "_ts", "_inside")
    )

    # Across buckets: of each bucket its newest reading, carried to later buckets.
    level = shaped.select(*keys, "_bucket", "_entry.*").groupBy(*keys, "_bucket").agg(
        F.max("_order").alias("_order"), *[F.max_by(c, "_order").alias(c) for c in picked])
    carried = _carried(level, buckets, keys, picked, LEVELS)
    found = inside.join(carried, [*keys, "_bucket"], "left").select(
        *keys, "_ts", F.coalesce("_inside", "_before").alias("_found"))
    return instants.join(found, [*keys, "_ts"], "left").select("_instant", "_found")


def _carried(level: DataFrame, wanted: DataFrame, keys: list[str], picked: list[str], levels: int) -> DataFrame:
    """For each wanted (key, bucket) the newest reading of any earlier bucket, as `_before`.

    `level` has one row per key and bucket. Siblings are looked through first; if none of the earlier
    ones holds a reading, the parent's earlier siblings are, and so on up the ladder.
    """
    parent = F.floor(F.col("_bucket") / F.lit(FAN)).cast("int")
    # With the order, as above: both uses of a level then share one shuffle.
    entry = F.struct("_order", *picked)
    # Readings and wanted buckets side by side: at most FAN rows of each kind under one parent.
    both = (
        level.select(*keys, "_bucket", entry.alias("_entry"), F.lit(False).alias("_wanted"))
        .unionByName(wanted.select(*keys, "_bucket", F.lit(None).alias("_entry"), F.lit(True).alias("_wanted")),
                     allowMissingColumns=True)
        .withColumn("_parent", parent)
    )
    # Earlier buckets alone: a bucket's own reading stands beside its wanted row.
    siblings = Window.partitionBy(*keys, "_parent").orderBy("_bucket").rangeBetween(Window.unboundedPreceding, -1)
    near = (
        both.withColumn("_near", F.last("_entry", ignorenulls=True).over(siblings)).filter("_wanted")
        .select(*keys, "_bucket", "_parent", "_near")
    )
    if levels == 1:
        return near.select(*keys, "_bucket", F.col("_near").alias("_before"))
    above = level.withColumn("_bucket", parent).groupBy(*keys, "_bucket").agg(
        F.max("_order").alias("_order"), *[F.max_by(c, "_order").alias(c) for c in picked])
    open_parents = near.filter(F.col("_near").isNull()).select(*keys, F.col("_parent").alias("_bucket")).distinct()
    far = _carried(above, open_parents, keys, picked, levels - 1).withColumnsRenamed(
        {"_bucket": "_parent", "_before": "_far"})
    return near.join(far, [*keys, "_parent"], "left").select(
        *keys, "_bucket", F.coalesce("_near", "_far").alias("_before"))
