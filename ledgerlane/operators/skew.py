"""Joining a big table to a smaller one when a key may be very hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 16

# Keys a sketch follows, for each key that may be hot: its error is then well below what makes a key hot.
TRACKED_PER_HOT_KEY = 16
TRACKED_MOST = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str]) -> Column:
    """Hashes of the keys that hold more rows than an average shuffle partition, as one array.

    Every task sketches its own rows (frequent items, of fixed size whatever the
    data), the sketches are merged, and at most as many keys as there are shuffle
    partitions come out: more cannot exceed the average. It is a scalar subquery of
    the query that uses it: nothing reaches the driver's program, and its pass reads
    the key columns alone. The sketch may add a key that is nearly hot; it loses none.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(TRACKED_MOST, max(1024, TRACKED_PER_HOT_KEY * width))
    seen = df.select(F.xxhash64(*keys).alias("key")).agg(
        F.expr(f"approx_top_k(key, {min(width, tracked)}, {tracked})").alias("top"), F.count(F.lit(1)).alias("rows")
    )
    hot = F.expr(f"transform(filter(top, x -> x.count * {width} > rows), x -> x.item)")
    return F.coalesce(seen.select(hot.alias("hot")).scalar(), F.array().cast("array<bigint>"))


def attach_by_key(
    big: DataFrame,
    few_per_key: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    salts: int = SALTS,
) -> DataFrame:
    """Left join of ``big`` to ``few_per_key``, which has few rows of any key.

    Rows of a hot key are dealt over ``salts`` join partitions by a hash of
    ``spread_by``, and the few rows of that key are copied that often; all other
    keys join plainly, so next to nothing is copied. The result is the plain
    left join's. Both inputs are direct shuffles of the join (the second
    one often comes out of an aggregation on the same keys, which would
    otherwise be reused), and that is what adaptive execution needs to split a
    partition that is still too large, or to switch to a broadcast when the
    copied side turns out to be small.
    """
    hot = F.array_contains(hot_keys(big, keys), F.xxhash64(*keys))
    none = F.lit(0).cast("bigint")
    every = F.sequence(none, F.lit(salts - 1).cast("bigint"))
    dealt = big.withColumn("_salt", F.when(hot, F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(none))
    copies = few_per_key.withColumn("_salt", F.explode(F.when(hot, every).otherwise(F.array(none))))
    return dealt.join(copies, [*keys, "_salt"], "left").drop("_salt")


def attach_single(big: DataFrame, single: DataFrame) -> DataFrame:
    """Put the columns of a one-row table on every row, as nulls if it is empty.

    A scalar subquery, not a join: the row is read once and becomes a constant.
    """
    row = single.select(F.struct(*single.columns).alias("row")).scalar()
    return big.withColumn("_single", row).select(
        *big.columns, *[F.col(f"_single.{c}").alias(c) for c in single.columns]
    )
