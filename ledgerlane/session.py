"""Session settings the jobs are written for."""

from __future__ import annotations

from math import ceil

MIB = 1024 * 1024

# What one task should read of a shuffle, so that it sorts in memory.
SHUFFLE_TASK_BYTES = 200 * MIB


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Enough partitions for the largest shuffle, and at least one per core.

    Adaptive execution merges partitions that turn out small but splits only
    skewed joins, so the number has to fit the biggest stage.
    """
    return max(cores, ceil(shuffled_bytes / SHUFFLE_TASK_BYTES))


def settings(shuffled_bytes: int, cores: int) -> dict[str, str]:
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions(shuffled_bytes, cores)),
    }
