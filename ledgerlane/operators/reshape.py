"""Wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def columns_to_rows(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per listed column: keys, column name, column value."""
    return df.unpivot(list(keys), list(columns), name, value)
