"""Checks that stop a load or a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

EXAMPLES_IN_MESSAGE = 20


class LoadError(ValueError):
    """The input breaks the table contract; no result is handed out."""


def require_none(violations: DataFrame, what: str) -> None:
    """Raise with a few examples if there is any violating row."""
    examples = violations.limit(EXAMPLES_IN_MESSAGE).collect()
    if examples:
        shown = "; ".join(str(row.asDict()) for row in examples)
        raise LoadError(f"{what}: {shown}")


def require_not_null(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise if any of the columns holds a null; one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    missing = {c: counts[c] for c in columns if counts[c]}
    if missing:
        raise LoadError(f"nulls in required columns: {missing}")


class Watch:
    """Counts breaches in a frame while something else is computed from it.

    The counts are observed by whatever job runs over ``frame`` first, so they cost no pass of their
    own. Only if there are any does ``require`` go back to the rows, to name some.
    """

    def __init__(self, df: DataFrame, breaches: Mapping[str, Column], shown: Sequence[str]):
        self._df, self._shown, self._breaches = df, list(shown), dict(breaches)
        self._seen = Observation()
        self.frame = df.observe(
            self._seen, *[F.count_if(c).alias(str(n)) for n, c in enumerate(self._breaches.values())]
        )

    def require(self) -> None:
        """Raise if the job that ran over the frame met a breach."""
        try:
            counts = self._seen.get
        except Py4JJavaError:
            # A frame without rows can be optimized away, and what was observed with it.
            return
        for number, (what, breach) in enumerate(self._breaches.items()):
            if counts[str(number)]:
                require_none(self._df.filter(breach).select(self._shown), what)


def required(column: str) -> Column:
    """The column itself; a null stops the job that computes it.

    For columns that are about to be written: the check rides along with the
    write, and a failed job commits no files.
    """
    message = F.lit(f"null in required column {column}")
    return F.coalesce(F.col(column), F.raise_error(message)).alias(column)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)
    require_none(twice, f"duplicate {', '.join(keys)}")
