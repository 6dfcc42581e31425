"""Exact amounts: decimal inside, double only at the outer edge."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
WEIGHT = T.DecimalType(9, 4)
FRACTION = T.DecimalType(5, 4)


def money(value: Column) -> Column:
    """Cast to cents; under ANSI an amount that does not fit raises."""
    return value.cast(MONEY)


def add_all(columns: Iterable[Column]) -> Column:
    """a + b + ...: null as soon as one term is null (unlike sum())."""
    return reduce(add, columns)


def cents(value: Column) -> Column:
    """Round half away from zero to two places, as an amount of money.

    Products and sums of decimals get ever wider types; back at 18 digits an
    amount is a plain 64-bit number again in rows, files and shuffles.
    """
    return money(F.round(value, 2))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Hand decimals out as DOUBLE; other columns are untouched."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
