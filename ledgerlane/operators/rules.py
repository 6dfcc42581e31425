"""Balance corrections as one CASE expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlane.config import BalanceRule

COMPARISONS = {
    ">": Column.__gt__,
    ">=": Column.__ge__,
    "<": Column.__lt__,
    "<=": Column.__le__,
    "=": Column.__eq__,
}


def corrected_balance(
    rules: Iterable[BalanceRule], balance: Column, account_type: Column, account_name: Column
) -> Column:
    """Balance after the first matching rule, or the balance itself.

    Names are compared exactly. A missing type or name matches no rule that
    asks for one.
    """
    result = None
    for rule in rules:
        matches = COMPARISONS[rule.comparison](balance, F.lit(rule.threshold))
        if rule.account_type is not None:
            matches = (account_type == rule.account_type) & matches
        if rule.account_name is not None:
            matches = (account_name == rule.account_name) & matches
        value = -balance if rule.value is None else F.lit(rule.value)
        result = F.when(matches, value) if result is None else result.when(matches, value)
    return balance if result is None else result.otherwise(balance)
