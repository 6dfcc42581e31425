"""What a deployment configures: expressions, rules, ages and the cutoff.

Expressions are SQL text evaluated by Spark. Treat them as code, not as user
input. A misspelt column fails when the model is built, before any job runs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import time

# The accounts a stock distribution is spread over, in order.
DEFAULT_ACCOUNTS = (
    "m1_diversified_portfolio",
    "m1_roth_ira",
    "m1_tech_portfolio",
    "vanguard_brokerage",
    "vanguard_401k",
    "worthy_bonds",
    "celsius_ada",
    "celsius_btc",
    "celsius_eth",
    "celsius_usdc",
    "coinbase_ada",
    "coinbase_btc",
    "coinbase_eth",
)


@dataclass(frozen=True)
class BalanceRule:
    """Correct a balance when type, name and comparison all hold.

    ``account_type`` or ``account_name`` of None matches anything. ``value``
    replaces the balance; None means its sign is flipped.
    """

    comparison: str
    threshold: float
    account_type: str | None = None
    account_name: str | None = None
    value: float | None = None


# The shipped corrections. The first rule that matches wins.
DEFAULT_RULES = (
    BalanceRule(">", 0, account_type="credit"),
    BalanceRule("=", 0, account_name="BTC", value=2000),
    BalanceRule("=", 0, account_name="ETH", value=1600),
    BalanceRule("<", 1000, account_name="USDC", value=17500),
)


def weighted_spreads(accounts: Iterable[str]) -> dict[str, str]:
    """Default spread: weight of the account times its latest balance."""
    return {f"{a}_spread": f"{a}_weight * {a}" for a in accounts}


@dataclass(frozen=True)
class ModelConfig:
    """Settings of one model run.

    ``tie_breaker`` decides between readings with the same timestamp. Set it
    to None for a history whose (portfolio, datetime_now) is unique, as the
    loader in this package writes it: ordering by the timestamp alone is
    cheaper.
    """

    pre_investment_expr: str = "0"
    networth_expr: str = "networth"
    investment_expr: str = "investment"
    spread_exprs: Mapping[str, str] = field(
        default_factory=lambda: weighted_spreads(DEFAULT_ACCOUNTS)
    )
    cutoff: time = time(13, 30)
    ages: Mapping[str, int] = field(
        default_factory=lambda: {"thirty_days_ago": 30, "sixty_days_ago": 60}
    )
    keys: tuple[str, ...] = ("portfolio_id",)
    tie_breaker: str | None = "primary_key"
