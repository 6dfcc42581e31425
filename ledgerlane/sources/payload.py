"""Account payloads: JSON lists of account records, to wide snapshots.

A payload is one portfolio's list of accounts at one instant, held in one row.
Deduplication, lookup, correction and pivot all happen inside that row, so
turning payloads into snapshots shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.config import DEFAULT_RULES, BalanceRule
from ledgerlane.functions.clock import instant
from ledgerlane.functions.money import money
from ledgerlane.operators.checks import require_none
from ledgerlane.operators.rules import corrected_balance
from ledgerlane.operators.skew import attach_by_key
from ledgerlane.schemas import PAYLOAD, PORTFOLIO

RECORD_FIELDS = ("id", "accountType", "accountName", "currentBalance")


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per payload file: its text and the partition columns of its path.

    Folders such as ``portfolio_id=7/`` supply the portfolio.
    """
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def capture_columns(run_ts: datetime) -> list[Column]:
    """Date and time of the run, both from one instant, so they always agree."""
    now = instant(run_ts)
    return [now.alias("datetime_now"), F.to_date(now).alias("date_now")]


def encode_payload(records: Column, kind: T.DataType = PAYLOAD) -> Column:
    """Array of account records to JSON text; `kind` is the column's type if records have other fields.

    Keys come out sorted at every level, in whatever order the records have
    their fields. Numbers are written as they are, other types as text, nulls as null.
    """
    return F.to_json(in_key_order(records, kind), {"ignoreNullFields": "false"})


def in_key_order(value: Column, kind: T.DataType) -> Column:
    """The same value with the fields of its structs, and the keys of its maps, sorted."""
    if isinstance(kind, T.StructType):
        fields = [in_key_order(value[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: in_key_order(item, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.map_entries(value))
        sorted_map = F.map_from_entries(entries)
        return F.transform_values(sorted_map, lambda _, item: in_key_order(item, kind.valueType))
    return value


def decode_payload(payload: Column) -> Column:
    """JSON text to an array of records.

    Text that is not a valid list of records stops the job (FAILFAST): it would
    otherwise turn into missing accounts. A lone record is no list.
    """
    records = F.from_json(payload, PAYLOAD, {"mode": "FAILFAST"})
    no_list = F.raise_error(F.lit("payload is not a list of account records"))
    return F.when(payload.rlike(r"^\s*\{"), no_list).otherwise(records)


def payload_records(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per account record, with its position in the list."""
    rest = [c for c in payloads.columns if c != payload]
    records = F.posexplode(decode_payload(F.col(payload))).alias("position", "record")
    return payloads.select(*rest, records).select(
        *rest, "position", *[F.col(f"record.{f}").alias(f) for f in RECORD_FIELDS]
    )


def _read_balance(
    rules: Iterable[BalanceRule], balance: Column, account_type: Column, account_name: Column
) -> Column:
    """Corrected balance; null where type or name is absent, since no rule can be ruled out then."""
    known = account_type.isNotNull() & account_name.isNotNull()
    return F.when(known, corrected_balance(rules, balance, account_type, account_name))


def _corrected_records(payload: str, rules: Iterable[BalanceRule]) -> Column:
    """Array of (id, corrected balance), each record corrected once."""
    rules = tuple(rules)
    return F.transform(
        decode_payload(F.col(payload)),
        lambda r: F.struct(
            r["id"].alias("id"),
            _read_balance(rules, r["currentBalance"], r["accountType"], r["accountName"]).alias(
                "balance"
            ),
        ),
    )


def _last_of(records: Column, account_id: Column) -> Column:
    """The last record of an account, null if the payload has none."""
    return F.try_element_at(F.filter(records, lambda r: r["id"] == account_id), F.lit(-1))


def payload_snapshot(
    payloads: DataFrame,
    columns: Mapping[str, str],
    rules: Iterable[BalanceRule] = DEFAULT_RULES,
    payload: str = "payload",
) -> DataFrame:
    """One wide row per payload, for an account map that all portfolios share.

    ``columns`` maps column name -> account id, in column order. ``missing``
    and ``unreadable`` list mapped ids that are absent or have no balance.
    """
    rest = [c for c in payloads.columns if c != payload]
    rules = tuple(rules)
    read = payloads.select(*rest, decode_payload(F.col(payload)).alias("_records"))
    picked = read.select(
        *rest,
        *[_last_of(F.col("_records"), F.lit(i)).alias(f"_{name}") for name, i in columns.items()],
    )
    return _with_checks(
        picked,
        rest,
        list(columns),
        found=lambda name: F.col(f"_{name}").isNotNull(),
        balance=_balance_of_picked(rules),
        account_id=lambda name: F.lit(columns[name]),
    )


def _balance_of_picked(rules: tuple[BalanceRule, ...]) -> Callable[[str], Column]:
    return lambda name: _read_balance(
        rules,
        F.col(f"_{name}.currentBalance"),
        F.col(f"_{name}.accountType"),
        F.col(f"_{name}.accountName"),
    )


def payload_snapshot_by_map(
    payloads: DataFrame,
    account_map: DataFrame,
    columns: Sequence[str],
    rules: Iterable[BalanceRule] = DEFAULT_RULES,
    payload: str = "payload",
) -> DataFrame:
    """One wide row per payload, for account maps that differ by portfolio.

    A portfolio's map becomes one value, column name -> account id, and meets
    the portfolio's payloads in a salted join; the rest happens inside the row.
    A column the portfolio does not map is null. A portfolio without a map, a
    map with a name outside ``columns`` and a name mapped twice stop the job;
    ``missing`` and ``unreadable`` are as in ``payload_snapshot``.
    """
    rest = [c for c in payloads.columns if c != payload]
    rules = tuple(rules)
    entries = F.collect_list(F.struct("column_name", "account_id"))
    maps = account_map.groupBy(PORTFOLIO).agg(F.map_from_entries(entries).alias("_ids"))
    joined = attach_by_key(payloads, maps, [PORTFOLIO], ["datetime_now"])
    ids = F.col("_ids")
    stray = F.array_except(F.map_keys(ids), F.array(*[F.lit(c) for c in columns]))
    of_portfolio = F.concat(
        F.lit(" in the account map of portfolio "), F.coalesce(F.col(PORTFOLIO).cast("string"), F.lit("null"))
    )
    checked = (
        F.when(ids.isNull(), F.raise_error(F.concat(F.lit("nothing"), of_portfolio)))
        .when(F.size(stray) > 0, F.raise_error(F.concat(F.array_join(stray, ", "), of_portfolio)))
        .otherwise(ids)
    )
    read = joined.select(*rest, checked.alias("_ids"), decode_payload(F.col(payload)).alias("_records"))
    wanted = read.select(
        *rest, "_records", *[F.try_element_at("_ids", F.lit(c)).alias(f"_id_{c}") for c in columns]
    )
    picked = wanted.select(
        *rest,
        *[f"_id_{c}" for c in columns],
        *[_last_of(F.col("_records"), F.col(f"_id_{c}")).alias(f"_{c}") for c in columns],
    )
    return _with_checks(
        picked,
        rest,
        columns,
        found=lambda name: F.col(f"_{name}").isNotNull(),
        balance=_balance_of_picked(rules),
        account_id=lambda name: F.col(f"_id_{name}"),
    )


def account_readings(
    payloads: DataFrame,
    account_map: DataFrame,
    rules: Iterable[BalanceRule] = DEFAULT_RULES,
    payload: str = "payload",
) -> DataFrame:
    """Corrected balance per mapped account, for maps that differ by portfolio.

    Long form, one row per payload and mapped account; ``found`` is false where
    the payload lacks the account. Accounts outside the map are ignored, and so
    are portfolios without a map. Payloads meet their portfolio's map in a
    salted join, spread by capture time, and are read once for each account
    right there.
    """
    rest = [c for c in payloads.columns if c != payload]
    entry = ["position", "column_name", "account_id"]
    read = payloads.select(*rest, _corrected_records(payload, rules).alias("_records"))
    mapped = attach_by_key(
        read, account_map.select(PORTFOLIO, *entry), [PORTFOLIO], ["datetime_now"]
    ).filter(F.col("account_id").isNotNull())
    last = _last_of(F.col("_records"), F.col("account_id"))
    return mapped.select(*rest, *entry, last.alias("_last")).select(
        *rest,
        *entry,
        money(F.col("_last.balance")).alias("balance"),
        F.col("_last").isNotNull().alias("found"),
    )


def account_snapshot(
    records: DataFrame,
    columns: Mapping[str, str],
    rules: Iterable[BalanceRule] = DEFAULT_RULES,
    keys: Sequence[str] = (PORTFOLIO, "datetime_now"),
    order: str = "position",
) -> DataFrame:
    """As ``payload_snapshot``, from account records that arrive as single rows.

    Corrections apply to single records, so they come first; last-wins and the
    pivot are then one aggregation with one shuffle of combined rows.
    """
    shaped = records.select(
        *keys,
        F.col("id").alias("_id"),
        F.col(order).alias("_order"),
        _read_balance(
            rules, F.col("currentBalance"), F.col("accountType"), F.col("accountName")
        ).alias("_balance"),
    )
    picks = []
    for name, account_id in columns.items():
        mine = F.when(F.col("_id") == account_id, F.col("_order"))
        picks += [
            F.max_by("_balance", mine).alias(name),
            F.bool_or(F.col("_id") == account_id).alias(f"_found_{name}"),
        ]
    return _with_checks(
        shaped.groupBy(*keys).agg(*picks),
        list(keys),
        list(columns),
        found=lambda name: F.coalesce(F.col(f"_found_{name}"), F.lit(False)),
        balance=F.col,
        account_id=lambda name: F.lit(columns[name]),
    )


def _with_checks(
    df: DataFrame,
    rest: list[str],
    columns: Sequence[str],
    found: Callable[[str], Column],
    balance: Callable[[str], Column],
    account_id: Callable[[str], Column],
) -> DataFrame:
    """Money columns, and the ids of accounts not found or without a balance. A null id is not asked for."""

    def ids_where(condition: Callable[[str], Column]) -> Column:
        ids = [F.when(condition(name), F.col(f"_wanted_{name}")) for name in columns]
        return F.array_compact(F.array(*ids).cast("array<string>"))

    corrected = df.select(
        *rest,
        *[money(balance(name)).alias(name) for name in columns],
        *[found(name).alias(f"_found_{name}") for name in columns],
        *[account_id(name).alias(f"_wanted_{name}") for name in columns],
    )
    return corrected.select(
        *rest,
        *columns,
        ids_where(lambda name: ~F.col(f"_found_{name}")).alias("missing"),
        ids_where(lambda name: F.col(f"_found_{name}") & F.col(name).isNull()).alias("unreadable"),
    )


def stopped_at_failures(snapshot: DataFrame) -> DataFrame:
    """The snapshot without its check columns; a missing account or balance stops the job.

    The check rides in the portfolio column, so it costs no pass of its own and
    a write that fails commits nothing.
    """
    failed = F.concat("missing", "unreadable")
    message = F.concat(
        F.lit("payload lacks mapped accounts or their balances: portfolio "),
        F.coalesce(F.col(PORTFOLIO).cast("string"), F.lit("null")),
        F.lit(", accounts "),
        F.array_join(failed, ", "),
    )
    portfolio = F.when(F.size(failed) > 0, F.raise_error(message)).otherwise(F.col(PORTFOLIO))
    return snapshot.withColumn(PORTFOLIO, portfolio).drop("missing", "unreadable")


def checked_snapshot(snapshot: DataFrame, folder: str) -> DataFrame:
    """The snapshot without its check columns; raises if an account fails.

    A missing account or balance would silently become null here, where a
    single-portfolio loader would stop. The snapshot is written to ``folder``
    once; the check reads only its two check columns back.
    """
    snapshot.write.mode("overwrite").parquet(folder)
    stored = snapshot.sparkSession.read.schema(snapshot.schema).parquet(folder)
    require_none(
        stored.filter((F.size("missing") > 0) | (F.size("unreadable") > 0)),
        "payload lacks mapped accounts or their balances",
    )
    return stored.drop("missing", "unreadable")
