"""SQL twins of the registered queries.

They read the definitions directly: ordered lists of all readings, from which
the first or last element is taken, and the whole calendar times all portfolios.
That is too slow for large tables but shares no shape with the Spark models.
"""

from __future__ import annotations

AMOUNT = "CAST(value AS DECIMAL(18,2))"
PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"
CLASSES = ("us_stock", "foreign_stock", "bonds", "cryptocurrency", "stablecoin")
EVENT_ACCOUNTS = ("click", "error", "purchase", "signup", "view")
ORDER_ACCOUNTS = (("filled", "F"), ("opened", "O"), ("pending", "P"))

def _comma(parts) -> str:
    return ",\n    ".join(parts)


# Gains and losses


def _event_readings(portfolio: str) -> str:
    return f"""readings AS (
    SELECT {portfolio} AS portfolio_id, event_id AS primary_key, ts, {AMOUNT} AS amount
    FROM events)"""


MORNINGS = """mornings AS (
    SELECT portfolio_id, CAST(ts AS DATE) AS date_now,
        list(amount ORDER BY ts, primary_key) AS amounts
    FROM readings WHERE CAST(ts AS TIME) <= TIME '13:30:00' GROUP BY ALL)"""

WEEKDAYS = """weekdays AS (
    SELECT date_value FROM (
        SELECT CAST(unnest(generate_series(
            CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS date_value
        FROM readings)
    WHERE extract(isodow FROM date_value) <= 5)"""

GAINS = f"""{MORNINGS},
{WEEKDAYS},
cells AS (
    SELECT c.portfolio_id, c.date_value,
        own.amounts[-1] AS pre_investment, following.amounts[1] AS post_investment
    FROM (SELECT p.portfolio_id, w.date_value
          FROM (SELECT DISTINCT portfolio_id FROM readings) p CROSS JOIN weekdays w) c
    LEFT JOIN mornings own
        ON own.portfolio_id = c.portfolio_id AND own.date_now = c.date_value
    LEFT JOIN mornings following
        ON following.portfolio_id = c.portfolio_id AND following.date_now = c.date_value + 1),
gains AS (
    SELECT *, post_investment - pre_investment AS gains_losses,
        lag(post_investment - pre_investment) OVER (
            PARTITION BY portfolio_id ORDER BY date_value) AS previous_day_gains
    FROM cells)"""


def _gains(portfolio: str, columns: str) -> str:
    return f"""
WITH {_event_readings(portfolio)},
{GAINS}
SELECT {columns}date_value,
    CAST(pre_investment AS DOUBLE) AS pre_investment,
    CAST(post_investment AS DOUBLE) AS post_investment,
    CAST(gains_losses AS DOUBLE) AS gains_losses,
    CAST(previous_day_gains AS DOUBLE) AS previous_day_gains
FROM gains"""


# The definition itself: ranks within a date, then the weekday of the reading's own time.
STRADDLING = f"""
WITH {_event_readings("user_id")},
{WEEKDAYS},
early AS (
    SELECT *, CAST(ts + INTERVAL 12 HOUR AS DATE) AS date_now FROM readings
    WHERE CAST(ts AS TIME) <= TIME '13:30:00'),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY portfolio_id, date_now ORDER BY ts DESC, primary_key DESC) AS down,
        row_number() OVER (PARTITION BY portfolio_id, date_now ORDER BY ts, primary_key) AS up
    FROM early),
before AS (SELECT * FROM ranked WHERE down = 1 AND extract(dow FROM ts) IN (1, 2, 3, 4, 5)),
after AS (
    SELECT *, CAST(date_now - INTERVAL 1 DAY AS DATE) AS day_before FROM ranked
    WHERE up = 1 AND extract(dow FROM ts) IN (2, 3, 4, 5, 6)),
cells AS (
    SELECT p.portfolio_id, w.date_value, before.amount AS pre, after.amount AS post
    FROM (SELECT DISTINCT portfolio_id FROM readings) p CROSS JOIN weekdays w
    LEFT JOIN before ON before.portfolio_id = p.portfolio_id AND before.date_now = w.date_value
    LEFT JOIN after ON after.portfolio_id = p.portfolio_id AND after.day_before = w.date_value)
SELECT portfolio_id, date_value, CAST(pre AS DOUBLE) AS pre_investment, CAST(post AS DOUBLE) AS post_investment,
    CAST(post - pre AS DOUBLE) AS gains_losses,
    CAST(lead(post - pre) OVER (PARTITION BY portfolio_id ORDER BY date_value DESC) AS DOUBLE) AS previous_day_gains
FROM cells"""

MORNING = f"""
WITH {_event_readings("user_id")},
{MORNINGS}
SELECT portfolio_id, date_now, CAST(amounts[-1] AS DOUBLE) AS last_value,
    CAST(amounts[1] AS DOUBLE) AS first_value
FROM mornings"""

SPINE = f"""
WITH {_event_readings("user_id")},
{WEEKDAYS}
SELECT date_value FROM weekdays"""

READING_TIMES = """
SELECT event_id,
    extract(dow FROM ts) BETWEEN 1 AND 5 AS on_weekday,
    CAST(extract(isodow FROM ts) - 1 AS INTEGER) AS days_after_monday,
    CAST(CAST(ts AS DATE) - INTERVAL 1 DAY AS DATE) AS day_before,
    CAST(extract(hour FROM CAST(ts AS TIME)) AS BIGINT) AS hours_since_midnight,
    CAST(date_part('day', TIMESTAMP '2024-01-31 12:45:00' - ts) AS BIGINT) AS whole_days_old
FROM events"""


# Net worth

ORDER_SERIES = f"""series AS (
    SELECT o_custkey AS portfolio_id, o_orderkey AS primary_key,
        o_orderdate AS datetime_stamp, CAST(o_orderdate AS DATE) AS date_stamp,
        {PRICE} AS networth, CAST(0 AS DECIMAL(18,2)) AS investment_amount
    FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
    UNION ALL
    SELECT o_custkey, o_orderkey, o_orderdate, CAST(o_orderdate AS DATE), {PRICE},
        CASE WHEN o_orderstatus = 'F' THEN {PRICE} ELSE 0 END
    FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00')"""

EVENT_SERIES = f"""series AS (
    SELECT user_id AS portfolio_id, event_id AS primary_key, ts AS datetime_stamp,
        {AMOUNT} AS networth,
        CASE WHEN event_type = 'purchase' THEN {AMOUNT} ELSE 0 END AS investment_amount
    FROM events)"""

NETWORTH = f"""
WITH {ORDER_SERIES}
SELECT portfolio_id, primary_key, datetime_stamp, date_stamp,
    CAST(networth AS DOUBLE) AS networth,
    CAST(investment_amount AS DOUBLE) AS investment_amount
FROM series"""


PRE_INVESTMENT = NETWORTH.replace(
    "CAST(0 AS DECIMAL(18,2)) AS investment_amount", f"CAST({PRICE} * 0.25 AS DECIMAL(18,2)) AS investment_amount")


def _compared(ages: dict[str, int]) -> str:
    """The picks of a comparison, from readings that know the newest instant."""
    picks = []
    for amount in ("networth", "investment_amount"):
        for name, days in {"now": 0, **ages}.items():
            ordered = f"list({amount} ORDER BY datetime_stamp DESC, primary_key DESC)"
            old = f"FILTER (WHERE datetime_stamp <= newest - INTERVAL {days} DAY)"
            picks.append(f"({ordered} {old})[1] AS {amount}_{name}")
    return _comma(picks)


def _comparison(series: str, ages: dict[str, int], by_portfolio: bool = True) -> str:
    key = "portfolio_id" if by_portfolio else ""
    return f"""
WITH {series},
dated AS (
    SELECT *, max(datetime_stamp) OVER ({f"PARTITION BY {key}" if key else ""}) AS newest
    FROM series),
comparison AS (
    SELECT {f"{key}," if key else ""}
    {_compared(ages)}
    FROM dated GROUP BY ALL)
SELECT {f"{key}," if key else ""} CAST(COLUMNS('networth_|investment_') AS DOUBLE)
FROM comparison"""


# Of readings at one time the greatest key counts; then the last time up to the instant does.
AS_OF = f"""
WITH {ORDER_SERIES},
once AS (
    SELECT portfolio_id, datetime_stamp, arg_max(networth, primary_key) AS networth,
        arg_max(investment_amount, primary_key) AS investment_amount
    FROM series GROUP BY ALL),
shipped AS (
    SELECT o_orderkey, l_linenumber, o_custkey AS portfolio_id, l_shipdate AS instant
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT s.portfolio_id, s.instant, s.o_orderkey, s.l_linenumber, o.datetime_stamp,
    CAST(o.networth AS DOUBLE) AS networth, CAST(o.investment_amount AS DOUBLE) AS investment_amount
FROM shipped s ASOF LEFT JOIN once o
    ON s.portfolio_id = o.portfolio_id AND s.instant >= o.datetime_stamp"""

AGES = {"thirty_days_ago": 30, "sixty_days_ago": 60}
SHORT_AGES = {"one_day_ago": 1, "seven_days_ago": 7, "twenty_days_ago": 20}

LATEST = f"""
SELECT user_id AS portfolio_id, event_id AS primary_key, ts AS datetime_now,
    CAST(ts AS DATE) AS date_now, CAST({AMOUNT} AS DOUBLE) AS investment
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
      FROM events)
WHERE n = 1"""


# Distributions

SPLIT = (
    "split AS (SELECT p_partkey AS stock_symbol, "
    + ", ".join(
        f"CAST((p_size * {j} % 11) * 0.1 AS DECIMAL(5,4)) AS {c}"
        for j, c in enumerate(CLASSES, 1)
    )
    + " FROM part WHERE p_type <> 'ECONOMY')"
)


def _weight(symbol: str, number: int) -> str:
    return f"CAST(({symbol} * {number} % 7) * 0.01 AS DECIMAL(9,4))"


SINGLE_STOCKS = f"""newest AS (
    SELECT event_type, {AMOUNT} AS balance FROM (
        SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS n
        FROM events) WHERE n = 1),
stocks AS (
    SELECT p_partkey AS stock_symbol, round({" + ".join(
        f"{_weight('p_partkey', i)} * (SELECT balance FROM newest WHERE event_type = '{a}')"
        for i, a in enumerate(EVENT_ACCOUNTS, 1))}, 2) AS total_amount
    FROM part)"""

HELD_STOCKS = f"""newest AS (
    SELECT o_custkey, o_orderstatus, {PRICE} AS balance FROM (
        SELECT *, row_number() OVER (
            PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
        FROM orders) WHERE n = 1),
held AS (
    SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
stocks AS (
    SELECT h.o_custkey AS portfolio_id, h.l_partkey AS stock_symbol, round({" + ".join(
        f"{_weight('h.l_partkey', i)} * {a}.balance"
        for i, (a, _) in enumerate(ORDER_ACCOUNTS, 1))}, 2) AS total_amount
    FROM held h
    {" ".join(
        f"LEFT JOIN newest {a} ON {a}.o_custkey = h.o_custkey AND {a}.o_orderstatus = '{s}'"
        for a, s in ORDER_ACCOUNTS)})"""


ACCOUNTS = 13

# The newest snapshot of a customer has thirteen amounts; errors lack the last one.
LATEST_STOCKS = f"""newest AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
        FROM events) WHERE n = 1),
held AS (
    SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
stocks AS (
    SELECT h.o_custkey AS portfolio_id, h.l_partkey AS stock_symbol, round({" + ".join(
        f"{_weight('h.l_partkey', i)} * CAST(CASE WHEN {i} < {ACCOUNTS} OR event_type <> 'error' "
        f"THEN value * {i} END AS DECIMAL(18,2))"
        for i in range(1, ACCOUNTS + 1))}, 2) AS total_amount
    FROM held h LEFT JOIN newest ON user_id = o_custkey)"""


def _assets(keys: str) -> str:
    products = [f"round(a.{c} * s.total_amount, 2) AS amount_{c}" for c in CLASSES]
    return f"""{SPLIT},
assets AS (
    SELECT {keys}s.stock_symbol, s.total_amount, {", ".join(products)}
    FROM stocks s LEFT JOIN split a ON s.stock_symbol = a.stock_symbol)"""


def _stocks_query(stocks: str, keys: str) -> str:
    return f"""
WITH {stocks}
SELECT {keys}stock_symbol, CAST(total_amount AS DOUBLE) AS total_amount FROM stocks"""


def _assets_query(stocks: str, keys: str, own_keys: str) -> str:
    columns = [f"CAST(amount_{c} AS DOUBLE) AS amount_{c}" for c in CLASSES]
    return f"""
WITH {stocks},
{_assets(keys)}
SELECT {own_keys}stock_symbol, CAST(total_amount AS DOUBLE) AS total_amount,
    {_comma(columns)}
FROM assets"""


def _totals(keys: str) -> str:
    """Every amount as a row of its own, summed per class."""
    names = ", ".join(f"'{c}'" for c in CLASSES)
    amounts = ", ".join(f"amount_{c}" for c in CLASSES)
    return f"""totals AS (
    SELECT {keys}assett_class, sum(amount) AS amount
    FROM (SELECT {keys}unnest([{names}]) AS assett_class, unnest([{amounts}]) AS amount FROM assets)
    GROUP BY ALL)"""


def _totals_query(stocks: str, keys: str, own_keys: str) -> str:
    return f"""
WITH {stocks},
{_assets(keys)},
{_totals(own_keys)}
SELECT {own_keys}assett_class, CAST(amount AS DOUBLE) AS amount FROM totals"""


# Payloads and snapshots

PAYLOAD_PARSE = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""

PAYLOAD_ROWS = f"""accounts AS (
    SELECT event_id, user_id, ts, 0 AS position, 'a1' AS id,
        CASE WHEN user_id % 2 = 0 THEN 'credit' ELSE 'bank' END AS kind,
        'Main' AS name, {AMOUNT} AS balance FROM events
    UNION ALL
    SELECT event_id, user_id, ts, 1, 'a2', 'bank', 'BTC',
        CASE WHEN event_type = 'click' THEN 0 ELSE {AMOUNT} END FROM events
    UNION ALL
    SELECT event_id, user_id, ts, 2, 'a3', 'bank', 'USDC', {AMOUNT} * 10 FROM events
    UNION ALL
    SELECT event_id, user_id, ts, 3, 'a9', 'bank', 'Other', {AMOUNT} FROM events
    UNION ALL
    SELECT event_id, user_id, ts, 4, 'a3', 'bank', 'USDC', {AMOUNT} * 20
    FROM events WHERE event_type = 'error')"""

RULES = """CASE
        WHEN kind = 'credit' AND balance > 0 THEN -balance
        WHEN name = 'BTC' AND balance = 0 THEN 2000
        WHEN name = 'ETH' AND balance = 0 THEN 1600
        WHEN name = 'USDC' AND balance < 1000 THEN 17500
        ELSE balance END"""

FIXED = f"""{PAYLOAD_ROWS},
last_one AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id, id ORDER BY position DESC) AS n
        FROM accounts) WHERE n = 1),
fixed AS (SELECT event_id, user_id, ts, id, {RULES} AS balance FROM last_one)"""

PAYLOAD_RECORDS = f"""
WITH {PAYLOAD_ROWS}
SELECT event_id AS primary_key, position, id, kind AS "accountType", name AS "accountName",
    CAST(balance AS DOUBLE) AS "currentBalance"
FROM accounts"""

PAYLOAD_SNAPSHOT = f"""
WITH {FIXED}
SELECT e.user_id AS portfolio_id, e.event_id AS primary_key, e.ts AS datetime_now,
    CAST(f1.balance AS DOUBLE) AS checking, CAST(f2.balance AS DOUBLE) AS bitcoin,
    CAST(f3.balance AS DOUBLE) AS dollars
FROM events e
JOIN fixed f1 ON f1.event_id = e.event_id AND f1.id = 'a1'
JOIN fixed f2 ON f2.event_id = e.event_id AND f2.id = 'a2'
JOIN fixed f3 ON f3.event_id = e.event_id AND f3.id = 'a3'"""

PAYLOAD_FILES = f"""
WITH {FIXED}
SELECT e.user_id AS portfolio_id, CAST(f1.balance AS DOUBLE) AS checking,
    CAST(f2.balance AS DOUBLE) AS bitcoin, CAST(f3.balance AS DOUBLE) AS dollars
FROM (SELECT CAST(day(ts) AS BIGINT) AS user_id, arg_max(event_id, (ts, event_id)) AS event_id
    FROM events GROUP BY day(ts)) e
JOIN fixed f1 ON f1.event_id = e.event_id AND f1.id = 'a1'
JOIN fixed f2 ON f2.event_id = e.event_id AND f2.id = 'a2'
JOIN fixed f3 ON f3.event_id = e.event_id AND f3.id = 'a3'"""

EXTRACT_LOAD = f"""
WITH {FIXED}
SELECT e.user_id AS portfolio_id, e.ts AS datetime_now, CAST(e.ts AS DATE) AS date_now,
    epoch_us(e.ts) AS primary_key,
    CAST(f1.balance AS DOUBLE) AS checking, CAST(f2.balance AS DOUBLE) AS bitcoin,
    CAST(f3.balance AS DOUBLE) AS dollars
FROM events e
JOIN fixed f1 ON f1.event_id = e.event_id AND f1.id = 'a1'
JOIN fixed f2 ON f2.event_id = e.event_id AND f2.id = 'a2'
JOIN fixed f3 ON f3.event_id = e.event_id AND f3.id = 'a3'"""

HISTORY_SCHEMA_CHANGE = f"""
WITH {FIXED}
SELECT e.user_id AS portfolio_id, e.ts AS datetime_now, CAST(e.ts AS DATE) AS date_now,
    epoch_us(e.ts) AS primary_key,
    CASE WHEN e.event_id % 3 < 2 THEN CAST(f1.balance AS DOUBLE) END AS checking,
    CASE WHEN e.event_id % 3 < 2 THEN CAST(f2.balance AS DOUBLE) END AS bitcoin,
    CASE WHEN e.event_id % 3 > 0 THEN CAST(f3.balance AS DOUBLE) END AS dollars
FROM events e
JOIN fixed f1 ON f1.event_id = e.event_id AND f1.id = 'a1'
JOIN fixed f2 ON f2.event_id = e.event_id AND f2.id = 'a2'
JOIN fixed f3 ON f3.event_id = e.event_id AND f3.id = 'a3'"""

EXTRACT_LOAD_BY_MAP = f"""
WITH {FIXED}
SELECT e.user_id AS portfolio_id, e.ts AS datetime_now, CAST(e.ts AS DATE) AS date_now,
    epoch_us(e.ts) AS primary_key,
    CASE WHEN e.user_id % 2 = 0 THEN CAST(f1.balance AS DOUBLE) END AS card,
    CAST(f3.balance AS DOUBLE) AS dollars,
    CASE WHEN e.user_id % 2 = 1 THEN CAST(f2.balance AS DOUBLE) END AS bitcoin
FROM events e
JOIN fixed f1 ON f1.event_id = e.event_id AND f1.id = 'a1'
JOIN fixed f2 ON f2.event_id = e.event_id AND f2.id = 'a2'
JOIN fixed f3 ON f3.event_id = e.event_id AND f3.id = 'a3'"""

ACCOUNT_READINGS = f"""
WITH {FIXED},
map AS (
    SELECT * FROM (VALUES
        (0, 1, 'card', 'a1'), (0, 2, 'dollars', 'a3'),
        (1, 1, 'dollars', 'a3'), (1, 2, 'bitcoin', 'a2'), (1, 3, 'lost', 'a7'))
    AS m(parity, position, column_name, account_id))
SELECT e.user_id AS portfolio_id, e.event_id AS primary_key, e.ts AS datetime_now,
    m.position, m.column_name, m.account_id, CAST(f.balance AS DOUBLE) AS balance,
    f.id IS NOT NULL AS found
FROM events e JOIN map m ON e.user_id % 2 = m.parity
LEFT JOIN fixed f ON f.event_id = e.event_id AND f.id = m.account_id"""

EVENT_RULES = """CASE
        WHEN user_id % 2 = 0 AND balance > 0 THEN -balance
        WHEN event_type = 'click' AND balance < 50 THEN 2000
        WHEN event_type = 'error' AND balance < 50 THEN 1600
        WHEN event_type = 'view' AND balance < 100 THEN 17500
        ELSE balance END"""

ACCOUNT_SNAPSHOT = f"""
WITH last_one AS (
    SELECT user_id, event_type, {AMOUNT} AS balance FROM (
        SELECT *, row_number() OVER (
            PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n
        FROM events) WHERE n = 1),
fixed AS (SELECT user_id, event_type, {EVENT_RULES} AS balance FROM last_one)
SELECT u.user_id AS portfolio_id, TIMESTAMP '2024-01-31 12:45:00' AS datetime_now,
    DATE '2024-01-31' AS date_now,
    {_comma(f"CAST({a}.balance AS DOUBLE) AS {a}" for a in EVENT_ACCOUNTS)},
    concat_ws(',', {", ".join(
        f"CASE WHEN {a}.user_id IS NULL THEN '{a}' END" for a in EVENT_ACCOUNTS)}) AS missing
FROM (SELECT DISTINCT user_id FROM events) u
{" ".join(
    f"LEFT JOIN fixed {a} ON {a}.user_id = u.user_id AND {a}.event_type = '{a}'"
    for a in EVENT_ACCOUNTS)}"""

BALANCE_RULES = f"""
WITH records AS (
    SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'credit' ELSE 'bank' END AS kind,
        CASE event_type WHEN 'click' THEN 'BTC' WHEN 'error' THEN 'ETH' WHEN 'view' THEN 'USDC'
            ELSE 'Savings' END AS name,
        CAST((floor(value / 10) - 1) * 100 AS DECIMAL(18,2)) AS balance
    FROM events)
SELECT event_id, CAST({RULES} AS DOUBLE) AS balance FROM records"""


# Landing and loading

LANDED_NAMES = """
SELECT event_id, 'account-data/' || strftime(ts, 'mint_%m_%d_%Y_%H-%M-%S.csv') AS file_name
FROM events"""

EVENT_ROWS = f"""
SELECT user_id AS portfolio_id, event_id AS primary_key, ts AS datetime_now,
    CAST(ts AS DATE) AS date_now, CAST({AMOUNT} AS DOUBLE) AS investment
FROM events"""

BY_POSITION = f"""
SELECT event_id, ts AS datetime_now, CAST({AMOUNT} AS DOUBLE) AS checking,
    CAST(CAST(value * 2 AS DECIMAL(18,2)) AS DOUBLE) AS savings
FROM events"""

LANDED_DISCOVERY = """
SELECT CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'mint_01_31_2024_12-45-00.csv'
        ELSE 'mint_01_31_2024_13-15-00.csv' END AS landed,
    count(*) AS readings, max(ts) AS last_reading
FROM events GROUP BY landed"""

LAST_REPORTS = f"""
SELECT user_id AS portfolio_id, event_id AS primary_key, ts AS datetime_now, CAST(ts AS DATE) AS date_now,
    CAST(CASE WHEN event_id % 7 = 0 THEN {AMOUNT} * 3 WHEN event_id % 3 = 0 THEN {AMOUNT} * 2 ELSE {AMOUNT} END
        AS DOUBLE) AS investment,
    CASE WHEN event_id % 7 = 0 THEN 2 WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS reported
FROM events"""

LANDED_FILE = f"""
SELECT user_id AS portfolio_id, event_id AS primary_key, ts AS datetime_now, CAST(ts AS DATE) AS date_now,
    CAST({AMOUNT} AS DOUBLE) AS investment, 'mint_01_31_2024_12-45-00.csv' AS file_name
FROM events"""

SNAPSHOT_APPEND = f"""
SELECT CAST(ts AS DATE) AS date_now, count(*) AS readings,
    CAST(sum({AMOUNT}) AS DOUBLE) AS investment, max(ts) AS last_reading
FROM events GROUP BY CAST(ts AS DATE)"""


# The ordered run


def _model_run() -> str:
    """Rows and column totals of all six models over orders, lineitem and part."""
    invested = f"CASE WHEN o_orderstatus IN ('F', 'O') THEN {PRICE} ELSE 0 END"
    series = f"""series AS (
    SELECT o_custkey AS portfolio_id, o_orderkey AS primary_key, o_orderdate AS datetime_stamp,
        CAST(o_orderdate AS DATE) AS date_stamp, {PRICE} AS networth,
        CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 0 ELSE {invested} END
            AS investment_amount
    FROM orders),
snapshots AS (
    SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'),
readings AS (
    SELECT o_custkey AS portfolio_id, o_orderkey AS primary_key, o_orderdate AS ts,
        {invested} AS amount
    FROM snapshots)"""
    comparison = f"""dated AS (
    SELECT *, max(datetime_stamp) OVER (PARTITION BY portfolio_id) AS newest FROM series),
comparison AS (
    SELECT portfolio_id,
    {_compared(AGES)}
    FROM dated GROUP BY ALL)"""
    # The newest snapshot of an order portfolio holds one order's amount.
    stocks = f"""latest AS (SELECT * FROM (
    SELECT *, row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
    FROM snapshots) WHERE n = 1),
held AS (
    SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
stocks AS (
    SELECT h.o_custkey AS portfolio_id, h.l_partkey AS stock_symbol, round({" + ".join(
        f"{_weight('h.l_partkey', i)} * CASE WHEN o_orderstatus = '{s}' THEN {PRICE} "
        f"WHEN o_orderstatus IS NOT NULL THEN 0 END"
        for i, (_, s) in enumerate(ORDER_ACCOUNTS, 1))}, 2) AS total_amount
    FROM held h LEFT JOIN latest l ON l.o_custkey = h.o_custkey)"""
    columns = {
        ("networth", "series"): ["networth", "investment_amount"],
        ("networth_comparison", "comparison"): [
            f"{a}_{n}" for a in ("networth", "investment_amount") for n in ("now", *AGES)
        ],
        ("gains_losses", "gains"): [
            "pre_investment", "post_investment", "gains_losses", "previous_day_gains",
        ],
        ("stock_distribution", "stocks"): ["total_amount"],
        ("asset_distribution", "assets"): ["total_amount"] + [f"amount_{c}" for c in CLASSES],
        ("asset_totals", "totals"): ["amount"],
    }
    rows = [
        f"SELECT '{model}' AS model, '{c}' AS column_name, "
        f"(SELECT count(*) FROM {table}) AS row_count, "
        f"(SELECT CAST(sum({c}) AS DOUBLE) FROM {table}) AS total"
        for (model, table), names in columns.items()
        for c in names
    ]
    assets = _assets("s.portfolio_id, ")
    ctes = [series, comparison, GAINS, stocks, assets, _totals("portfolio_id, ")]
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(rows)


ORACLE_SQL: dict[str, str] = {
    "gains_losses": _gains("user_id", "portfolio_id, "),
    "gains_losses_global": _gains("0", ""),
    "gains_losses_straddling": STRADDLING,
    "gains_losses_kept": _gains("user_id", "portfolio_id, "),
    "networth": NETWORTH,
    "networth_pre_investment": PRE_INVESTMENT,
    "networth_comparison": _comparison(ORDER_SERIES, AGES),
    "networth_comparison_global": _comparison(ORDER_SERIES, AGES, by_portfolio=False),
    "networth_comparison_ages": _comparison(EVENT_SERIES, SHORT_AGES),
    "networth_as_of": AS_OF,
    "networth_comparison_kept": _comparison(EVENT_SERIES, SHORT_AGES),
    "stock_distribution": _stocks_query(SINGLE_STOCKS, ""),
    "asset_distribution": _assets_query(SINGLE_STOCKS, "", ""),
    "asset_totals": _totals_query(SINGLE_STOCKS, "", ""),
    "stock_distribution_by_portfolio": _stocks_query(HELD_STOCKS, "portfolio_id, "),
    "stock_distribution_latest": _stocks_query(LATEST_STOCKS, "portfolio_id, "),
    "asset_distribution_by_portfolio": _assets_query(
        HELD_STOCKS, "s.portfolio_id, ", "portfolio_id, "
    ),
    "asset_totals_by_portfolio": _totals_query(
        HELD_STOCKS, "s.portfolio_id, ", "portfolio_id, "
    ),
    "account_snapshot": ACCOUNT_SNAPSHOT,
    "account_readings": ACCOUNT_READINGS,
    "balance_rules": BALANCE_RULES,
    "latest_snapshot": LATEST,
    "latest_snapshot_descent": LATEST,
    "morning_readings": MORNING,
    "date_spine": SPINE,
    "reading_times": READING_TIMES,
    "payload_parse": PAYLOAD_PARSE,
    "payload_records": PAYLOAD_RECORDS,
    "payload_snapshot": PAYLOAD_SNAPSHOT,
    "payload_files": PAYLOAD_FILES,
    "landed_names": LANDED_NAMES,
    "landing_roundtrip": EVENT_ROWS,
    "landing_by_position": BY_POSITION,
    "incremental_load": EVENT_ROWS,
    "landed_discovery": LANDED_DISCOVERY,
    "landed_file": LANDED_FILE,
    "last_reports": LAST_REPORTS,
    "extract_load": EXTRACT_LOAD,
    "repeated_load": EXTRACT_LOAD,
    "history_schema_change": HISTORY_SCHEMA_CHANGE,
    "extract_load_by_map": EXTRACT_LOAD_BY_MAP,
    "snapshot_append": SNAPSHOT_APPEND,
    "model_run": _model_run(),
}
