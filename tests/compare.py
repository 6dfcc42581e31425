"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def given_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def sorted_rows(df: pd.DataFrame) -> list[tuple]:
    """Rows with columns in name order, as sorted comparable tuples."""
    df = df[sorted(df.columns)]
    rows = []
    for row in df.itertuples(index=False, name=None):
        rows.append(tuple("null" if pd.isna(v) else _plain(v) for v in row))
    return sorted(rows)


def _plain(value) -> str:
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, (int, float)) or hasattr(value, "dtype"):
        return repr(float(value))
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)
