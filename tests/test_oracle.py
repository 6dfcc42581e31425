"""Every registered query of the models against its SQL twin."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ledgerlane.oracle import ORACLE_SQL
from ledgerlane.queries import QUERIES
from tests.compare import given_tables, sorted_rows
from tests.conftest import SF_DIR

SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def tables():
    con = given_tables(SF_DIR)
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, tables, name):
    result = queries()[name](spark, SF_DIR)
    expected = tables.execute(oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in expected.description}
    expected = expected.df()

    described = {f.name: SQL_TYPES[f.dataType.simpleString()] for f in result.schema.fields}
    twin = dict(
        row[:2] for row in tables.execute(f"DESCRIBE {oracle_sql()[name]}").fetchall()
    )
    assert described == twin and set(types) == set(twin)

    actual = result.toPandas()
    assert len(actual) > 0
    assert sorted_rows(actual) == sorted_rows(expected)


@pytest.mark.parametrize(
    "name",
    [
        "account_snapshot",
        "extract_load",
        "gains_losses",
        "incremental_load",
        "landed_names",
        "networth_comparison_ages",
        "reading_times",
    ],
)
def test_session_time_zone_does_not_matter(spark, tables, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        actual = queries()[name](spark, SF_DIR).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted_rows(actual) == sorted_rows(tables.execute(oracle_sql()[name]).df())


def test_entry(spark):
    result = entry(spark)
    assert result.columns == [
        "portfolio_id",
        "date_value",
        "pre_investment",
        "post_investment",
        "gains_losses",
        "previous_day_gains",
    ]
    assert result.count() > 0
