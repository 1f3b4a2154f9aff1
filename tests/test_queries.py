"""Every registered query against its DuckDB form on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SF_SMALL

# The text operators have tests of their own.
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name != "pipeline" and not name.startswith("op")}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{SF_SMALL}/events.parquet'")
    return con


def rows(df, columns):
    return sorted(map(tuple, df[columns].astype(str).values.tolist()))


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, duck, name):
    found = contract.queries()[name](spark, SF_SMALL).toPandas()
    expected = duck.sql(ORACLES[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    assert rows(found, columns) == rows(expected, columns)


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(contract.queries())


def test_entry(spark):
    row = contract.entry(spark).first()
    assert (row["n_clicks"], row["n_displays"], row["n_invalid"]) == (210, 188, 209)
