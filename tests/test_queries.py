"""Registered queries against their SQL oracles on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracles import TABLES, rows

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, db, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    wanted = rows(db.sql(f"select {quoted} from ({ORACLES[name]})").fetchall())
    assert wanted
    assert rows([tuple(r) for r in df.select(*columns).collect()]) == wanted
