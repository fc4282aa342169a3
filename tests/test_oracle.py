"""Every registered query against its SQL twin in DuckDB, at the smallest scale."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from tidewire.plans.oracle import ORACLE
from tidewire.plans.queries import QUERIES

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def normal(table):
    frame = table.to_pandas(integer_object_nulls=True)
    frame = frame[sorted(frame.columns)]
    return sorted(
        tuple("NULL" if v is None or v is pd.NaT or v != v else str(v) for v in row)
        for row in frame.itertuples(index=False)
    )


def types(table):
    return {field.name: str(field.type).replace("large_", "") for field in table.schema}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf, duck, name):
    ours = QUERIES[name](spark, sf).toArrow()
    theirs = duck.sql(ORACLE[name]).to_arrow_table()
    assert types(ours) == types(theirs)
    assert normal(ours) == normal(theirs)


def test_entry(spark):
    assert contract.entry(spark).count() == 42
