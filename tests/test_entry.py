"""Every registered query against its SQL twin."""

import functools
import math

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = "conversations documents embeddings"


@pytest.fixture(scope="module")
def sql(sf_dir):
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def shared():
    """What several queries of one flow begin with is made once."""
    with pytest.MonkeyPatch.context() as patch:
        for name in ("_clustered", "_products", "_seeds", "_coordinates", "_many_stop_words", "_loads", "_write_reviews", "_write_defects"):
            patch.setattr(contract, name, functools.cache(getattr(contract, name)))
        yield


def plain(value):
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def rows_of(table):
    names = sorted(table.column_names)
    return names, sorted(zip(*[[plain(v) for v in table[n].to_pylist()] for n in names]))


def own(names):
    """Without the queries of the subpackage that has its own tests."""
    added = contract._llm.queries() if contract._llm else {}
    return [n for n in names if n not in added]


def test_all_queries_have_a_twin():
    assert set(own(contract.queries())) == set(own(contract.oracle_sql()))


@pytest.mark.parametrize("name", own(contract.queries()))
def test_query_equals_sql(spark, sf_dir, sql, name):
    found = contract.queries()[name](spark, sf_dir).toArrow()
    expected = sql.sql(contract.oracle_sql()[name]).to_arrow_table()
    assert rows_of(found) == rows_of(expected)
    types = lambda t: {n: str(t.schema.field(n).type) for n in t.column_names}
    assert types(found) == types(expected)


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["product_id", "term", "tfidf"] and rows.count() > 0
