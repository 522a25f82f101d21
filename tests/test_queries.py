"""Driver contract: entry(), queries() and oracle_sql(); every query with an
oracle matches DuckDB at sf0.001 (row count, columns, values)."""

import os

import pytest

import __spark_entry__ as E
from eventide.plans.compare import digest, duckdb_views, run_oracle

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "cnt"]
    assert df.count() > 0


def test_contract_shape():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF)


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                   "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    o_cols, o_rows = run_oracle(con, E.oracle_sql()[name])
    assert sorted(s_cols) == sorted(o_cols)
    s_types = {f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    o_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert s_types == o_types
    assert len(s_rows) == len(o_rows)
    assert digest(s_cols, s_rows)[0] == digest(o_cols, o_rows)[0]
