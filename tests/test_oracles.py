"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import duckdb
import pytest

import __spark_entry__ as se
from runvault.plans.registry import ORACLES as REGISTERED_SQL, QUERIES as REGISTERED, load_all
from tools.oracle_check import TABLES, value_hash
from tests.conftest import SF_ORACLE, SF_SMALL

# the library's own queries; those of the llm subpackage are tested in tests/llm
load_all()
ORACLES = dict(REGISTERED_SQL)
QUERIES = dict(REGISTERED)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert value_hash(df.columns, rows) == value_hash(ocols, orows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns == ["rel_path", "n_bytes", "n_chunks", "md5"]


def test_every_query_registered_with_oracle_or_reason():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"diff_ordered"}
