"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import TABLES, rows_of  # noqa: E402
from shelfwise import catalog  # noqa: E402

SF = os.environ.get("SHELFWISE_TEST_SF", "/root/testdata/sf0.001")
QUERIES = catalog.queries()
ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield c
    c.close()


def test_every_survey_key_is_registered():
    assert len(QUERIES) == 190
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    if key not in ORACLES:
        assert len(s_rows) >= 0
        return
    cur = con.execute(ORACLES[key])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert rows_of(s_cols, s_rows) == rows_of(o_cols, o_rows)
