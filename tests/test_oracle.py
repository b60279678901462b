"""Every registered query against its independent DuckDB SQL, at sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from basketlens.plans import oracle  # noqa: E402
from basketlens.plans.queries import QUERIES  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402
from panel_tools import SF_SMALL  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(oracle.all_sql())
    assert not missing, f"queries without oracle SQL: {sorted(missing)}"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    assert name in entry.queries() and name in entry.oracle_sql()
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [r.asDict() for r in sdf.collect()]
    cur = duck.execute(oracle.all_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    cols = sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(srows, cols, False) == rows_of(drows, cols, False)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["client", "date", "company", "user_type", "unique_users", "transactions", "amount",
                          "time_period"]
    assert df.count() > 0
