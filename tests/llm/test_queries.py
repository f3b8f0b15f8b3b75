"""Every SQL-expressible query against DuckDB on the smallest tables."""
import glob
import os

import duckdb
import pytest

from switchboard.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in registry.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rel = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = [tuple(r[names.index(c)] for c in cols) for r in rel.fetchall()]
    got = [tuple(r) for r in df.select(*cols).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
