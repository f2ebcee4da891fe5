"""The registered queries of this subpackage against their SQL."""

import duckdb
import pytest

from aurum.llm.catalog import ORACLE, QUERIES

SMOKE = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    got = QUERIES[name](spark, SMOKE)
    want = duck.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = ", ".join(f'"{c}"' for c in got.columns)
    rows = sorted((tuple(map(str, r)) for r in got.collect()))
    assert rows and rows == sorted(tuple(map(str, r)) for r in duck.sql(f"SELECT {cols} FROM want").fetchall())
