"""The training-data queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from fathomline.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    df = queries.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    plain = lambda r: tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in r)
    assert sorted(map(plain, df.select(columns).collect())) == sorted(map(plain, want.fetchall()))
