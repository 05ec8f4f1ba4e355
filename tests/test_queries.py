"""Every query of the radar library against DuckDB on the smallest tables."""

import duckdb
import pytest

from fathomline import queries, queries_echoes, queries_products  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(float(f"{r[i]:.10g}") + 0.0 if isinstance(r[i], float) else r[i] for i in order)) for r in data)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, db, name):
    df = queries.queries()[name](spark, SF)
    got = db.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, got.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql()) - {"beta5_retracking"}))
def test_others_run(spark, name):
    assert queries.queries()[name](spark, SF).count() > 0
