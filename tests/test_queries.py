"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import duckdb
import pandas as pd
import pytest

from tallygrid.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def plain(frame, columns):
    say = lambda v: "NULL" if pd.isna(v) else repr(float(v)) if isinstance(v, float) else str(v)
    return sorted(tuple(say(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, duck, data, name):
    got, want = registry.QUERIES[name](spark, data).toPandas(), duck.sql(registry.ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    number = lambda rows: [[float(v) if v not in ("NULL",) and v.replace(".", "", 1).replace("-", "", 1).replace("e", "", 1).isdigit() else v for v in r] for r in rows]
    assert number(plain(got, columns)) == number(plain(want, columns))


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
