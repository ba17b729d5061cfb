"""Every registered core query against its DuckDB SQL on the smallest tables, as sorted rows."""

from __future__ import annotations

import math

import duckdb
import pytest

from rasterweave.registry import core_oracle_sql, core_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = core_queries(), core_oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, list | tuple):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in SQL:
        assert rows or name in ("stream_replay",)
        return
    cursor = duck.execute(SQL[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    expected = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert rows == expected
