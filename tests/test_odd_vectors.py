"""overlay_blend and to_rgb8 over odd vectors, against their SQL."""

from __future__ import annotations

import random
from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from rasterweave.registry import core_oracle_sql, core_queries


@pytest.mark.parametrize("name", ["overlay_blend", "to_rgb8"])
def test_odd_vectors(spark, tmp_path, name):
    """Missing, null, short and long vectors, null and non-finite components, negative and null ids; the last tile has two vectors."""
    draw = random.Random(6)
    odd = [float("nan"), float("inf"), float("-inf"), -0.0, 1.0, 1e30, None]
    rows = [{"vec_id": i, "embedding": [draw.uniform(-0.2, 1.2) for _ in range(64)]} for i in range(122) if i % 11]
    for k, row in enumerate(rows):
        if k % 9 == 1:
            row["embedding"] = None if k % 2 else row["embedding"][: draw.randrange(64)]
        elif k % 9 == 3:
            row["embedding"] = [draw.choice(odd) if draw.random() < 0.3 else x for x in row["embedding"]]
        elif k % 9 == 5:
            row["embedding"] += [0.3] * 10
        elif k % 9 == 7:
            row["vec_id"] = -row["vec_id"]
    rows[40]["vec_id"] = None
    pq.write_table(pa.Table.from_pylist(rows, pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32()))])), tmp_path / "embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet'")
    cursor = con.execute(core_oracle_sql()[name])
    names = [x[0] for x in cursor.description]
    df = core_queries()[name](spark, str(tmp_path))
    plain = lambda r: repr([list(x) if isinstance(x, list | tuple) else x for x in r])
    assert sorted(plain(r[c] for c in names) for r in df.collect()) == sorted(plain(r) for r in cursor.fetchall())
