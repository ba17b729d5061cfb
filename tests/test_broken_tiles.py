"""Queries over tiles that lack bands, the last one as well as those in between, against their SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from rasterweave.registry import core_oracle_sql, core_queries

FULL = Path("/root/testdata/sf0.001")
#: One of four bands is missing, all but the last, and the last two of the last tile.
MISSING = (13, 20, 21, 22)
CASES = ["softmax", "blend_windows", "dice_loss", "focal_loss", "combined_loss", "to_rgb8", "sample_report", "incremental_run", "overlay_blend", "select_bands", "transpose_layout", "score_tiles", "map_tiles", "predict", "predict_blocks", "augment_geometric"]


@pytest.fixture(scope="module")
def broken(tmp_path_factory):
    at = tmp_path_factory.mktemp("broken")
    for table in FULL.glob("*.parquet"):
        if table.name != "embeddings.parquet":
            (at / table.name).symlink_to(table)
    duckdb.connect().execute(f"copy (select * from '{FULL}/embeddings.parquet' where vec_id not in {MISSING} and vec_id < (select max(vec_id) - 1 from '{FULL}/embeddings.parquet') order by vec_id) to '{at}/embeddings.parquet'")
    return str(at)


def plain(v):
    return "[" + ",".join(map(plain, v)) + "]" if isinstance(v, list | tuple) else repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", CASES)
def test_tiles_without_all_bands(spark, broken, name):
    df, con = core_queries()[name](spark, broken), duckdb.connect()
    for table in Path(broken).glob("*.parquet"):
        con.execute(f"create view {table.stem} as select * from '{table}'")
    columns, cursor = sorted(df.columns), con.execute(core_oracle_sql()[name])
    names = [x[0] for x in cursor.description]
    expected = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == expected


def test_a_classifier_leaves_out_pixels_without_all_bands(spark, broken):
    queries = core_queries()
    counts = {r.pred: r.n for r in queries["fit_pixel_classifier"](spark, broken).collect()}
    out = queries["predict_pixels"](spark, broken).collect()
    assert len(out) == sum(counts.values()) and counts[None] == sum(r.pred is None for r in out) == sum(r.tile_id in lacking(broken) for r in out) > 0
    assert all((r.pred is None) == (r.tile_id in lacking(broken)) for r in out)


def lacking(at: str) -> set[int]:
    return {r[0] for r in duckdb.sql(f"select vec_id // 4 from '{at}/embeddings.parquet' group by 1 having count(*) < 4").fetchall()}



def test_whole_programs_run_over_tiles_without_all_bands(spark, broken):
    assert core_queries()["augment_tiles"](spark, broken).count() == 2 * duckdb.sql(f"select count(distinct vec_id // 4) from '{broken}/embeddings.parquet'").fetchall()[0][0]
