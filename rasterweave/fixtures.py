"""Raster, vector, tile and run tables that are derived from the driver's tables, alike in Spark and in DuckDB."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from rasterweave.session import ship

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings")

_PX = """select cast(vec_id {div} 4 as bigint) tile_id, cast(vec_id % 4 + 1 as int) band, cast(pos {div} 8 as int) r, cast(pos % 8 as int) c,
 cast((vec_id {div} 4) {div} 10 * 8 + pos {div} 8 as bigint) gr, cast((vec_id {div} 4) % 10 * 8 + pos % 8 as bigint) gc,
 case when (vec_id {div} 4) % 10 = 0 or ((vec_id {div} 4) % 3 = 0 and pos < 16) then cast(0 as double) else cast(x as double) end v
from {source}"""
_META = """select {printf}('scene_%d_r%06d_c%06d', o_custkey % 20, o_orderkey {div} 100 * 448, o_orderkey % 100 * 448) id,
 concat('scene_', cast(o_custkey % 20 as {text})) source, concat('shard_', cast(o_orderkey % 4 + 1 as {text})) shard,
 o_orderkey {div} 100 * 448 trow, o_orderkey % 100 * 448 tcol, l.cov coverage_ratio, l.cls class_ids
from orders left join (select l_orderkey, cast(count_if(l_linestatus = 'F') as double) / count(*) cov,
  {classes} cls from lineitem group by l_orderkey) l on l.l_orderkey = o_orderkey"""
_SCORES = """select tile_id, r, c, {logits} logits,
 cast(case when (tile_id + r) % 17 = 0 then 255 else (tile_id + r {div} 2 + c {div} 2) % 4 end as int) target
from fx_px group by tile_id, r, c"""

_BOTH = {
    "fx_big_px": """select cast(l_suppkey % 4 as int) scene, cast(l_orderkey % 256 as int) prow, cast(l_partkey % 256 as int) pcol,
 max(l_quantity) b1, max(l_extendedprice) b2, max(l_discount) b3, max(l_tax) b4 from lineitem group by 1, 2, 3""",
    "fx_edges": """select fid, class_id, x x0, y y0, x + w x1, y + 1 y1 from fx_boxes where odd = 0
union all select fid, class_id, x + w, y + 1, x + 1, y + h from fx_boxes where odd = 0
union all select fid, class_id, x + 1, y + h, x, y from fx_boxes where odd = 0
union all select fid, class_id, x, y, x + w, y from fx_boxes where odd = 1
union all select fid, class_id, x + w, y, x + w, y + h from fx_boxes where odd = 1
union all select fid, class_id, x + w, y + h, x, y + h from fx_boxes where odd = 1
union all select fid, class_id, x, y + h, x, y from fx_boxes where odd = 1""",
    "fx_boxes": """select s_suppkey fid, cast(1 + s_suppkey % 3 as int) class_id, s_suppkey * 7 % 64 x, s_suppkey * 13 % 88 y,
  4 + s_suppkey % 8 w, 4 + s_suppkey % 6 h, s_suppkey % 2 odd from supplier""",
    "fx_rasters": """select concat('scene_', cast(c_custkey as varchar(12))) raster_id, cast(512 * (1 + k % 5) + 100 as int) width,
 cast(512 * (1 + k % 3) + 60 as int) height, 4 n_bands, 4 itemsize, cast(case when k % 4 = 0 then 4326 else 32644 end as int) crs,
 cast(k % 5 * 20 as double) minx, cast(floor(k / 5) * 20 as double) miny,
 cast(k % 5 * 20 + 18 as double) maxx, cast(floor(k / 5) * 20 + 18 as double) maxy,
 case when k % 5 = 0 then cast(null as double) else cast(0 as double) end nodata from (select c_custkey, c_custkey % 25 k from customer)""",
    "fx_epochs": """select event_type run_id, cast(row_number() over (partition by event_type order by ts, event_id) as int) epoch, ts,
 cast(round(value * 20) as bigint) miou_e4, value / 500 val_miou, 1 - value / 500 val_loss, event_id from events""",
    "fx_log": """select run_id, epoch line_no, concat('Epoch ', lpad(cast(epoch as varchar(12)), 5, '0'), '  tr_loss=0.', lpad(cast(9999 - miou_e4 as varchar(12)), 4, '0'),
 '  tr_mIoU=0.', lpad(cast(miou_e4 as varchar(12)), 4, '0'), '  val_loss=0.', lpad(cast(9999 - miou_e4 as varchar(12)), 4, '0'),
 '  val_mIoU=0.', lpad(cast(miou_e4 as varchar(12)), 4, '0')) line from fx_epochs""",
    "fx_files": """select concat('/raw/shard_', cast(doc_id % 4 + 1 as varchar(12)), '/', source, '_', cast(doc_id as varchar(12)),
 case doc_id % 3 when 0 then '.tif' when 1 then '.tiff' else '.shp' end) path, n_chars * 1000 length from documents""",
    "fx_prompts": """select cast(c_custkey as int) seq, case when k % 5 = 4 then 'bad prompt' when k = 7 then '3,4,forest'
 when k = 8 then 'x,4,road' else concat(cast(k * 3 as varchar(12)), ',', cast(k * 2 as varchar(12)), ', ',
  case c_custkey % 3 when 0 then 'builtup' when 1 then 'road' else 'waterbody' end) end txt from (select c_custkey, c_custkey % 25 k from customer)""",
    "fx_classes": """select * from (values (0, 'background', 'Background', 0, 0.3e0, 0.4e0), (1, 'builtup', 'Built-up', 1, 1.5e0, 1.2e0), (2, 'road', 'Road', 3, 5.0e0, 4.0e0), (3, 'waterbody', 'Water Body', 2, 3.0e0, 2.0e0)) as t(class_id, class_name, label, priority, sampler_w, loss_w)""",
}
SPARK = _BOTH | {
    "fx_px": _PX.format(div="div", source="embeddings lateral view posexplode(embedding) t as pos, x"),
    "fx_tile_meta": _META.format(printf="format_string", div="div", text="string", classes="sort_array(collect_set(cast(l_linenumber % 4 as int)))"),
    "fx_scores": _SCORES.format(logits="transform(sort_array(collect_list(struct(band, v))), s -> s.v)", div="div"),
}
DUCKDB = _BOTH | {
    "fx_px": _PX.format(div="//", source="(select vec_id, unnest(embedding) x, generate_subscripts(embedding, 1) - 1 pos from embeddings)"),
    "fx_tile_meta": _META.format(printf="printf", div="//", text="varchar", classes="list_sort(list_distinct(list(cast(l_linenumber % 4 as int))))"),
    "fx_scores": _SCORES.format(logits="list(v order by band)", div="//"),
}
#: What each view needs before it.
NEEDS = {"fx_scores": ("fx_px",), "fx_edges": ("fx_boxes",), "fx_log": ("fx_epochs",)}


@lru_cache(maxsize=None)
def needed(names: tuple[str, ...]) -> tuple[str, ...]:
    out: list[str] = []
    for name in names:
        for x in (*needed(NEEDS.get(name, ())), name):
            if x not in out:
                out.append(x)
    return tuple(out)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or one of the driver's tables."""
    if name in TABLES:
        return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    text = SPARK[name]
    inner = {x: fixture(spark, sf_dir, x) for x in (*NEEDS.get(name, ()), *(t for t in TABLES if f"from {t}" in text or f"join {t}" in text))}
    for x in inner:
        for word in ("from ", "join "):
            text = text.replace(f"{word}{x}", f"{word}{{{x}}}")
    return spark.sql(text, **inner)


def oracle(body: str, *names: str, **ctes: str) -> str:
    """DuckDB SQL: the named views and further ones, then the body."""
    views = [f"{x} as ({DUCKDB[x]})" for x in needed(names)] + [f"{k} as ({v})" for k, v in ctes.items()]
    return f"with {', '.join(views)} {body}" if views else body
