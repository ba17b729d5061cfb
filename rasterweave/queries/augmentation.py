"""Augmentation over the small tiles of 8 x 8 pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.fixtures import fixture, oracle
from rasterweave.operators import augment, programs, spatial
from rasterweave.queries.aggregations import rounded
from rasterweave.registry import query

COLUMNS = ("tile_id", "band", "r", "c", "v")


def px(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_px").select(*COLUMNS)


def out(df: DataFrame) -> DataFrame:
    return rounded(df.select(*COLUMNS), "v")


def _h(seed: str, *parts: str) -> str:
    return f"cast(concat('0x', substr(md5(concat_ws(':', '{seed}', {', '.join(f'cast({p} as varchar)' for p in parts)})), 1, 8)) as bigint)"


def _u(seed: str, *parts: str) -> str:
    return f"({_h(seed, *parts)} / 4294967296e0)"


def _moved(r: str, c: str) -> str:
    return oracle(f"select tile_id, band, cast({r} as int) r, cast({c} as int) c, round(v, 6) v from fx_px", "fx_px")


def _remapped(sr: str, sc: str, **ctes: str) -> str:
    return oracle(f"select t.tile_id, t.band, t.r, t.c, round(coalesce(s.v, 0), 6) v from (select *, cast(floor({sr} + 0.5e0) as int) sr, cast(floor({sc} + 0.5e0) as int) sc from fx_px) t left join fx_px s on s.tile_id = t.tile_id and s.band = t.band and s.r = t.sr and s.c = t.sc", "fx_px", **ctes)


_OPS = "select * from (values " + ", ".join(f"('{n}', {p}e0)" for n, p in augment.OPERATIONS) + ") as t(op, p)"


@query(oracle(f"select tile_id, op, round({_u('43', '1', 'tile_id', 'op')}, 9) u from (select distinct tile_id from fx_px), ops where {_u('42', '1', 'tile_id', 'op')} < p", "fx_px", ops=_OPS))
def augment_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(augment.augment_plan(px(spark, sf_dir).select("tile_id").distinct(), 1), "u", digits=9)


@query(_moved("r", "7 - c"))
def hflip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(augment.moved(px(spark, sf_dir), "hflip", 8))


@query(_moved("7 - r", "c"))
def vflip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(augment.moved(px(spark, sf_dir), "vflip", 8))


@query(_moved("7 - c", "r"))
def rot90(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(augment.moved(px(spark, sf_dir), "rot90", 8))


@query(_moved("c", "r"))
def transpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(augment.moved(px(spark, sf_dir), "transpose", 8))


_Y, _X = "(r - 3.5e0 - 0.5e0)", "(c - 3.5e0 + 1.0e0 - 0.1e0 * (r - 3.5e0 - 0.5e0))"


@query(_remapped(f"(cos(radians(20e0)) * {_Y} - sin(radians(20e0)) * {_X}) / 1.1e0 + 3.5e0", f"(sin(radians(20e0)) * {_Y} + cos(radians(20e0)) * {_X}) / 1.1e0 + 3.5e0"))
def affine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(augment.affine(px(spark, sf_dir), 8, 1.1, 20.0, (0.5, -1.0), 0.1))


_NOISE = f"select tile_id, r, c, {_u('42', 'tile_id', '0', 'r', 'c')} * 2 - 1 x, {_u('42', 'tile_id', '1', 'r', 'c')} * 2 - 1 y from (select distinct tile_id, r, c from fx_px)"
_FIELD = "select tile_id, r, c, sum(x * w) / sum(w) dr, sum(y * w) / sum(w) dc from (select a.tile_id, a.r, a.c, b.x, b.y, exp(-((a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c)) / 72e0) w from noise a join noise b on a.tile_id = b.tile_id) group by 1, 2, 3"


@query(oracle("select p.tile_id, p.band, p.r, p.c, round(coalesce(s.v, 0), 6) v from fx_px p join field f on f.tile_id = p.tile_id and f.r = p.r and f.c = p.c left join fx_px s on s.tile_id = p.tile_id and s.band = p.band and s.r = cast(floor(p.r + 60 * dr + 0.5e0) as int) and s.c = cast(floor(p.c + 60 * dc + 0.5e0) as int)", "fx_px", noise=_NOISE, field=_FIELD))
def elastic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(augment.elastic(px(spark, sf_dir), 8))


def _stretch(axis: str) -> str:
    length = "[" + ", ".join(f"(1 + ({_u('42', 'tile_id', repr(axis), str(i))} * 2 - 1) * 0.2e0)" for i in range(5)) + "]"
    k = f"cast(least(floor({axis} / 1.6e0), 4) as int)"
    total = lambda x: f"coalesce(list_sum({x}), 0)"
    return f"({total(f'{length}[1:{k}]')} + ({axis} / 1.6e0 - {k}) * {length}[{k} + 1]) * 8 / {total(length)}"


@query(_remapped(_stretch("r"), _stretch("c")))
def grid_distortion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(augment.grid_distortion(px(spark, sf_dir), 8))


_GROW = "(1 + 0.15e0 * (((c - 3.5e0) / 3.5e0) * ((c - 3.5e0) / 3.5e0) + ((r - 3.5e0) / 3.5e0) * ((r - 3.5e0) / 3.5e0)))"


@query(_remapped(f"3.5e0 + (r - 3.5e0) * {_GROW}", f"3.5e0 + (c - 3.5e0) * {_GROW}"))
def optical_distortion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(augment.optical_distortion(px(spark, sf_dir), 8))


@query(oracle("select tile_id, band, r, c, round(case when band <= 3 then v * (1 + 0.2e0) + (-0.1e0) else v end, 6) v from fx_px", "fx_px"))
def brightness_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(augment.brightness_contrast(px(spark, sf_dir), 0.2, -0.1))


_UNIT = "select tile_id, r, c, " + ", ".join(f"least(greatest(max(v) filter (where band = {i}) + 0.5e0, 0), 1) {n}" for i, n in enumerate(("red", "green", "blue"), 1)) + " from fx_px group by 1, 2, 3"
_HSV = "select *, greatest(red, green, blue) hi, greatest(red, green, blue) - least(red, green, blue) d from unit"
_MOVED = """select tile_id, r, c, case when hh < 0 then hh + 6 when hh >= 6 then hh - 6 else hh end h, least(greatest(case when hi > 0 then d / hi else 0 end + 0.1e0, 0), 1) s, least(greatest(hi - 0.05e0, 0), 1) v from (
 select *, 0.25e0 + case when d = 0 then 0 when hi = red then (green - blue) / d when hi = green then (blue - red) / d + 2 else (red - green) / d + 4 end hh from hsv)"""


def _channel(n: int) -> str:
    k = f"(case when h + {n} >= 6 then h + {n} - 6 else h + {n} end)"
    return f"round(v - v * s * greatest(0, least({k}, 4 - {k}, 1)), 6)"


@query(oracle(f"select tile_id, r, c, {_channel(5)} red, {_channel(3)} green, {_channel(1)} blue from mv", "fx_px", unit=_UNIT, hsv=_HSV, mv=_MOVED))
def hue_saturation_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = lambda i: F.least(F.greatest(F.max(F.when(F.col("band") == i, F.col("v"))) + 0.5, F.lit(0.0)), F.lit(1.0))
    colours = px(spark, sf_dir).groupBy("tile_id", "r", "c").agg(unit(1).alias("red"), unit(2).alias("green"), unit(3).alias("blue"))
    return rounded(augment.hue_saturation_value(colours, 0.25, 0.1, -0.05), "red", "green", "blue")


_LEVELS = "select tile_id, band, r, c, greatest(least(cast(floor(least(greatest(v + 0.5e0, 0), 1) * 256) as int), 255), 0) l from fx_px"
_HIST = "select tile_id, band, r // 4 cr, c // 4 cc, l, least(count(*), 1) held, sum(count(*) - least(count(*), 1)) over (partition by tile_id, band, cr, cc) cut from levels group by 1, 2, 3, 4, 5"
_CORNERS = "select range i, k, least(greatest(cast(floor((i + 0.5e0) / 4 - 0.5e0) as int) + k, 0), 1) cell, case k when 0 then 1 - ((i + 0.5e0) / 4 - 0.5e0 - floor((i + 0.5e0) / 4 - 0.5e0)) else (i + 0.5e0) / 4 - 0.5e0 - floor((i + 0.5e0) / 4 - 0.5e0) end w from range(8), (select range k from range(2))"


@query(oracle("""select tile_id, band, r, c, round(sum(w * (below + (l + 1) * cut / 256e0) / 16e0), 6) v from (select p.tile_id, p.band, p.r, p.c, p.l, a.k ka, b.k kb, any_value(a.w * b.w) w, coalesce(sum(h.held) filter (where h.l <= p.l), 0) below, any_value(h.cut) cut
 from levels p join corners a on a.i = p.r join corners b on b.i = p.c join hist h on h.tile_id = p.tile_id and h.band = p.band and h.cr = a.cell and h.cc = b.cell group by 1, 2, 3, 4, 5, 6, 7) group by 1, 2, 3, 4""", "fx_px", levels=_LEVELS, hist=_HIST, corners=_CORNERS))  # fmt: skip
def clahe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In cells of 4 x 4 pixels; a tile of 8 has no 8 x 8 cells worth the name."""
    unit = px(spark, sf_dir).withColumn("v", F.least(F.greatest(F.col("v") + 0.5, F.lit(0.0)), F.lit(1.0)))
    return out(augment.clahe(unit, 8, cells=2))


@query(oracle(f"select tile_id, band, r, c, round(v + 0.05e0 * sqrt(-2 * ln(({_h('42a', 'tile_id', 'band', 'r', 'c')} + 1) / 4294967296e0)) * cos(2 * pi() * {_u('42b', 'tile_id', 'band', 'r', 'c')}), 6) v from fx_px", "fx_px"))
def gauss_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(augment.gauss_noise(px(spark, sf_dir)))


_KERNEL = "select i, j, exp(-(i * i + j * j) / (2 * 0.8e0 * 0.8e0)) w from (select range - 1 i from range(3)), (select range - 1 j from range(3))"
_BLUR = "select t.tile_id, t.band, t.r, t.c, sum(s.v * w) / sum(w) b from fx_px t, kernel k join fx_px s on s.tile_id = t.tile_id and s.band = t.band and s.r = t.r + i and s.c = t.c + j group by 1, 2, 3, 4"


@query(oracle("select tile_id, band, r, c, round(b, 6) v from blur", "fx_px", kernel=_KERNEL, blur=_BLUR))
def gaussian_blur(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(augment.gaussian_blur(px(spark, sf_dir), 8))


@query(oracle("select tile_id, band, r, c, round(v + 0.3e0 * (v - b), 6) v from fx_px join blur using (tile_id, band, r, c)", "fx_px", kernel=_KERNEL, blur=_BLUR))
def sharpen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(augment.sharpen(px(spark, sf_dir), 8))


_HOLES = f"select tile_id, {_h('42r', 'tile_id', 'k')} % 8 r0, {_h('42c', 'tile_id', 'k')} % 8 c0, 1 + {_h('42h', 'tile_id', 'k')} % 3 h, 1 + {_h('42w', 'tile_id', 'k')} % 3 w from (select tile_id, unnest(generate_series(1, 1 + {_h('42n', 'tile_id')} % 3)) k from (select distinct tile_id from fx_px))"


@query(oracle("select tile_id, band, r, c, round(case when exists (select 1 from holes h where h.tile_id = p.tile_id and r between r0 and r0 + h - 1 and c between c0 and c0 + w - 1) then 0 else v end, 6) v from fx_px p", "fx_px", holes=_HOLES))
def coarse_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = px(spark, sf_dir)
    return out(augment.coarse_dropout(pixels, augment.holes(pixels.select("tile_id").distinct(), 8)))


_CROSS = " + ".join(f"case when r + 0.5e0 >= least({y0}, {y1}) and r + 0.5e0 < greatest({y0}, {y1}) and {x0} + (r + 0.5e0 - {y0}) * ({x1} - {x0}) / cast({y1} - {y0} as double) > c + 0.5e0 then 1 else 0 end" for x0, y0, x1, y1 in (("a", "0", "7", "3"), ("7", "3", "1", "8"), ("1", "8", "a", "0")))


@query(oracle(f"select tile_id, band, r, c, round(case when band <= 3 and ({_CROSS}) % 2 = 1 then v * 0.5e0 else v end, 6) v from (select *, tile_id % 5 a from fx_px)", "fx_px"))
def random_shadow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A triangle per tile, with a corner that depends on the tile."""
    pixels = px(spark, sf_dir)
    a = F.col("tile_id") % 5
    edge = lambda x0, y0, x1, y1: F.struct(x0.alias("x0"), F.lit(y0).alias("y0"), x1.alias("x1"), F.lit(y1).alias("y1"))
    at = lambda n: F.lit(n).cast("bigint")
    triangle = F.explode(F.array(edge(a, 0, at(7), 3), edge(at(7), 3, at(1), 8), edge(at(1), 8, a, 0)))
    edges = pixels.select("tile_id").distinct().select("tile_id", triangle.alias("e")).select("tile_id", "e.*")
    return out(augment.random_shadow(pixels, spatial.rasterize_polygons(edges, "tile_id", height=8, width=8)))


# --- programs: parameters, and what they do to packed tiles -------------------------------------------------------

EPOCHS = [1, 2]


def _ranges() -> list[tuple[str, int, str, str, float, float]]:
    """op, k, name, kind (u: uniform, w: whole, o: odd window, c: constant), low, high of every parameter of an 8 x 8 tile's program."""
    out = [("rot90", 0, "k", "w", 0, 3)]
    out += [("affine", k, name, "u", lo, hi) for k, (name, lo, hi) in enumerate((("sy", 0.85, 1.15), ("sx", 0.85, 1.15), ("turn", -20, 20), ("dy", -0.06, 0.06), ("dx", -0.06, 0.06), ("hy", -5, 5), ("hx", -5, 5)))]
    out += [("elastic", 0, "noise", "w", 0, 2147483646), ("elastic", 1, "", "c", 60, 60), ("elastic", 2, "", "c", 6, 6)]
    out += [("grid_distortion", 5 * (axis == "c") + i, f"{axis}{i}", "u", 0.8, 1.2) for axis in "rc" for i in range(5)]
    out += [("optical_distortion", k, name, "u", -lim, lim) for k, (name, lim) in enumerate((("k", 0.15), ("dy", 0.1), ("dx", 0.1)))]
    out += [("brightness_contrast", k, name, "u", -0.25, 0.25) for k, name in enumerate(("contrast", "brightness"))]
    out += [("hue_saturation_value", k, name, "u", -lim, lim) for k, (name, lim) in enumerate((("hue", 10 / 30), ("saturation", 20 / 255), ("value", 15 / 255)))]
    out += [("clahe", 0, "clip", "u", 1, 3), ("clahe", 1, "", "c", 2, 2), ("gauss_noise", 0, "noise", "w", 0, 2147483646), ("gauss_noise", 1, "sigma", "u", 0.01, 0.05)]
    out += [("gaussian_blur", 0, "window", "o", 1, 2), ("sharpen", 0, "alpha", "u", 0.1, 0.3), ("sharpen", 1, "lightness", "u", 0.8, 1.2), ("coarse_dropout", 0, "n", "w", 1, 6)]
    out += [("coarse_dropout", 1 + 4 * i + j, f"{name}{i}", "w", *((1, 1) if name in "hw" else (0, 7))) for i in range(6) for j, name in enumerate("rchw")]
    return out + [("random_shadow", 0, "n", "w", 1, 3)] + [("random_shadow", 1 + 2 * i + j, f"{axis}{i}", "u", 0, 8) for i in range(15) for j, axis in enumerate("yx")]


_RANGES = "select * from (values " + ", ".join(f"('{op}', {k}, '{name}', '{kind}', {float(lo)!r}e0, {float(hi)!r}e0)" for op, k, name, kind, lo, hi in _ranges()) + ") as t(op, k, name, kind, lo, hi)"
_DRAWN = "cast(concat('0x', substr(md5(concat_ws(':', concat('42', op, '.', {}), cast(epoch as varchar), cast(tile_id as varchar))), 1, 8)) as bigint)"
_AT = _DRAWN.format("name")


@query(oracle(f"""select tile_id, epoch, op, k, round(case kind when 'u' then lo + (hi - lo) * ({_AT} / 4294967296e0) when 'w' then lo + {_AT} % cast(hi - lo + 1 as bigint) when 'o' then 1 + 2 * (1 + {_AT} % 2) when 'c' then lo end, 8) as value
from (select distinct tile_id from fx_px), (select unnest([1, 2]) epoch), ops left join ranges using (op) where {_DRAWN.format("'on'")} / 4294967296e0 < p""", "fx_px", ops=_OPS, ranges=_RANGES))  # fmt: skip
def augment_program(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per parameter of every step, or one with nulls for a step without any."""
    plans = programs.programs(px(spark, sf_dir).select("tile_id").distinct(), EPOCHS, 8)
    steps = plans.select("tile_id", "epoch", F.explode("steps").alias("s"))
    return rounded(steps.select("tile_id", "epoch", "s.op", F.posexplode_outer("s.p").alias("k", "value")), "value", digits=8)


def _p(op: str, name: str, lo: float, hi: float) -> str:
    return f"({float(lo)!r}e0 + ({float(hi)!r}e0 - ({float(lo)!r}e0)) * {_u(f'42{op}.{name}', 'epoch', 'tile_id')})"


def _composed() -> dict[str, str]:
    """CTEs s0, s1, ...: source places of all target places, taken back through the geometric steps from the last to the first; null once outside."""
    chance = dict(augment.OPERATIONS)
    on = lambda op: f"{_u(f'42{op}.on', 'epoch', 'tile_id')} < {chance[op]}e0"
    base = _h("42elastic.noise", "epoch", "tile_id") + " % 2147483647"
    rough = "select tile_id, epoch, a, r, c, (x * x + 69621 * x + 12345) % 2147483647 / 2147483647e0 * 2 - 1 u from (select tile_id, epoch, a, r, c, (x * x + 48271 * x + 12345) % 2147483647 x from (select tile_id, epoch, a, r, c, (base + 7919 * (a * 64 + r * 8 + c)) % 2147483647 x from bent, (select unnest([0, 1]) a), (select unnest(range(8)) r), (select unnest(range(8)) c)))"
    ctes = {
        "runs": "select tile_id, epoch from (select distinct tile_id from fx_px), (select unnest([1, 2]) epoch)", "bent": f"select tile_id, epoch, {base} base from runs where {on('elastic')}", "rough": rough,
        "bend": "select x.tile_id, x.epoch, x.r fr, x.c fc, sum(w * y.u) filter (where y.a = 0) / sum(w) filter (where y.a = 0) dr, sum(w * y.u) filter (where y.a = 1) / sum(w) filter (where y.a = 1) dc from (select * from rough where a = 0) x join (select * from rough) y using (tile_id, epoch), lateral (select exp(-((x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c)) / 72e0) w) group by 1, 2, 3, 4",
        "s0": "select tile_id, epoch, tr, tc, cast(tr as double) r, cast(tc as double) c from runs, (select unnest(range(8)) tr), (select unnest(range(8)) tc)",
    }
    k, gy, gx = _p("optical_distortion", "k", -0.15, 0.15), _p("optical_distortion", "dy", -0.1, 0.1), _p("optical_distortion", "dx", -0.1, 0.1)
    y, x = f"(r - 3.5e0 - {gy} * 8)", f"(c - 3.5e0 - {gx} * 8)"
    grow = f"(1 + {k} * (({y} / 3.5e0) * ({y} / 3.5e0) + ({x} / 3.5e0) * ({x} / 3.5e0)))"

    def cells(axis: str) -> str:
        length = "[" + ", ".join(f"(1 + {_p('grid_distortion', f'{axis}{i}', -0.2, 0.2)})" for i in range(5)) + "]"
        at = f"cast(greatest(least(floor({axis} / 1.6e0), 4), 0) as int)"
        return f"(coalesce(list_sum({length}[1:{at}]), 0) + ({axis} / 1.6e0 - {at}) * {length}[{at} + 1]) * 8 / list_sum({length})"

    a = {n: _p("affine", n, lo, hi) for n, lo, hi in (("sy", 0.85, 1.15), ("sx", 0.85, 1.15), ("turn", -20, 20), ("dy", -0.06, 0.06), ("dx", -0.06, 0.06), ("hy", -5, 5), ("hx", -5, 5))}
    ay, ax = f"(r - 3.5e0 - {a['dy']} * 8)", f"(c - 3.5e0 - {a['dx']} * 8)"
    ax = f"({ax} - tan(radians({a['hx']})) * {ay})"
    ay = f"({ay} - tan(radians({a['hy']})) * {ax})"
    turns = f"({_h('42rot90.k', 'epoch', 'tile_id')} % 4)"
    maps = [
        ("optical_distortion", f"3.5e0 + {gy} * 8 + {y} * {grow}", f"3.5e0 + {gx} * 8 + {x} * {grow}"), ("grid_distortion", cells("r"), cells("c")), ("elastic", "r + 60 * dr", "c + 60 * dc"),
        ("affine", f"(cos(radians({a['turn']})) * {ay} - sin(radians({a['turn']})) * {ax}) / {a['sy']} + 3.5e0", f"(sin(radians({a['turn']})) * {ay} + cos(radians({a['turn']})) * {ax}) / {a['sx']} + 3.5e0"),
        ("transpose", "c", "r"), ("rot90", f"case {turns} when 0 then r when 1 then c when 2 then 7 - r else 7 - c end", f"case {turns} when 0 then c when 1 then 7 - r when 2 then 7 - c else r end"), ("vflip", "7 - r", "c"), ("hflip", "r", "7 - c"),
    ]
    for i, (op, r, c) in enumerate(maps):
        source = f"s{i}" if op != "elastic" else f"s{i} left join bend using (tile_id, epoch)"
        near = " where dr is null or r is null or (fr = greatest(least(floor(r + 0.5e0), 7), 0) and fc = greatest(least(floor(c + 0.5e0), 7), 0))" if op == "elastic" else ""
        ctes[f"s{i + 1}"] = f"select distinct tile_id, epoch, tr, tc, case when inside then r end r, case when inside then c end c from (select *, r >= -0.5e0 and r < 7.5e0 and c >= -0.5e0 and c < 7.5e0 inside from (select tile_id, epoch, tr, tc, case when {on(op)} then {r} else r end r, case when {on(op)} then {c} else c end c from {source}{near}))"
    ctes["placed"] = "select *, cast(floor(r + 0.5e0) as int) sr, cast(floor(c + 0.5e0) as int) sc from s8"
    return ctes


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed tiles; front is how many of the first three bands a tile has."""
    packed = programs.packed_tiles(px(spark, sf_dir), fixture(spark, sf_dir, "fx_scores").select("tile_id", "r", "c", F.col("target").alias("class_id")))
    return packed.withColumn("front", F.size(F.filter("bands", lambda b: b <= 3)))


@query(oracle("""select p.tile_id, p.epoch, cast(p.tr as int) r, cast(p.tc as int) c, b.band, round(case when b.band = 4 then own.v else coalesce(v.v, 0) end, 6) v, cast(coalesce(m.target, 0) as int) class_id
from placed p, (select unnest([1, 2, 3, 4]) band) b join fx_px own on own.tile_id = p.tile_id and own.band = b.band and own.r = p.tr and own.c = p.tc
left join fx_px v on v.tile_id = p.tile_id and v.band = b.band and v.r = p.sr and v.c = p.sc left join fx_scores m on m.tile_id = p.tile_id and m.r = p.sr and m.c = p.sc""", "fx_px", "fx_scores", **_composed()))  # fmt: skip
def augment_geometric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image and mask of every tile in two epochs after the geometric steps of their programs, taken from the nearest pixel; the fourth band stays."""
    done = programs.augmented(tiles(spark, sf_dir), EPOCHS, 8, front="front", between=False, only=tuple(programs.MAPS))
    at = done.select("tile_id", "epoch", "bands", "image", F.posexplode("mask").alias("at", "class_id"))
    rows = at.select("tile_id", "epoch", F.floor(F.col("at") / 8).cast("int").alias("r"), (F.col("at") % 8).cast("int").alias("c"), "class_id", F.explode(F.transform("bands", lambda b, k: F.struct(b.alias("band"), F.get("image", k * 64 + F.col("at")).alias("v")))).alias("x"))
    return rounded(rows.select("tile_id", "epoch", "r", "c", "x.band", "x.v", "class_id"), "v")


@query()
def augment_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole programs over every tile in two epochs: the steps, the mean of each band and the classes of the mask. Compared with plain steps in the tests."""
    done = programs.augmented(tiles(spark, sf_dir), EPOCHS, 8, front="front")
    mean = lambda b: F.aggregate(F.slice("image", b * 64 + 1, 64), F.lit(0.0), lambda a, x: a + x) / 64
    return done.select("tile_id", "epoch", F.array_join("ops", "+").alias("ops"), F.array(*[F.round(mean(b), 6) for b in range(4)]).alias("band_means"), F.sort_array(F.array_distinct("mask")).alias("class_ids"))
