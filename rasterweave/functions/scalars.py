"""Scalar Column functions: ids, paths, sizes, budgets, log texts and hash uniforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GIB = 1 << 30


def hash_number(seed: int | str, *parts: Column | str) -> Column:
    """0 to 2**32 - 1, the same on every engine that has md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts])), 1, 8), 16, 10).cast("bigint")


def hash_uniform(seed: int | str, *parts: Column | str) -> Column:
    """In [0, 1)."""
    return hash_number(seed, *parts) / F.lit(float(1 << 32))


def tile_id(stem: Column | str, row: Column | str, col: Column | str) -> Column:
    return F.format_string("%s_r%06d_c%06d", stem, row, col)


def tile_stem(id_: Column, most: int = 20) -> Column:
    return F.substring(F.element_at(F.split(id_, "_r"), 1), 1, most)


def file_name(path: Column | str) -> Column:
    return F.substring_index(path, "/", -1)


def file_stem(path: Column | str) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def parent_folder(path: Column | str) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def size_text(n_bytes: Column) -> Column:
    """Bytes below a KB as they are, then with one decimal in KB, MB or GB; decimals come from whole tenths."""
    tenths = lambda unit: F.floor(n_bytes * 10 / unit).cast("bigint")
    shown = lambda unit, name: F.concat((tenths(unit) / 10).cast("bigint").cast("string"), F.lit("."), (tenths(unit) % 10).cast("string"), F.lit(name))
    return F.when(n_bytes < 1024, F.concat(n_bytes.cast("string"), F.lit(" B"))).when(n_bytes < 1 << 20, shown(1 << 10, " KB")).when(n_bytes < GIB, shown(1 << 20, " MB")).otherwise(shown(GIB, " GB"))


def tile_bytes(tile: Column, bands: Column | int) -> Column:
    """float32 image and one byte of mask per pixel."""
    return tile * tile * (F.lit(bands) * 4 + 1) if isinstance(bands, int) else tile * tile * (bands * 4 + 1)


def max_tiles(budget_gb: Column, one_tile: Column) -> Column:
    return F.floor(budget_gb * GIB / one_tile).cast("bigint")


def processed_budget(ceiling: Column, replay: Column) -> Column:
    """What replay leaves of the ceiling, a GiB at least."""
    return F.greatest(ceiling - replay, F.lit(GIB))


def progress_bar(step: Column, total: Column, width: int = 20) -> Column:
    """[####....] 40%; the percentage is truncated."""
    full = F.floor(step * width / total).cast("int")
    return F.concat(F.lit("["), F.repeat(F.lit("#"), full), F.repeat(F.lit("."), F.lit(width) - full), F.lit("] "), F.floor(step * 100 / total).cast("string"), F.lit("%"))


def miou_band(value: Column) -> Column:
    return F.when(value > 0.6, "good").when(value > 0.4, "fair").otherwise("poor")


def extract_metric(line: Column, name: str) -> Column:
    return F.regexp_extract(line, name + r"=([0-9.]+)", 1)


def epoch_line(epoch: Column, e4: dict[str, Column]) -> Column:
    """A log line from metrics in ten-thousandths."""
    parts: list[Column] = [F.lit("Epoch "), F.lpad(epoch.cast("string"), 5, "0")]
    for name, value in e4.items():
        parts += [F.lit(f"  {name}=0."), F.lpad(value.cast("string"), 4, "0")]
    return F.concat(*parts)


def allocate(n: Column, weight: Column, total_weight: Column) -> Column:
    """A class's share of n, halves to even, 1 at least."""
    return F.greatest(F.lit(1).cast("bigint"), F.bround(n * weight / total_weight).cast("bigint"))
