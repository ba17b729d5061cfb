"""Quotas, budgets, replay selection, splits, sampling, batches and ordered folds over runs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterweave.functions.scalars import allocate, hash_number, hash_uniform
from rasterweave.operators.stats import rarest_class, weight_map
from rasterweave.session import saved


def allocate_tokens(classes: DataFrame, n: int) -> DataFrame:
    """class_id, tokens: n by sampler weight, halves to even, 1 at least; what is left over or owed falls to class 0."""
    everything = Window.partitionBy()
    first = classes.withColumn("tokens", allocate(F.lit(n), F.col("sampler_w"), F.sum("sampler_w").over(everything)))
    rest = F.lit(n) - F.sum("tokens").over(everything)
    return first.withColumn("rest", rest).select("class_id", F.when(F.col("class_id") == 0, F.col("tokens") + F.col("rest")).otherwise(F.col("tokens")).alias("tokens"))


def first_of_class(tiles: DataFrame, quota: DataFrame, order: list[Column], most: int, quota_col: str) -> DataFrame:
    """The first quota tiles of each class (column rarest). The literal bound `most` lets Spark drop the rest of each partition before the shuffle."""
    ranked = tiles.withColumn("rn", F.row_number().over(Window.partitionBy("rarest").orderBy(*order))).where(F.col("rn") <= most)
    small = F.broadcast(quota.select(F.col("class_id").alias("rarest"), F.col(quota_col).alias("_quota")))
    return ranked.join(small, "rarest").where(F.col("rn") <= F.col("_quota")).drop("_quota", "rn")


def cap_by_tokens(tiles: DataFrame, tokens: DataFrame, n: int) -> DataFrame:
    return first_of_class(tiles, tokens, [F.col("id")], n, "tokens")


#: Bytes of input, as Spark expects to scan them, that one range of a global order takes.
RANGE_BYTES = 64 << 20


def ranges_for(df: DataFrame) -> int:
    """Ranges by the bytes of the tables that df reads, as many as there are shuffle partitions at least."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(read, 1 << 50) // RANGE_BYTES)


def prefix_sums(df: DataFrame, order: str, value: str) -> DataFrame:
    """df with before, the sum of the whole-numbered value (null: 0) over all rows earlier in order. Ranges of rows are summed where they are sorted; only their totals meet.

    The ranges are written once: dealt out twice, rows could fall to other ranges.
    """
    names = df.columns
    schema = df.select("*", F.lit(0).cast("bigint").alias("before"), F.lit(0).alias("_part")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows:
                own = pc.fill_null(batch.column(names.index(value)).cast(pa.int64()), 0)
                upto = pc.add(pc.cumulative_sum(own), total)
                total = upto[-1].as_py()
                yield pa.RecordBatch.from_arrays([*batch.columns, pc.subtract(upto, own), pa.array([part] * batch.num_rows, pa.int32())], names=[*names, "before", "_part"])

    ranged = saved(df.repartitionByRange(ranges_for(df), order).sortWithinPartitions(order).mapInArrow(run, schema), "ranges")
    totals = ranged.groupBy("_part").agg(F.sum(value).alias("_sum"))
    offsets = totals.select("_part", F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))  # a row per range
    return ranged.join(F.broadcast(offsets), "_part").withColumn("before", F.col("_offset") + F.col("before")).drop("_part", "_offset")


def cap_by_bytes(tiles: DataFrame, budget: int, order: str = "id", size: str = "bytes") -> DataFrame:
    """Tiles in order, as long as what was written before is below the budget."""
    return prefix_sums(tiles, order, size).where(F.col("before") < budget)


def allocate_replay(present: DataFrame, n: int) -> DataFrame:
    """class_id, quota of the present classes (class_id, sampler_w): as tokens are, without making up; while the sum is over n, the largest quota loses one, of equals the first."""
    everything = Window.partitionBy()
    first = present.withColumn("quota", allocate(F.lit(n), F.col("sampler_w"), F.sum("sampler_w").over(everything)))
    rows = first.agg(F.sort_array(F.collect_list(F.struct("class_id", "quota"))).alias("q"), F.sum("quota").alias("total"))  # a row per class

    def trim(q: Column, _: Column) -> Column:
        top = F.array_max(F.transform(q, lambda s: s["quota"]))
        at = F.array_position(F.transform(q, lambda s: s["quota"]), top) - 1
        return F.transform(q, lambda s, i: F.struct(s["class_id"].alias("class_id"), F.when(i == at, s["quota"] - 1).otherwise(s["quota"]).alias("quota")))

    excess = F.greatest(F.col("total") - n, F.lit(0))
    steps = F.when(excess > 0, F.sequence(F.lit(1).cast("bigint"), excess)).otherwise(F.array().cast("array<bigint>"))
    return rows.select(F.inline(F.aggregate(steps, F.col("q"), trim)))


def with_rarest(meta: DataFrame, weights: dict[int, float]) -> DataFrame:
    return meta.withColumn("rarest", rarest_class(F.coalesce("class_ids", F.array(F.lit(0))), weights))


def replay_select(meta: DataFrame, classes: DataFrame, weights: dict[int, float], n: int) -> DataFrame:
    """The tiles of largest coverage per rarest class, up to its quota; of equals the least id."""
    tiles = with_rarest(meta, weights).withColumn("coverage_ratio", F.coalesce("coverage_ratio", F.lit(0.0)))
    present = classes.join(tiles.select(F.col("rarest").alias("class_id")).distinct(), "class_id", "left_semi")
    return first_of_class(tiles, allocate_replay(present, n), [F.col("coverage_ratio").desc(), F.col("id")], n, "quota")


def early_stop(epochs: DataFrame, patience: int = 12, key: str = "run_id") -> DataFrame:
    """epochs with best (so far, from 0), improved, since (epochs since the best) and stop (the first epoch at which patience is used up)."""
    order = Window.partitionBy(key).orderBy("epoch")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = epochs.withColumn("improved", F.col("val_miou") > F.coalesce(F.greatest(F.max("val_miou").over(before), F.lit(0.0)), F.lit(0.0)))
    rows = rows.withColumn("best", F.greatest(F.max("val_miou").over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0)))
    rows = rows.withColumn("since", F.col("epoch") - F.coalesce(F.last(F.when(F.col("improved"), F.col("epoch")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    used = F.col("since") >= patience
    return rows.withColumn("used", used.cast("int")).withColumn("stop", (F.col("used") == 1) & (F.sum("used").over(order.rowsBetween(Window.unboundedPreceding, 0)) == 1)).drop("used")


def ema_warmup(series: DataFrame, key: str, step: str, value: str, decay: float = 0.9998) -> DataFrame:
    """key, steps, ema: e = d * e + (1 - d) * x with d = min(decay, (1 + s) / (10 + s)), s the row's number, from the first value on.

    Written out, a value counts (1 - d) times the product of all later d: running sums of logarithms give it. One task sorts a run, spilling if need be, but no row or state holds it.
    """
    order = Window.partitionBy(key).orderBy(step)
    rows = series.select(key, F.col(value).cast("double").alias("x"), F.row_number().over(order).cast("double").alias("s"), step)
    d = F.least(F.lit(decay), (1 + F.col("s")) / (10 + F.col("s")))
    rows = rows.withColumn("log_d", F.when(F.col("s") == 1, 0.0).otherwise(F.log(d))).withColumn("own", F.when(F.col("s") == 1, F.col("x")).otherwise((1 - d) * F.col("x")))
    later = F.coalesce(F.sum("log_d").over(Window.partitionBy(key).orderBy(F.col(step).desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return rows.withColumn("later", later).groupBy(key).agg(F.count("*").alias("steps"), F.sum(F.col("own") * F.exp("later")).alias("ema"))


def last_metric(lines: DataFrame, metrics: list[str]) -> DataFrame:
    """run_id and the last value of each metric in the log, as text; 0 if there is none."""
    value = lambda m: F.regexp_extract("line", rf"(?:^|\s){m}=([0-9.]+)", 1)
    return lines.groupBy("run_id").agg(*[F.coalesce(F.max_by(value(m), F.when(value(m) != "", F.col("line_no"))), F.lit("0")).alias(m) for m in metrics], F.count_if(F.col("line").startswith("Epoch ")).alias("epochs"))


def log_tail(lines: DataFrame, n: int = 40, most: int = 2000) -> DataFrame:
    """run_id, tail: the first `most` characters of the last n lines."""
    ranked = lines.withColumn("rn", F.row_number().over(Window.partitionBy("run_id").orderBy(F.col("line_no").desc()))).where(F.col("rn") <= n)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"]), "\n")
    return ranked.groupBy("run_id").agg(F.substring(text, 1, most).alias("tail"))


def seeded_order(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    return df.orderBy(hash_number(seed, key), key)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    return seeded_order(df, key, seed).limit(n)


def train_val_split(df: DataFrame, key: str, ratio: float = 0.2, seed: int = 42, stratify_by: str | None = None) -> DataFrame:
    """df with is_val: in hash order the first ceil(ratio * n), over all or within each stratum. key is unique."""
    hashed = df.withColumn("_h", F.concat(F.lpad(hash_number(seed, key).cast("string"), 10, "0"), F.lit(":"), F.col(key).cast("string")))
    if stratify_by:
        total = F.count("*").over(Window.partitionBy(stratify_by))
        place = F.row_number().over(Window.partitionBy(stratify_by).orderBy("_h"))
        return hashed.withColumn("is_val", place <= F.ceil(total * ratio)).drop("_h")
    ranked = prefix_sums(hashed.withColumn("_one", F.lit(1).cast("bigint")), "_h", "_one")
    total = F.broadcast(df.agg(F.ceil(F.count("*") * ratio).alias("_most")))
    return ranked.crossJoin(total).withColumn("is_val", F.col("before") < F.col("_most")).drop("_h", "_one", "before", "_most")


def group_split(tiles: DataFrame, ratio: float = 0.2, seed: int = 42) -> DataFrame:
    """The tiles of the sources that fall to validation: a source is on one side only."""
    chosen = train_val_split(tiles.select("source").distinct(), "source", ratio, seed).where("is_val")
    return tiles.join(chosen.select("source"), "source", "left_semi")


def replay_weights(tiles: DataFrame, weights: dict[int, float], ratio: float = 0.3, most: float = 5.0) -> DataFrame:
    """tiles (origin: current or replay) with w: a replay tile's class weight times min(nc * ratio / max(nr * (1 - ratio), 1), most)."""
    counts = tiles.agg(F.count_if(F.col("origin") == "current").alias("nc"), F.count_if(F.col("origin") == "replay").alias("nr"))
    own = weight_map(weights)[rarest_class(F.coalesce("class_ids", F.array(F.lit(0))), weights)]
    scale = F.least(F.col("nc") * ratio / F.greatest(F.col("nr") * (1 - ratio), F.lit(1.0)), F.lit(most))
    return tiles.crossJoin(F.broadcast(counts)).withColumn("w", F.when(F.col("origin") == "replay", scale * own).otherwise(own)).drop("nc", "nr")


def weighted_sample_replace(items: DataFrame, draws: DataFrame, key: str = "id", weight: str = "w", seed: int = 42) -> DataFrame:
    """draws (k) with the key drawn, in proportion to whole-numbered weights.

    An item holds an interval of the running total; a draw is a hash-uniform point. Intervals and points meet by
    buckets of equal width, one for each item, then by the exact bounds: so intervals stand in twice as many buckets as there are items at most.
    """
    spread = prefix_sums(items, key, weight).withColumn("_end", F.col("before") + F.col(weight))
    total = F.broadcast(items.agg(F.sum(weight).alias("_total"), F.count("*").alias("_items")))
    width = F.greatest(F.ceil(F.col("_total") / F.col("_items")), F.lit(1))
    held = spread.where(F.col(weight) > 0).crossJoin(total).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("before") / width), F.floor((F.col("_end") - 1) / width)))).drop("_total", "_items")
    points = draws.crossJoin(total).withColumn("_at", F.floor(hash_uniform(seed, "k") * F.col("_total"))).withColumn("_bucket", F.floor(F.col("_at") / width)).drop("_total", "_items")
    return points.join(held, "_bucket").where((F.col("_at") >= F.col("before")) & (F.col("_at") < F.col("_end"))).select("k", key)


def assign_batches(df: DataFrame, order: str, size: int = 2) -> DataFrame:
    """df with batch, from 0; an incomplete last batch is dropped."""
    numbered = prefix_sums(df.withColumn("_one", F.lit(1).cast("bigint")), order, "_one")
    total = F.broadcast(df.agg((F.floor(F.count("*") / size) * size).alias("_whole")))
    return numbered.crossJoin(total).where(F.col("before") < F.col("_whole")).withColumn("batch", F.floor(F.col("before") / size)).drop("_one", "before", "_whole")


def union_current_replay(current: DataFrame, replay: DataFrame, exclude_current: bool = False) -> DataFrame:
    """Both with their origin. exclude_current leaves replayed tiles out that are in the current shard too."""
    kept = replay.join(current.select("id"), "id", "left_anti") if exclude_current else replay
    return current.withColumn("origin", F.lit("current")).unionByName(kept.withColumn("origin", F.lit("replay")))
