"""Mixing sources to target weights by the cube method.

Every document enters the mix floor(r) times for sure and once more with probability r - floor(r), where r is its
source's target over its source's size. The cube method makes the extra draws: inclusion probabilities move along the
null space of the balancing constraints (documents and words of the source) until all but a few are 0 or 1. Blocks
of documents are worked on side by side; what a block leaves open, two documents at most, meets in the next round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterweave.llm.common import saved, table, text_bytes

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BLOCK = 4096
HELD = 64
NEAR = 1e-9


def sizes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the text, with its number of words as size (0 for null)."""
    rest = [c for c in docs.columns if c not in (text_col, "size")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pa.array([len(x.split()) for x in text_bytes(batch.column(len(rest)))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], n], names=[*rest, "size"])

    schema = docs.select(*rest, F.lit(0).cast("bigint").alias("size")).schema
    return docs.select(*rest, text_col).mapInArrow(count, schema)


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target: the total of all sizes shared by weight, no source above most times its size.

    Sources by code point, null last, take the weights in turn. Sharing the excess anew until none is above ends where every
    source has min(most * size, level * weight); sources reach their stop in the order of stop / weight, so running
    sums over that order find the level. The table has a row per source only.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    ranked = by_source.withColumn("weight", weight.cast("double")).withColumn("stop", F.col("source_size") * float(most))
    filled = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # the first source, in this order, that does not reach its stop sets the level
    levelled = ranked.withColumn("level", level).withColumn("open", F.col("stop") >= F.col("level") * F.col("weight"))
    final = F.min(F.when(F.col("open"), F.struct(F.col("stop") / F.col("weight"), F.col("level")))).over(everything)["level"]
    return levelled.withColumn("target", F.least("stop", F.coalesce(final * F.col("weight"), F.col("stop")))).select("source", "source_size", "target")


def uniform(*parts: object) -> float:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=7).digest(), "big") / (1 << 56)


def flight(pi: np.ndarray, x: np.ndarray, seed: str) -> np.ndarray:
    """Moves pi, keeping its sum and its product with x, until at most two entries lie strictly between 0 and 1.

    Three open entries have a direction in the null space of the two constraints; a step to the nearer or the farther face of
    the cube, with odds that keep every expectation, closes one of them at least.
    """
    pi, draws = pi.copy(), np.random.default_rng(int(uniform(seed, len(pi)) * (1 << 52)))
    pi[pi < NEAR], pi[pi > 1 - NEAR] = 0.0, 1.0
    todo = np.flatnonzero((pi > 0) & (pi < 1)).tolist()[::-1]
    chance = draws.random(len(todo) + 1).tolist()
    p, size = pi.tolist(), x.tolist()
    active: list[int] = []
    while todo or len(active) == 3:
        while todo and len(active) < 3:
            active.append(todo.pop())
        if len(active) < 3:
            break
        a, b, c = active
        u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip(active, u, strict=True) if d)
        down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip(active, u, strict=True) if d)
        move = up if chance.pop() * (up + down) < down else -down
        for i, d in zip(active, u, strict=True):
            p[i] += move * d
            p[i] = 0.0 if p[i] < NEAR else 1.0 if p[i] > 1 - NEAR else p[i]
        active = [i for i in active if 0 < p[i] < 1]
    return np.array(p)


def landing(copies: np.ndarray, x: np.ndarray, goal: float, most: int) -> np.ndarray:
    """Whole copies whose words come near goal: rounds what the flight left open, then changes one or two documents by a copy while that helps.

    It works on the few documents of the last round alone.
    """
    out = np.rint(copies)
    for _ in range(64):
        error = float(out @ x) - goal
        up, down = np.flatnonzero((out < most) & (x > 0)), np.flatnonzero((out > 0) & (x > 0))
        at, sign = np.concatenate((up, down, [-1])), np.concatenate((np.ones(len(up)), -np.ones(len(down)), [0.0]))
        change = sign * np.concatenate((x[up], x[down], [0.0]))
        left = np.abs(error + change[:, None] + change[None, :])
        left[at[:, None] == at[None, :]] = np.inf
        i, j = np.unravel_index(int(np.argmin(left)), left.shape)
        if left[i, j] >= abs(error) - 0.5:
            break
        for k in {int(i), int(j)}:
            if at[k] >= 0:
                out[at[k]] += sign[k]
    return out


def fly(last: bool, most: int):
    def run(rows: pa.Table) -> pa.Table:
        """The block with pi after the flight; whole numbers stay whole beside nulls."""
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("rank", "ascending"), ("doc_id", "ascending"), ("size", "ascending")]))
        pi, x = rows.column("pi").to_numpy(), rows.column("size").to_numpy().astype(float)
        out = flight(pi, x, f"{rows.column('source')[0].as_py()}|{rows.column('block')[0].as_py()}")
        if last:
            sure = rows.column("sure").to_numpy().astype(float)
            out = landing(sure + out, x, float((sure + pi) @ x), most) - sure
        return rows.set_column(rows.schema.get_field_index("pi"), rows.schema.field("pi"), pa.array(out, pa.float64()))

    return run


def told_apart(rows: DataFrame, by: list[str]) -> DataFrame:
    """rows (with part, the number of the task that wrote them) with copy, which numbers those that agree on the columns of by.

    A task's rows are numbered among themselves and put behind those of the tasks before, so that no task gets all of them.
    """
    counts = rows.groupBy("part", *by).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ahead = counts.select(F.col("part").alias("_part"), *[F.col(c).alias(f"_{c}") for c in by], F.coalesce(before, F.lit(0)).alias("_before"))
    own = rows.withColumn("copy", F.row_number().over(Window.partitionBy("part", *by).orderBy(F.lit(0))))
    alike = [own[c].eqNullSafe(ahead[f"_{c}"]) for c in ["part", *by]]
    return own.join(ahead.hint("merge"), reduce(Column.__and__, alike)).withColumn("copy", F.col("copy") + F.col("_before")).select(*rows.columns, "copy")


def mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, row_col: str | None = None) -> DataFrame:
    """sized (doc_id, source, size, ...) with source_size, target and copies, the times that the mix takes the document; and with row_col, if one is named.

    A null source is a source of its own; null ids and repeated rows are documents like any others; documents of size 0, and all
    when every size is 0, are never taken; no documents make an empty mix. copies is at most `most`, and reruns agree: order and draws come from hashes.
    """
    carried = [row_col] if row_col else []
    base = saved(sized.select("doc_id", "source", "size", *carried, F.spark_partition_id().alias("part")), "sizes")
    shares = saved(targets(base, weights, most), "targets")
    n_blocks = F.broadcast(shares) if shares.count() <= 100_000 else shares
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # a rate within rounding of a whole number is one
    whole = F.floor(rate + 1e-9)
    rank = F.xxhash64("doc_id", "size", "copy", F.lit("mix"))
    rows = told_apart(base, ["doc_id", "source", "size"]).drop("part")
    drawn = rows.join(n_blocks, rows["source"].eqNullSafe(shares["source"])).select(
        "doc_id", rows["source"], "size", *carried, "source_size", "target", whole.cast("int").alias("sure"), F.when(F.col("size") > 0, F.greatest(rate - whole, F.lit(0.0))).otherwise(0.0).alias("pi"), rank.alias("rank"),
    )
    drawn = saved(drawn, "drawn")
    counted = drawn.groupBy(F.col("source").alias("counted_source")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.ceil(F.count("*") / HELD).alias("apart"))
    dealt = drawn.join(F.broadcast(counted) if shares.count() <= 100_000 else counted, drawn["source"].eqNullSafe(counted["counted_source"])).drop("counted_source")
    # about HELD documents of each source wait for the last round, where the landing may change them
    block = F.when(F.pmod(F.xxhash64("rank"), F.col("apart")) == 0, F.lit(-1)).otherwise(F.pmod("rank", F.col("blocks")))
    dealt = saved(dealt.withColumn("block", block.cast("bigint")).drop("blocks", "apart"), "dealt")
    held, open_, done = dealt.where("block < 0"), dealt.where("block >= 0"), []
    for level in range(3):  # blocks of 4096 leave 2 each; 2048 blocks meet in one; the rest of a source lands
        last = level == 2
        if last:
            open_ = open_.unionByName(held).withColumn("block", F.lit(0).cast("bigint"))
        flown = saved(open_.groupBy("source", "block").applyInArrow(fly(last, most), dealt.schema), f"flight{level}")
        done.append(flown if last else flown.where("pi = 0 or pi = 1"))
        open_ = flown.where("pi > 0 and pi < 1").withColumn("block", F.floor(F.col("block") / (BLOCK // 2)))
    taken = F.when(F.col("size") > 0, F.col("sure") + F.rint("pi").cast("int")).otherwise(0)
    return reduce(DataFrame.unionByName, done).select("doc_id", "source", "size", *carried, "source_size", "target", taken.alias("copies"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(sizes(docs)).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
