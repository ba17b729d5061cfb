"""Shards as a slow stream: a shard is a folder of files, and its name, once it is there, a micro-batch; the checkpoint is what a resumed run goes on from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.functions.scalars import processed_budget
from rasterweave.model import classes
from rasterweave.operators import selection
from rasterweave.sources import sinks


def land(df: DataFrame, path: str, shard_col: str, order: list[str]) -> None:
    """Writes the files of each shard, one shard after the other, as they arrive, and then its name."""
    for shard in order:
        df.where(F.col(shard_col) == shard).write.parquet(f"{path}/data/{shard}")
        df.sparkSession.createDataFrame([(shard,)], "shard string").coalesce(1).write.mode("append").parquet(f"{path}/names")


def drain(spark: SparkSession, path: str, schema, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Runs each shard that is there; a second call with the same checkpoint finds nothing new."""

    def run(names: DataFrame, number: int) -> None:
        for row in names.collect():  # one name
            each(spark.read.schema(schema).parquet(f"{path}/data/{row.shard}"), number)

    names = spark.readStream.schema("shard string").option("maxFilesPerTrigger", 1).parquet(f"{path}/names")
    names.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def incremental_shards(spark: SparkSession, source: str, schema, checkpoint: str, log: str, preprocess: Callable[[DataFrame], DataFrame], train: Callable[[DataFrame], DataFrame]) -> None:
    """A row per shard in log (batch, status, tiles). A shard whose preprocessing fails is skipped; a failure in training stops the run."""

    def each(batch: DataFrame, number: int) -> None:
        try:
            ready = preprocess(batch)
            n, status = ready.count(), "done"
        except ValueError as e:
            n, status = 0, f"skipped: {e}"
        if status == "done":
            train(ready).count()
        row = spark.createDataFrame([(number, status, n)], "batch bigint, status string, tiles bigint")
        row.write.mode("overwrite").parquet(f"{log}/batch={number}")

    drain(spark, source, schema, checkpoint, each)


SLICE = "id string, source string, trow bigint, tcol bigint, coverage_ratio double, class_ids array<int>, shard string"


def stream_replay(spark: SparkSession, source: str, schema, checkpoint: str, store: str, weights: dict[int, float], n: int) -> None:
    """After each shard its stratified slice becomes the newest version of that shard in the store; a repeated batch replaces its own."""

    def each(batch: DataFrame, number: int) -> None:
        chosen = selection.replay_select(batch, classes(spark), weights, n)
        sinks.write_slice(chosen.select("id", "source", "trow", "tcol", "coverage_ratio", "class_ids", "shard"), store, number)

    drain(spark, source, schema, checkpoint, each)


def stream_budget(spark: SparkSession, source: str, schema, checkpoint: str, log: str, ceiling: int, bytes_per_tile: int, store: str, weights: dict[int, float], n: int) -> None:
    """For each shard the bytes that the replay store leaves, as the batches before have left it, and how many tiles fit; then the shard's own slice joins the store.

    A batch that is repeated, after it broke off or was not marked as done, reads the store as of the batch before it and so tells the same budget.
    """

    def each(batch: DataFrame, number: int) -> None:
        held = sinks.slices(spark, store, before=number).agg(F.coalesce(F.sum("tiles"), F.lit(0)).alias("n")).first().n
        budget = processed_budget(F.lit(ceiling).cast("bigint"), F.lit(held * bytes_per_tile).cast("bigint"))
        sized = batch.select("id", "shard")
        row = sized.groupBy("shard").agg(F.count("*").alias("tiles")).select("shard", F.lit(number).cast("bigint").alias("batch"), budget.alias("budget"), F.least("tiles", F.ceil(budget / bytes_per_tile)).alias("admitted"))
        row.write.mode("overwrite").parquet(f"{log}/batch={number}")
        chosen = selection.replay_select(batch, classes(spark), weights, n)
        sinks.write_slice(chosen.select("id", "source", "trow", "tcol", "coverage_ratio", "class_ids", "shard"), store, number)

    drain(spark, source, schema, checkpoint, each)
