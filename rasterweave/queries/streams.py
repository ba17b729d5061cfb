"""Streams, drained, and their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterweave.fixtures import fixture, oracle
from rasterweave.model import class_map
from rasterweave.operators import filters
from rasterweave.queries.aggregations import _RAREST
from rasterweave.queries.windows import _IMPROVED, _share, EARLY_SQL
from rasterweave.registry import query
from rasterweave.session import saved, scratch
from rasterweave.sources import sinks
from rasterweave.streaming import alerts, progress, shards

SHARDS = ["shard_1", "shard_2", "shard_3", "shard_4"]
CEILING, TILE_BYTES = 20 << 30, 4_456_448


def landed(spark: SparkSession, sf_dir: str) -> tuple[str, object]:
    meta = fixture(spark, sf_dir, "fx_tile_meta")
    path = scratch(spark, "landed")
    shards.land(meta, path, "shard", SHARDS)
    return path, meta.schema


@query(oracle("select cast(right(shard, 1) as bigint) - 1 batch, case when shard = 'shard_3' then 'skipped: no tiles' else 'done' end status, cast(count(*) filter (where shard <> 'shard_3') as bigint) tiles from fx_tile_meta group by shard", "fx_tile_meta"))
def incremental_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third shard's preprocessing fails here. A second run over the same checkpoint adds nothing."""
    path, schema = landed(spark, sf_dir)
    log, checkpoint = scratch(spark, "log"), scratch(spark, "checkpoint")

    def preprocess(batch: DataFrame) -> DataFrame:
        if not batch.where("shard = 'shard_3'").isEmpty():
            raise ValueError("no tiles")
        return filters.default_class_ids(batch)

    for _ in range(2):
        shards.incremental_shards(spark, path, schema, checkpoint, log, preprocess, lambda ready: ready.select("id"))
    return spark.read.parquet(f"{log}/*")


def metric_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("run_id"), "value")


@query("select event_type run_id, epoch_us(time_bucket(interval '2 hours', ts)) // 1000000 start_s, arg_max(value, ts) as value, cast(count(*) as bigint) n from events group by 1, 2")
def progress_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = progress.progress_snapshots(metric_events(spark, sf_dir))
    return snapshots.select("run_id", F.unix_timestamp("start").alias("start_s"), "value", "n")


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the runs of each user decade: a large purchase ends one, what follows belongs to the next. Other large values are failures."""
    large = F.col("event_type") == "purchase"
    events = fixture(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.floor(F.col("user_id") / 10).alias("of"), "value", (~large & (F.col("value") > 100)).alias("failed"), (large & (F.col("value") > 200)).alias("done"))
    before = Window.partitionBy("of").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    return events.select("event_id", "ts", F.concat(F.lit("run_"), "of", F.lit("_"), F.count_if("done").over(before)).alias("run_id"), "value", "failed", "done")


_RUNS = """select event_id, ts, concat('run_', cast(o as varchar), '_', cast(coalesce(count_if(done) over (partition by o order by ts, event_id rows between unbounded preceding and 1 preceding), 0) as varchar)) run_id, value, failed, done
from (select event_id, ts, user_id // 10 o, value, event_type <> 'purchase' and value > 100 failed, event_type = 'purchase' and value > 200 done from events)"""
_ENDS = f"select run_id, min(ts) over_at from ({_RUNS}) where done group by 1"
_UNTIL_DONE = f"select run_id, epoch_us(w) // 1000000 start_s, arg_max(value, row(ts, event_id)) as value, cast(count(*) as bigint) n from (select *, time_bucket(interval '2 hours', ts) w from ({_RUNS})) left join ({_ENDS}) using (run_id) where (over_at is null or over_at >= w + interval '2 hours')"


@query(f"{_UNTIL_DONE} group by 1, w")
def progress_until_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.snapshots_until_done(run_events(spark, sf_dir)).select("run_id", F.unix_timestamp("start").alias("start_s"), "value", "n")


def replayed(spark: SparkSession, rows: DataFrame, order: str, make, parts: int = 3) -> DataFrame:
    """What a stream over rows makes, stopped and resumed as the parts of rows, cut by order, arrive."""
    path, checkpoint, out = (scratch(spark, x) for x in ("arrived", "checkpoint", "made"))
    rows = saved(rows, "rows")  # it is read for the cuts and for each part
    cuts = rows.agg(F.percentile_approx(order, [i / parts for i in range(1, parts)])).first()[0]
    found = None
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = rows if low is None else rows.where(F.col(order) > F.lit(low))
        (part if high is None else part.where(F.col(order) <= F.lit(high))).write.mode("append").parquet(path)
        found = progress.drained(make(spark.readStream.schema(rows.schema).parquet(path)), checkpoint, out)
    return found


@query(f"{_UNTIL_DONE} and w + interval '2 hours' <= (select max(ts) from events) - interval '2 hours' group by 1, w")
def progress_snapshots_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that the watermark has passed, of runs that were not over by then."""
    out = replayed(spark, run_events(spark, sf_dir), "ts", lambda stream: progress.snapshots_until_done_stream(progress.watermarked(stream)))
    return out.select("run_id", F.unix_timestamp("start").alias("start_s"), "value", "n")


@query(oracle(EARLY_SQL.replace("epoch - coalesce(", "cast(epoch - coalesce(", 1).replace("0) since", "0) as int) since", 1), "fx_epochs", improved=_IMPROVED))
def stream_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a stream that is resumed as epochs arrive."""
    epochs = saved(fixture(spark, sf_dir, "fx_epochs").select("run_id", "epoch", "val_miou"), "numbered")
    path, checkpoint, out = (scratch(spark, x) for x in ("epochs", "checkpoint", "stops"))
    for part in ("epoch <= 10", "epoch > 10 and epoch <= 30", "epoch > 30"):
        epochs.where(part).write.mode("append").parquet(path)
        found = progress.drained(progress.stream_early_stop(spark.readStream.schema(epochs.schema).parquet(path)), checkpoint, out)
    return found


_SLICES = f"select shard, coverage, row_number() over (partition by shard, rarest order by coverage desc, id) rn, quota from (select id, shard, coalesce(coverage_ratio, 0e0) coverage, {_RAREST} rarest from fx_tile_meta) join (select class_id, {_share(300)} quota from fx_classes) on class_id = rarest"


@query(oracle("select shard, cast(count(*) as bigint) tiles, min(coverage) least_coverage from slices where rn <= quota group by 1", "fx_tile_meta", "fx_classes", slices=_SLICES))
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = landed(spark, sf_dir)
    store = scratch(spark, "store")
    shards.stream_replay(spark, path, schema, scratch(spark, "checkpoint"), store, class_map(4), 300)
    return sinks.read_slices(spark, store, shards.SLICE).groupBy("shard").agg(F.count("*").alias("tiles"), F.min("coverage_ratio").alias("least_coverage"))


_KEPT = f"select shard, rarest, least(count(*), any_value(quota)) n from (select shard, {_RAREST} rarest from fx_tile_meta) join (select class_id, {_share(300)} quota from fx_classes) on class_id = rarest group by 1, 2"
_STORED = f"select shard, cast(right(shard, 1) as bigint) - 1 b, count(*) n, greatest({CEILING} - {TILE_BYTES} * cast(coalesce((select sum(n) from kept k where k.shard < m.shard), 0) as bigint), 1073741824) budget from fx_tile_meta m group by 1, 2"


@query(oracle(f"select shard, b batch, cast(budget as bigint) budget, cast(least(n, ceil(budget / {TILE_BYTES}e0)) as bigint) admitted from stored", "fx_tile_meta", "fx_classes", kept=_KEPT, stored=_STORED))
def stream_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shard has tiles of every class here, so quotas are those of all classes."""
    path, schema = landed(spark, sf_dir)
    log = scratch(spark, "budgets")
    shards.stream_budget(spark, path, schema, scratch(spark, "checkpoint"), log, CEILING, TILE_BYTES, scratch(spark, "store"), class_map(4), 300)
    return spark.read.parquet(f"{log}/*")


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crash events: those of value above 100, of a run per user decade."""
    rows = fixture(spark, sf_dir, "events").where("value > 100").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("run_"), F.floor(F.col("user_id") / 10)).alias("run_id"), "value")
    return rows


_FAIL = "select event_id, ts, concat('run_', cast(user_id // 10 as varchar)) run_id, value from events where value > 100"


_FAILED_AT = "select * from fx_log where cast(regexp_extract(line, 'val_mIoU=([0-9.]+)', 1) as double) > 0.4e0"


@query(oracle("select f.run_id, cast(f.line_no as bigint) line_no, 'error' kind, 'critical' severity, concat('[', f.run_id, '] stopped at line ', cast(f.line_no as varchar)) subject, 'resume from the last checkpoint' next_step, left(string_agg(l.line, chr(10) order by l.line_no), 2000) tail from failed f join fx_log l on l.run_id = f.run_id and l.line_no between f.line_no - 39 and f.line_no group by 1, 2, 5", "fx_log", failed=_FAILED_AT))
def error_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a log that arrives in parts; one that tells of a value above 0.4 counts as a failure here."""
    lines = fixture(spark, sf_dir, "fx_log").select("run_id", F.col("line_no").cast("bigint").alias("line_no"), "line")
    marked = lines.withColumn("failed", F.regexp_extract("line", "val_mIoU=([0-9.]+)", 1).cast("double") > 0.4)
    return replayed(spark, marked, "line_no", lambda stream: alerts.error_rows(progress.failures_with_tail(stream)))


@query(f"select event_id, run_id, value from (select *, row_number() over (partition by run_id order by ts, event_id) rn from ({_FAIL})) where rn = 1")
def alert_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.alert_once(failures(spark, sf_dir)).select("event_id", "run_id", "value")


_UNTIL = "select event_id, user_id, event_type from (select *, coalesce(max(case when event_type = 'purchase' then 1 else 0 end) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding), 0) over_ from events) where over_ = 0"


@query(_UNTIL)
def suppress_after_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A purchase ends a user's run."""
    events = fixture(spark, sf_dir, "events").withColumn("run_id", F.col("user_id")).withColumn("done", F.col("event_type") == "purchase")
    return progress.suppress_after_done(events).select("event_id", "user_id", "event_type")


@query(f"select event_id, run_id, value from (select *, row_number() over (partition by run_id order by ts, event_id) rn from ({_RUNS}) left join ({_ENDS}) using (run_id) where failed and (over_at is null or ts <= over_at)) where rn = 1")
def alert_once_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first failure of each run up to its end, from events that arrive in parts, days apart."""
    return replayed(spark, run_events(spark, sf_dir), "ts", lambda stream: progress.alert_once_stream(progress.watermarked(stream))).select("event_id", "run_id", "value")


@query(_UNTIL)
def suppress_after_done_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As suppress_after_done, from a stream that is resumed when the later half of the events is there."""
    events = fixture(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", F.col("user_id").alias("run_id"), (F.col("event_type") == "purchase").alias("done"))
    path, checkpoint, out = (scratch(spark, x) for x in ("events", "checkpoint", "undone"))
    middle = events.agg(F.percentile_approx("ts", 0.5)).first()[0]
    for half in (F.col("ts") <= F.lit(middle), F.col("ts") > F.lit(middle)):
        events.where(half).write.mode("append").parquet(path)
        stream = progress.suppress_after_done_stream(spark.readStream.schema(events.schema).parquet(path))
        found = progress.drained(stream, checkpoint, out)
    return found.select("event_id", "user_id", "event_type")
