"""Progress of runs as streams of metric events, with batch twins for backfill and comparison."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

INTERVAL = "2 hours"


def progress_snapshots(events: DataFrame, interval: str = INTERVAL) -> DataFrame:
    """run_id, start, value, n: per run and tumbling window the latest value. On a stream with watermark each window is told once, when it is over."""
    return events.groupBy(F.window("ts", interval), "run_id").agg(F.max_by("value", "ts").alias("value"), F.count("*").alias("n")).select("run_id", F.col("window.start").alias("start"), "value", "n")


def snapshots_until_done(events: DataFrame, interval: str = INTERVAL) -> DataFrame:
    """As progress_snapshots, from events with done: the window in which a run ends, and later ones, are not told. Batch twin of the stream."""
    ends = events.where("done").groupBy("run_id").agg(F.min("ts").alias("_end"))
    latest = F.max_by("value", F.struct("ts", "event_id"))
    told = events.groupBy(F.window("ts", interval).alias("w"), "run_id").agg(latest.alias("value"), F.count("*").alias("n"))
    return told.join(ends, "run_id", "left").where(F.col("_end").isNull() | (F.col("_end") >= F.col("w.end"))).select("run_id", F.col("w.start").alias("start"), "value", "n")


class Ended(StatefulProcessor):
    """Closed windows of the runs of a bucket, those of a batch at once: per ended run the window it ends in; that window and later ones are not told. A window comes no later than those after it, so an end is known in time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ends = handle.getMapState("ends", "run string", "start bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        frame = pd.concat(rows, ignore_index=True)
        ends = {run: self.ends.getValue((run,))[0] for run in frame["run"].unique() if self.ends.containsKey((run,))}
        for run, start in frame[frame["done"].astype(bool)].groupby("run")["start_us"].min().items():
            if run not in ends or start < ends[run]:
                ends[run] = int(start)
                self.ends.updateValue((run,), (int(start),))
        told = frame[frame["start_us"] < frame["run"].map(ends).astype(float).fillna(np.inf)]
        if len(told):
            yield told[["run_id", "start_us", "value", "n"]]

    def close(self) -> None:
        pass


def snapshots_until_done_stream(events: DataFrame, seconds: int = 7200, buckets: int = 1024) -> DataFrame:
    """A stream of (run_id, event_id, ts, value, done) with a watermark as run_id, start, value, n: each window once, when the watermark has passed it, and none that ends after its run.

    Spark's own aggregation holds the open windows; what it closes goes to Python by buckets of runs, of which a task holds one at a time. An ended run leaves one number behind.
    """
    use_rocksdb(events.sparkSession)
    latest = F.max_by("value", F.struct("ts", "event_id"))
    closed = events.groupBy(F.window("ts", f"{seconds} seconds"), "run_id").agg(latest.alias("value"), F.count("*").alias("n"), F.coalesce(F.bool_or("done"), F.lit(False)).alias("done"))
    run = F.coalesce(F.concat(F.lit("="), F.col("run_id")), F.lit(""))
    rows = closed.select(F.pmod(F.xxhash64("run_id"), F.lit(buckets)).alias("bucket"), run.alias("run"), "run_id", F.unix_micros("window.start").alias("start_us"), "value", "n", "done")
    told = rows.groupBy("bucket").transformWithStateInPandas(Ended(), "run_id string, start_us bigint, value double, n bigint", "Append", "None")
    return told.select("run_id", F.timestamp_micros("start_us").alias("start"), "value", "n")


def watermarked(events: DataFrame, delay: str = INTERVAL) -> DataFrame:
    return events.withWatermark("ts", delay)


def alert_once(events: DataFrame) -> DataFrame:
    """Batch twin: the first failure of each run."""
    first = Window.partitionBy("run_id").orderBy("ts", "event_id")
    return events.withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn")


class AlertOnce(StatefulProcessor):
    """Per run: whether its failure was told. The flag has no lifetime of its own; it goes when the watermark has passed the run's end, after which nothing of the run can come."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("told", "told boolean, end bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        told, end = self.state.get() if self.state.exists() else (False, None)
        first, before = None, end
        for frame in rows:
            over = frame.loc[frame["done"], "us"]
            end = end if not len(over) else int(over.min()) if end is None else min(end, int(over.min()))
            failed = frame[frame["failed"]]
            if len(failed):
                own = failed.sort_values(["us", "event_id"]).iloc[:1]
                at = (int(own["us"].iloc[0]), int(own["event_id"].iloc[0]))
                first = (at, own) if first is None or at < first[0] else first
        now = first is not None and not told and (end is None or first[0][0] <= end)
        self.state.update((told or now, end))
        if end is not None and before != end:
            self.handle.registerTimer(end // 1000 + 1)
        if now:
            yield first[1][["run_id", "event_id", "value"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def alert_once_stream(events: DataFrame) -> DataFrame:
    """A stream of (run_id, event_id, ts, value, failed, done) with a watermark, in order of arrival, as run_id, event_id, value: the first failure of each run, however far apart failures are; none after its end."""
    use_rocksdb(events.sparkSession)
    rows = events.select("run_id", "event_id", "ts", F.unix_micros("ts").alias("us"), "value", "failed", "done")
    return rows.groupBy("run_id").transformWithStateInPandas(AlertOnce(), "run_id string, event_id bigint, value double", "Append", "EventTime")


class LogTail(StatefulProcessor):
    """Per run: its last lines, a bounded ring; a line that tells a failure comes out with those up to it."""

    def __init__(self, lines: int, most: int):
        self.lines, self.most = lines, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", "line_no bigint, line string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        ring = deque(self.ring.get() if self.ring.exists() else (), maxlen=self.lines)
        new = sorted((int(n), line, bool(f)) for frame in rows for n, line, f in zip(frame["line_no"], frame["line"], frame["failed"], strict=True))
        out = []
        for n, line, failed in new:
            ring.append((n, line))
            if failed:
                out.append((key[0], n, "\n".join(x[1] for x in ring)[: self.most]))
        self.ring.put([tuple(x) for x in ring])
        if out:
            yield pd.DataFrame(out, columns=["run_id", "line_no", "tail"])

    def close(self) -> None:
        pass


def failures_with_tail(lines: DataFrame, n: int = 40, most: int = 2000) -> DataFrame:
    """A stream of log lines (run_id, line_no, line, failed), in order of arrival, as run_id, line_no and tail for each failed line: the first `most` characters of the last n lines up to it. A task holds the lines that a run adds in one micro-batch."""
    use_rocksdb(lines.sparkSession)
    return lines.select("run_id", "line_no", "line", "failed").groupBy("run_id").transformWithStateInPandas(LogTail(n, most), "run_id string, line_no bigint, tail string", "Append", "None")


def suppress_after_done(events: DataFrame) -> DataFrame:
    """Events of a run before and at its first done flag."""
    before = Window.partitionBy("run_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    return events.withColumn("over", F.coalesce(F.max(F.col("done").cast("int")).over(before), F.lit(0))).where("over = 0").drop("over")


def upto(frame: pd.DataFrame, at: tuple) -> pd.DataFrame:
    """The rows of a frame that stand at (ts, event_id) or before."""
    return frame[(frame["ts"] < at[0]) | ((frame["ts"] == at[0]) & (frame["event_id"] <= at[1]))]


class UntilDone(StatefulProcessor):
    """Per run: whether it is done; emits its events before and at the first done flag."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("done", "done boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        """Frame by frame: what stands before the first done flag so far is held back as long as an earlier one may come in this batch, the rest is let go."""
        if self.state.exists():
            return
        first, held = None, []
        for frame in rows:
            over = frame[frame["done"]]
            if len(over):
                at = min(zip(over["ts"], over["event_id"], strict=True))
                if first is None or at < first:
                    first, held = at, [upto(x, at) for x in held]
            held.append(frame if first is None else upto(frame, first))
        if first is not None:
            self.state.update((True,))
        yield from (x for x in held if len(x))

    def close(self) -> None:
        pass


def suppress_after_done_stream(events: DataFrame) -> DataFrame:
    """A stream of (run_id, event_id, ts, done, ...), in order of arrival, without what comes after a run's first done flag."""
    use_rocksdb(events.sparkSession)
    return events.groupBy("run_id").transformWithStateInPandas(UntilDone(), events.schema, "Append", "None")


class EarlyStop(StatefulProcessor):
    """Per run: best value so far (strictly greater, from 0), epochs since; emits each epoch, and stops once. A batch's epochs of a run are held as two packed numbers each, what is told is made piece by piece."""

    def __init__(self, patience: int, piece: int = 50_000):
        self.patience, self.piece = patience, piece

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("best", "best double, best_epoch int, stopped boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        best, best_epoch, stopped = self.state.get() if self.state.exists() else (0.0, 0, False)
        packed = [(frame["epoch"].to_numpy(np.int32, copy=True), frame["val_miou"].to_numpy(float, copy=True)) for frame in rows]
        epochs, values = (np.concatenate([x[i] for x in packed]) for i in (0, 1))
        del packed
        order = np.lexsort((values, epochs))
        for begin in range(0, len(order), self.piece):
            at = order[begin : begin + self.piece]
            epoch, value = epochs[at], values[at]
            tops = np.fmax.accumulate(np.append(best, value))  # the best before each epoch, and after the last
            last = np.maximum.accumulate(np.where(value > tops[:-1], np.arange(len(at)), -1))  # the place of the latest improvement
            since = epoch - np.where(last >= 0, epoch[last], best_epoch)
            now = np.zeros(len(at), dtype=bool)
            if not stopped and (since >= self.patience).any():
                now[np.argmax(since >= self.patience)] = stopped = True
            best, best_epoch = float(tops[-1]), int(epoch[-1] - since[-1])
            yield pd.DataFrame({"run_id": key[0], "epoch": epoch, "best": tops[1:], "since": since.astype(np.int32), "stop": now})
        self.state.update((best, best_epoch, stopped))

    def close(self) -> None:
        pass


def stream_early_stop(epochs: DataFrame, patience: int = 12) -> DataFrame:
    """A keyed stream of (run_id, epoch, val_miou), epochs in order of arrival, with best, since and stop."""
    use_rocksdb(epochs.sparkSession)
    return epochs.groupBy("run_id").transformWithStateInPandas(EarlyStop(patience), "run_id string, epoch int, best double, since int, stop boolean", "Append", "None")


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def drained(stream: DataFrame, checkpoint: str, out: str) -> DataFrame:
    """What a stream appends until its input is used up."""
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)
