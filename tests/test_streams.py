"""Streams against their batch twins, over arrivals that are cut anywhere, and shards whose batches break off and come again."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rasterweave.model import class_map, classes
from rasterweave.operators import selection
from rasterweave.plans import jobs
from rasterweave.queries import pipelines, streams
from rasterweave.sources import sinks
from rasterweave.streaming import progress, shards

SF = "/root/testdata/sf0.001"
EVENT = "event_id bigint, ts timestamp, run_id string, value double, failed boolean, done boolean"


def at(hours: float) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


def arrive(spark, tmp_path, schema: str, parts: list[list[tuple]], make) -> list:
    """What a stream makes of parts that arrive one after the other, resumed for each."""
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        out = progress.drained(make(spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in")), f"file://{tmp_path}/cp", f"file://{tmp_path}/out")
    return sorted(tuple(r) for r in out.collect())


def test_a_failure_is_told_once_whatever_the_gap_and_forgotten_with_its_run(spark, tmp_path):
    one = [(2, at(1), "a", 5.0, True, False), (1, at(0.5), "a", 4.0, True, False), (3, at(1), "b", 1.0, False, False)]
    later = [(4, at(200), "a", 6.0, True, False), (5, at(201), "b", 7.0, True, False), (6, at(202), "c", 1.0, False, True), (7, at(203), "c", 2.0, True, False)]
    end = [(8, at(300), "a", 1.0, False, True), (9, at(301), "b", 8.0, True, False)]
    got = arrive(spark, tmp_path, EVENT, [one, later, end, [(10, at(400), "d", 9.0, True, False)], [(11, at(500), "b", 9.5, True, False)]], lambda s: progress.alert_once_stream(progress.watermarked(s)))
    assert got == [("a", 1, 4.0), ("b", 5, 7.0), ("d", 10, 9.0)]


def test_snapshots_end_with_the_run(spark, tmp_path):
    events = [(i, at(i * 0.7), run, float(i), False, run == "x" and i == 9) for i in range(30) for run in ("x", "y")]
    cut = [events[:7], events[7:21], events[21:]]
    got = arrive(spark, tmp_path, EVENT, cut, lambda s: progress.snapshots_until_done_stream(progress.watermarked(s)))
    batch = progress.snapshots_until_done(spark.createDataFrame(events, EVENT))
    mark = at(29 * 0.7) - dt.timedelta(hours=2)
    expected = sorted(tuple(r) for r in batch.collect() if r.start + dt.timedelta(hours=2) <= mark)
    assert got == expected and max(r[1] for r in got if r[0] == "x") == at(4) and {r[0] for r in got} == {"x", "y"}


def test_the_tail_holds_the_last_lines_across_batches(spark, tmp_path):
    lines = [(run, n, f"{run} line {n} " + "x" * 60, n in (3, 44, 45, 90)) for n in range(1, 96) for run in ("p", "q")]
    parts = [lines[:50], lines[50:89], lines[89:]]
    got = arrive(spark, tmp_path, "run_id string, line_no bigint, line string, failed boolean", parts, progress.failures_with_tail)
    df = spark.createDataFrame([x[:3] for x in lines], "run_id string, line_no bigint, line string")
    expected = []
    for n in (3, 44, 45, 90):
        expected += [(r.run_id, n, r.tail) for r in selection.log_tail(df.where(F.col("line_no") <= n)).collect()]
    assert got == sorted(expected)


class Killed(Exception):
    pass


@pytest.fixture(scope="module")
def budgets(spark, tmp_path_factory):
    """Runs stream_budget over four shards in a folder; and what a run that nothing breaks off tells."""
    path, schema = streams.landed(spark, SF)

    def run(folder: Path) -> list:
        shards.stream_budget(spark, path, schema, f"file://{folder}/cp", f"file://{folder}/log", 20 << 30, streams.TILE_BYTES, f"file://{folder}/store", class_map(4), 300)
        return sorted(tuple(r) for r in spark.read.parquet(f"file://{folder}/log/*").collect())

    folder = tmp_path_factory.mktemp("smooth")
    return run, folder, run(folder)


@pytest.mark.parametrize("where", ["data", "manifest", "checkpoint"])
def test_a_batch_that_breaks_off_and_comes_again_tells_the_same(spark, tmp_path, monkeypatch, budgets, where):
    budgets, smooth_folder, smooth = budgets
    assert len({r[2] for r in smooth}) == 4  # each batch has a budget of its own
    write, calls = sinks.write_slice, []

    def broken(selected, store, batch):
        calls.append(batch)
        if batch == 1 and calls.count(1) == 1:
            if where == "data":
                selected.limit(7).write.mode("overwrite").partitionBy("shard").parquet(f"{store}/data/batch={batch}")  # a part of it
                raise Killed
            write(selected, store, batch)
            if where == "manifest":
                raise Killed
            return
        write(selected, store, batch)

    monkeypatch.setattr(sinks, "write_slice", broken)
    folder = tmp_path / "broken"
    if where == "checkpoint":
        budgets(folder)
        for name in ("3", ".3.crc"):  # the last batch has written everything, but is not marked as done
            (folder / "cp/commits" / name).unlink(missing_ok=True)
    else:
        with pytest.raises(Exception, match="Killed"):
            budgets(folder)
    assert budgets(folder) == smooth and calls.count(3 if where == "checkpoint" else 1) == 2
    read = lambda store, before=None: sorted((r.id, r.shard) for r in sinks.read_slices(spark, f"file://{store}/store", shards.SLICE, before).collect())
    assert read(folder) == read(smooth_folder) and read(folder, 2) == read(smooth_folder, 2) and read(folder, 0) == []


def test_versions_of_a_slice(spark, tmp_path):
    store = f"file://{tmp_path}/store"
    slice_of = lambda *ids, shard="s": spark.createDataFrame([(i, shard) for i in ids], "id string, shard string")
    assert sinks.slices(spark, store).count() == 0 and sinks.read_slices(spark, store, "id string, shard string").count() == 0
    sinks.write_slice(slice_of("a", "b"), store, 0)
    sinks.write_slice(slice_of("c").union(slice_of("d", shard="t")), store, 1)
    read = lambda before=None: sorted(r.id for r in sinks.read_slices(spark, store, "id string, shard string", before).collect())
    assert read() == ["c", "d"] and read(1) == ["a", "b"] and read(0) == []
    assert {(r.shard, r.batch, r.tiles) for r in sinks.slices(spark, store).collect()} == {("s", 1, 1), ("t", 1, 1)}
    sinks.drop_superseded(spark, store, 2)
    assert read() == ["c", "d"] and not (tmp_path / "store/data/batch=0").exists() and read(1) == []


def test_a_run_that_is_killed_anywhere_ends_alike(spark, tmp_path, monkeypatch):
    """The second shard's batch stops after its pixels were stored and its tiles not; then all of it comes again. A shard without usable tiles is skipped."""
    pixels = pipelines.labelled_shards(spark, SF)
    pixels = pixels.withColumn("bands", F.when(F.col("shard") == "shard_3", F.array(*[F.lit(0.0)] * 4)).otherwise(F.col("bands")))
    path = f"file://{tmp_path}/landed"
    shards.land(pixels, path, "shard", streams.SHARDS[:3])

    def run(name: str) -> list:
        out = jobs.incremental_run(spark, path, pixels.schema, f"file://{tmp_path}/{name}/cp", f"file://{tmp_path}/{name}", class_map(4), classes(spark), 12, 2 << 30, 64 << 20, 3, jobs.mean_fit(4))
        return sorted(tuple(r) for r in out.collect())

    smooth = run("smooth")
    assert [r[2] for r in smooth] == ["done", "done", "skipped: no tiles"] and [r[11] for r in smooth] == ["complete", "complete", "error"]
    write, failed = sinks.write_slice, []

    def broken(selected, store, batch):
        if batch == 1 and store.endswith("tiles") and not failed:
            failed.append(batch)
            raise Killed
        write(selected, store, batch)

    monkeypatch.setattr(sinks, "write_slice", broken)
    with pytest.raises(Exception, match="Killed"):
        run("broken")
    assert run("broken") == smooth and failed == [1]


def test_until_done_holds_back_no_more_than_an_earlier_end_may_cut():
    """Frames of one batch in any order: rows up to the first end, wherever it stands; afterwards nothing."""
    rows = pd.DataFrame({"run_id": "a", "event_id": range(12), "ts": [at(h) for h in range(12)], "done": [i in (5, 8) for i in range(12)]})

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def update(self, value):
            self.value = value

    for order in ([0, 1, 2], [2, 1, 0], [1, 2, 0]):
        run = progress.UntilDone()
        run.state = State()
        out = pd.concat(run.handleInputRows(("a",), iter([rows.iloc[i * 4 : i * 4 + 4] for i in order]), None))
        assert sorted(out["event_id"]) == [0, 1, 2, 3, 4, 5] and run.state.exists()
        assert not list(run.handleInputRows(("a",), iter([rows]), None))
