"""Steps of keyed streams called as Spark calls them, over a state that is a plain object: what they hold and how often they ask for state."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pandas as pd

from rasterweave.streaming import progress


class State:
    """Stands for the handle, and for each state that it gives out; counts what is asked."""

    def __init__(self):
        self.value, self.calls = {}, 0

    def getValueState(self, *_):
        return self

    getMapState = getListState = getValueState

    def exists(self):
        return None in self.value

    def get(self):
        return self.value[None]

    def update(self, value):
        self.value[None] = value

    def containsKey(self, key):
        self.calls += 1
        return key in self.value

    def getValue(self, key):
        self.calls += 1
        return self.value[key]

    def updateValue(self, key, value):
        self.calls += 1
        self.value[key] = value


def test_early_stop_tells_piece_by_piece_what_a_plain_loop_tells():
    draw = random.Random(3)
    values = [draw.choice((0.1, 0.2, 0.3, 0.9 * draw.random(), float("nan"))) for _ in range(700)]
    step = progress.EarlyStop(12, piece=50)
    step.init(State())
    got, begin = [], 0
    for end in (10, 30, 300, 700):
        rows = list(enumerate(values))[begin:end]
        draw.shuffle(rows)
        frames = [pd.DataFrame(rows[i : i + 40], columns=["epoch", "val_miou"]) for i in range(0, len(rows), 40)]
        made = list(step.handleInputRows(("a",), iter(frames), None))
        assert max(map(len, made)) <= 50
        got += [tuple(r) for x in made for r in x.itertuples(index=False)]
        begin = end
    best, at, stopped, expected = 0.0, 0, False, []
    for epoch, value in enumerate(values):
        if value > best:
            best, at = value, epoch
        now = epoch - at >= 12 and not stopped
        stopped = stopped or now
        expected.append(("a", epoch, best, epoch - at, now))
    assert got == expected and stopped


def test_early_stop_holds_few_bytes_an_epoch():
    n, step = 400_000, progress.EarlyStop(12)
    step.init(State())
    frames = (pd.DataFrame({"epoch": np.arange(i, i + 10_000, dtype=np.int32), "val_miou": np.random.default_rng(i).random(10_000)}) for i in range(0, n, 10_000))
    tracemalloc.start()
    assert sum(len(x) for x in step.handleInputRows(("a",), frames, None)) == n
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 * n


def test_closed_windows_ask_for_state_once_a_run():
    step, state = progress.Ended(), State()
    step.init(state)
    rows = [(f"={run}", run, start, float(start), 1, (run, start) == ("x", 700)) for start in range(1000) for run in ("x", "y")]
    columns = ["run", "run_id", "start_us", "value", "n", "done"]
    first = [r for made in step.handleInputRows((1,), iter([pd.DataFrame(rows[i : i + 300], columns=columns) for i in range(0, 2000, 300)]), None) for r in made.itertuples(index=False)]
    assert state.calls <= 4 and sorted((r.run_id, r.start_us) for r in first) == [("x", i) for i in range(700)] + [("y", i) for i in range(1000)]
    later = pd.DataFrame([("=x", "x", 2000, 1.0, 1, False), ("=y", "y", 2000, 2.0, 3, False)], columns=columns)
    assert [tuple(r) for made in step.handleInputRows((1,), iter([later]), None) for r in made.itertuples(index=False)] == [("y", 2000, 2.0, 3)]
