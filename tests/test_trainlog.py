import random

import numpy as np
import pytest

from examloom.operators import trainlog

SIZES = {"r4": 4, "r5": 5, "r6": 6, "r10": 10, "long": 400}


def make(spark, seed=1):
    rng = random.Random(seed)
    rows, points = [], {}
    for run, size in SIZES.items():
        steps = sorted(rng.sample(range(1, 4000), size))
        losses = [rng.random() * 10 for _ in steps]
        points[run] = list(zip(steps, losses))
        rows += [(run, s, x) for s, x in points[run]]
        rows += [(run, s + 5000, None) for s in steps[:2]]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "run_id STRING, step LONG, loss DOUBLE"), points


@pytest.mark.parametrize("width", [1, 7, 150, 100_000])
def test_smooth_loss_is_the_valid_moving_average(spark, width):
    df, points = make(spark)
    got = {}
    for r in trainlog.smooth_loss(df, steps_per_range=width).collect():
        got.setdefault(r.run_id, {})[r.step] = r.smooth_loss
    assert set(got) == {"r6", "r10", "long"}
    for run, series in got.items():
        steps, losses = zip(*points[run])
        expected = np.convolve(losses, np.ones(5) / 5, mode="valid")
        assert sorted(series) == list(steps[4:])
        assert np.allclose([series[s] for s in steps[4:]], expected)


@pytest.mark.parametrize("width", [3, 100_000])
def test_annotate_every(spark, width):
    df, points = make(spark)
    got = {}
    for r in trainlog.annotate_every(df, 5, width).collect():
        got.setdefault(r.run_id, []).append((r.step, r.loss))
    assert {k: sorted(v) for k, v in got.items()} == {k: v[::5] for k, v in points.items()}


def test_final_loss(spark):
    df, points = make(spark)
    got = {r.run_id: (r.step, r.final_loss) for r in trainlog.final_loss(df).collect()}
    assert got == {k: v[-1] for k, v in points.items()}


def test_other_window_size(spark):
    df, points = make(spark)
    got = {r.step: r.smooth_loss for r in trainlog.smooth_loss(df, 3, 40).where("run_id='r10'").collect()}
    steps, losses = zip(*points["r10"])
    assert np.allclose([got[s] for s in steps[2:]], np.convolve(losses, np.ones(3) / 3, mode="valid"))
