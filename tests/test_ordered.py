import random

import pytest
from pyspark.sql import functions as F

from abacist.operators import ordered as W
from abacist.operators import timeseries as T

# forces every group through range-partitioned blocks
BLOCKS = dict(group_limit=1, parts=5)


def rows_of(df, key, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(key).collect()]


@pytest.mark.parametrize("how", [{}, BLOCKS])
def test_running_total_missing_rules(frame, how):
    df = frame([("a", 1, 1), ("a", 2, None), ("a", 3, 2)], "g string, t int, v int")
    skip = W.running_total(df, ["g"], ["t"], "v", "s", "skip", **how)
    keep = W.running_total(df, ["g"], ["t"], "v", "s", "propagate", **how)
    assert [r[0] for r in rows_of(skip, "t", "s")] == [1, 1, 3]
    assert [r[0] for r in rows_of(keep, "t", "s")] == [1, None, None]


@pytest.mark.parametrize("how", [{}, BLOCKS])
def test_interpolate(frame, how):
    values = [None, 1.0, None, None, 4.0, None]
    df = frame([("s", i, v) for i, v in enumerate(values)], "g string, t int, v double")
    get = lambda **k: [r[0] for r in rows_of(T.interpolate(df, "g", ["t"], "v", **k, **how), "t", "v")]
    assert get() == [None, 1, 2, 3, 4, 4]
    assert get(limit=1) == [None, 1, 2, None, 4, 4]


@pytest.mark.parametrize("how", [{}, BLOCKS])
def test_fill_both_ways(frame, how):
    df = frame([("s", i, v) for i, v in enumerate([None, 1, None, 4, None])], "g string, t int, v int")
    assert [r[0] for r in rows_of(W.fill(df, ["g"], ["t"], "v", "forward", **how), "t", "v")] == [None, 1, 1, 4, 4]
    assert [r[0] for r in rows_of(W.fill(df, ["g"], ["t"], "v", "backward", **how), "t", "v")] == [1, 1, 4, 4, None]


def test_blocks_equal_plain_windows_with_a_hot_and_a_null_group(frame):
    rng = random.Random(3)
    data = [("hot" if i < 400 else rng.choice(["a", "b", None]), i, rng.choice([None, 1, 2, 3])) for i in range(700)]
    df = frame(data, "g string, t int, v int")
    specs = [
        W.Running("total", "sum", F.col("v")),
        W.Running("before", "sum", F.col("v"), exclusive=True),
        W.Running("left", "sum", F.col("v"), backward=True),
        W.Running("number", "count", F.lit(1)),
        W.Running("last", "last", F.col("v")),
        W.Running("next", "last", F.col("v"), backward=True),
        W.Running("top", "max", F.col("v")),
    ]
    plain = W.running(df, ["g"], ["t"], specs)
    mixed = W.running(df, ["g"], ["t"], specs, group_limit=200, parts=6)
    blocks = W.running(df, ["g"], ["t"], specs, group_limit=10, parts=6)
    want = sorted(map(str, plain.collect()))
    assert sorted(map(str, mixed.collect())) == want
    assert sorted(map(str, blocks.collect())) == want


def test_ungrouped_running_in_blocks(frame):
    df = frame([(i, 1.0 + i / 10) for i in range(50)], "t int, v double")
    out = W.cumulative_product(df, [], ["t"], "v", "p", group_limit=10, parts=4)
    p = 1.0
    for (t, v), got in zip([(i, 1.0 + i / 10) for i in range(50)], rows_of(out, "t", "p")):
        p *= v
        assert got[0] == pytest.approx(p)


def test_split_first(frame):
    df = frame([(g, i) for g in "ab" for i in range(5)], "g string, t int")
    parts = W.split_first(df, ["g"], ["t"], 3).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in parts} == {"train": 6, "test": 4}


def test_forecast_of_equal_values_is_constant(frame):
    df = frame([("s", i, 7.0) for i in range(120)], "g string, t int, v double")
    out = T.ma_forecast(df, "g", ["t"], "v", 102)
    assert out.count() == 18
    assert {round(r["forecast"], 9) for r in out.collect()} == {7.0}


def test_forecast_chunks_agree_with_one_run(frame, monkeypatch):
    rng = random.Random(1)
    values = [rng.uniform(1, 9) for _ in range(60)]
    df = frame([("s", i, v) for i, v in enumerate(values)], "g string, t int, v double")
    state, want = values[:10], []
    for _ in range(50):
        want.append(sum(state[-10:]) / 10)
        state.append(want[-1])
    monkeypatch.setattr(T, "FORECAST_CHUNK", 7)
    got = [r[0] for r in rows_of(T.ma_forecast(df, "g", ["t"], "v", 10, window=10), "t", "forecast")]
    assert got == pytest.approx(want)
