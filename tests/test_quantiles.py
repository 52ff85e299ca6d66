import random

import numpy as np
import pytest

from abacist.operators import prep as D
from abacist.operators import quantiles as Q
from abacist.operators import sampling as K


@pytest.mark.parametrize("limit", [10, 50, 10**6])
def test_exact_quantiles_match_numpy(frame, limit):
    rng = random.Random(5)
    smooth = [rng.gauss(0, 10) for _ in range(3000)]
    # a third of all rows share one value
    tied = [4.0 if i % 3 == 0 else float(rng.randint(0, 400)) for i in range(3000)]
    holes = [None if i % 4 == 0 else float(i) for i in range(3000)]
    df = frame(list(zip(smooth, tied, holes)), "a double, b double, c double")
    probs = [0.0, 0.04, 0.25, 0.5, 0.77, 0.999, 1.0]
    got = Q.exact_quantiles(df, ["a", "b", "c"], probs, band_limit=limit)
    for name, values in {"a": smooth, "b": tied, "c": [v for v in holes if v is not None]}.items():
        assert got[name] == pytest.approx(list(np.quantile(values, probs)))


def test_quantile_of_nothing(frame):
    assert Q.exact_quantiles(frame([(None,)], "a double"), ["a"], [0.5]) == {"a": [None]}


def test_nan_counts_as_missing(frame):
    df = frame([(1.0,), (float("nan"),), (3.0,)], "a double")
    assert Q.exact_quantiles(df, ["a"], [0.5]) == {"a": [2.0]}


def test_winsorize_top_four_of_hundred(frame):
    df = frame([(float(i),) for i in range(1, 101)] + [(None,)], "x double")
    got = sorted(r[0] for r in D.winsorize(df, ["x"]).collect() if r[0] is not None)
    assert got == [float(i) for i in range(1, 97)] + [96.0] * 4
    both = sorted(r[0] for r in D.winsorize(df.dropna(), ["x"], lower=0.05).collect())
    assert both[:7] == [6.0] * 6 + [7.0]


def test_winsorize_keeps_order_for_every_size(frame):
    for n in (1, 5, 24, 25, 26, 49, 50, 51):
        k = int(round(0.04 * n, 9))
        got = sorted(r[0] for r in D.winsorize(frame([(float(i),) for i in range(n)], "x double"), ["x"]).collect())
        assert got == [float(min(i, n - 1 - k)) for i in range(n)]


def test_stratified_split_is_exact(frame):
    df = frame([(i, 1 if i < 100 else 0) for i in range(1100)], "id int, y int")
    out = K.stratified_split(df, "id", "y", [0, 1], {"train": 0.6, "valid": 0.2, "test": 0.2}, 9)
    got = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert got == {
        (0, "train"): 600, (0, "valid"): 200, (0, "test"): 200, (1, "train"): 60, (1, "valid"): 20, (1, "test"): 20,
    }


def test_splits_do_not_depend_on_partitions(frame):
    df = frame([(i,) for i in range(500)], "id int")
    a = K.hash_split(df, "id", {"a": 0.7, "b": 0.3}, 1)
    b = K.hash_split(df.repartition(7), "id", {"a": 0.7, "b": 0.3}, 1)
    assert sorted(a.collect()) == sorted(b.collect())
