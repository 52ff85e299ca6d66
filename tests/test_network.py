"""Networks on packed rows against MLlib's."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from abacist.operators import models as M
from abacist.operators import network as N


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1280, 3))
    y = (x[:, 0] * x[:, 1] + x[:, 2] > 0.2).astype(float) + (x[:, 2] > 1)
    return spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(x, y)], ["label", "features"])


def test_network_is_that_of_mllib(points):
    est = M.mlp([3, 5, 4, 3], maxIter=12)
    whole = M.fit(est, points.coalesce(1))  # MLlib weighs blocks of 128 rows alike: here all are full
    got = N.fit_network(est, points.repartition(7))
    assert got.weights.toArray() == pytest.approx(whole.weights.toArray(), abs=1e-5)
    ids = [got.predict(r["features"]) for r in points.limit(50).collect()]
    assert ids == [whole.predict(r["features"]) for r in points.limit(50).collect()]


def test_gradient_by_finite_differences():
    rng = np.random.default_rng(1)
    x, y, w = rng.normal(size=(30, 3)), rng.integers(0, 2, 30).astype(float), rng.normal(size=3 * 4 + 4 + 4 * 2 + 2)
    got = N.loss_sums([3, 4, 2], w, x, y, chunk=7)
    assert got[0] == 30
    for k, move in enumerate(np.eye(len(w)) * 1e-6):
        slope = (N.loss_sums([3, 4, 2], w + move, x, y)[1] - N.loss_sums([3, 4, 2], w - move, x, y)[1]) / 2e-6
        assert got[2 + k] == pytest.approx(slope, abs=1e-5)


def test_rows_weigh_the_same_however_they_lie(points):
    est = M.mlp([3, 4, 3], maxIter=8)
    one, many = (N.fit_network(est, points.limit(1201).repartition(n)).weights.toArray() for n in (1, 11))
    assert one == pytest.approx(many, abs=1e-6)


def test_missing_values_and_no_rows_stop_a_network(frame):
    est = M.mlp([1, 2, 2], maxIter=2)
    rows = M.features_of(frame([(0, 1.0), (1, None)], "y int, x double"), ["x"], "y")
    with pytest.raises(Exception, match="missing values"):
        N.fit_network(est, rows)
    with pytest.raises(ValueError, match="no rows"):
        N.fit_network(est, rows.where("label > 5"))


def test_line_search_ends_on_a_rising_direction():
    def loss(x):
        return float(x @ x), 2 * x

    at = np.array([1.0, -2.0])
    assert N.line_search(loss, at, *loss(at), at, 1.0) is None
    assert N.descend(loss, at, 30, 1e-9) == pytest.approx([0, 0], abs=1e-4)
