"""Batched fits against MLlib, numpy and pairwise counts."""

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from abacist.operators import batched as B
from abacist.operators import models as M

COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(600, 4)) * [1, 100, 0.01, 1] + [0, 1000, 0, 0]
    x[:, 3] = 5.0  # constant
    margin = 1.5 * x[:, 0] - 0.01 * (x[:, 1] - 1000) + 30 * x[:, 2]
    y = (rng.uniform(size=600) < 1 / (1 + np.exp(-margin))).astype(int)
    return x, y, 3 + 2 * x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=600)


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y, z = data
    return spark.createDataFrame([(i, *map(float, r), int(t), float(v)) for i, (r, t, v) in enumerate(zip(x, y, z))],
                                 "id long, a double, b double, c double, d double, y int, z double").repartition(5)


def test_fits_equal_separate_fits_and_share_their_jobs(rows, monkeypatch):
    calls = []
    plain = B.newton_sums
    monkeypatch.setattr(B, "newton_sums", lambda *args: calls.append(1) or plain(*args))
    sets = [["a"], ["b"], ["c"], ["a", "b"], ["a", "b", "c"]]
    fits = B.logistic_fits(rows, "y", sets)
    assert len(calls) <= 15 and all(f.done for f in fits)
    for names, fit in zip(sets, fits):
        model = M.fit(M.logistic(tol=1e-12, maxIter=500), M.features_of(rows, names, "y"))
        assert list(fit.coefficients.values()) == pytest.approx(model.coefficients.toArray().tolist(), rel=1e-4)
        assert fit.intercept == pytest.approx(model.intercept, rel=1e-3, abs=1e-4)


def test_gradient_and_hessian_by_finite_differences(rows, data):
    x, y, _ = data
    z = np.hstack([np.ones((600, 1)), x[:, :2]])
    beta = np.array([0.1, 0.3, -0.002])
    fit = B.Logit(("a", "b"), beta, np.zeros(3))
    got = B.newton_sums(rows.select(F.col("y").cast("double").alias("label"), "a", "b"), ["a", "b"], [fit], np.zeros(2), np.ones(2))[0]

    def value(b):
        return (y * (z @ b) - np.logaddexp(0, z @ b)).sum()

    def gradient(b):
        return z.T @ (y - 1 / (1 + np.exp(-z @ b)))

    step = np.array([1e-4, 1e-4, 1e-7])
    assert got[0] == pytest.approx(value(beta))
    for k in range(3):
        move = np.eye(3)[k] * step[k]
        assert got[1 + k] == pytest.approx((value(beta + move) - value(beta - move)) / (2 * step[k]), rel=1e-4, abs=1e-3)
        numeric = -(gradient(beta + move) - gradient(beta - move)) / (2 * step[k])
        assert got[4:].reshape(3, 3)[k] == pytest.approx(numeric, rel=1e-4)


@pytest.mark.parametrize("how", [{}, {"group_limit": 1, "parts": 3}])
def test_areas_by_pairs(rows, data, how):
    x, y, _ = data
    fits = B.logistic_fits(rows, "y", [["a"], ["a", "c"]])
    rounded = rows.withColumn("a", F.round("a", 1)).withColumn("c", F.round("c", 2))
    got = B.areas(rounded, "y", fits, **how)
    for fit, area in zip(fits, got):
        parts = {r["id"]: (r["m"], r["y"]) for r in rounded.select("id", "y", fit.margin().alias("m")).collect()}
        m, t = (np.array(v) for v in zip(*(parts[i] for i in range(600))))
        gap = m[t == 1][:, None] - m[t == 0]
        assert area == pytest.approx(((gap > 0) + (gap == 0) / 2).mean(), abs=1e-12)


def test_selection_takes_the_best_each_step(rows):
    steps = B.stepwise_logistic(rows, rows, COLUMNS, "y").orderBy("step").collect()
    assert len(steps) == 4 and steps[0]["features"] in ("a", "b") and steps[-1]["auc_test"] >= steps[0]["auc_test"]
    singles = B.areas(rows, "y", B.logistic_fits(rows, "y", [[c] for c in COLUMNS]))
    assert steps[0]["auc_test"] == max(singles) and singles[3] == 0.5
    assert B.next_best_logistic(rows, ["c"], COLUMNS, "y", max_n=3)[0] == "c"
    assert B.next_best_logistic(rows, ["c"], COLUMNS, "y", max_n=1) == ["c"]


def test_exact_areas_only_where_bounds_leave_the_winner_open(rows, monkeypatch):
    fits = B.logistic_fits(rows, "y", [["a"], ["b"], ["c"], ["d"]])
    exact = B.areas(rows, "y", fits)
    for (low, high), area in zip(B.area_bounds(rows, "y", fits), exact):
        assert low - 1e-12 <= area <= high + 1e-12
    best = max(range(4), key=lambda k: (exact[k], COLUMNS[k]))
    monkeypatch.setattr(B, "SLOTS", 4)  # bounds too wide to tell
    assert B.best_fit(rows, "y", fits, COLUMNS) == best
    monkeypatch.undo()
    monkeypatch.setattr(B, "areas", lambda *args: pytest.fail("areas of all candidates"))
    assert B.best_fit(rows, "y", fits, COLUMNS) == best


def test_fits_that_start_from_another_are_the_same(rows):
    base = B.logistic_fits(rows, "y", [["a"]])[0]
    cold, warm = B.newton_fits(rows, "y", [["a", "b"]])[0], B.newton_fits(rows, "y", [["a", "b"]], base)[0]
    assert list(warm.coefficients.values()) == pytest.approx(list(cold.coefficients.values()), rel=1e-6)


def test_missing_and_no_rows_raise(rows):
    broken = rows.withColumn("a", F.when(F.col("id") != 3, F.col("a")))
    for call in (lambda: B.logistic_fits(broken, "y", [["a"]]), lambda: B.elastic_net_folds(broken, ["a"], "z", "id", [0.0], [0.0])):
        with pytest.raises(Exception, match="missing values"):
            call()
    for call in (lambda: B.logistic_fits(rows.limit(0), "y", [["a"]]), lambda: B.elastic_net_folds(rows.limit(0), ["a"], "z", "id", [0.0], [0.0])):
        with pytest.raises(ValueError, match="no rows"):
            call()


def test_separable_labels_end(frame):
    fit = B.logistic_fits(frame([(float(i), int(i > 5)) for i in range(12)], "a double, y int"), "y", [["a"]])[0]
    assert fit.coefficients["a"] > 1


@pytest.mark.parametrize("reg, elastic", [(0.0, 0.0), (0.5, 0.0), (0.5, 1.0), (2.0, 0.4), (1000.0, 1.0)])
def test_elastic_net_equals_mllib(rows, reg, elastic):
    found = B.elastic_net_folds(rows, COLUMNS, "z", "id", [reg], [elastic]).first()
    model = M.fit(M.linear(reg=reg, elastic=elastic, tol=1e-12, maxIter=1000), M.features_of(rows, COLUMNS[:3], "z"))
    assert found["coefficients"][:3] == pytest.approx(model.coefficients.toArray().tolist(), rel=1e-4, abs=1e-5)
    assert found["intercept"] == pytest.approx(model.intercept, rel=1e-4) and found["coefficients"][3] == 0.0


def test_folds_equal_fits_without_them(rows, data):
    x, _, z = data
    found = B.elastic_net_folds(rows, COLUMNS[:3], "z", "id", [0.0], [0.0], folds=4).first()
    folds = {r["id"]: r["f"] for r in rows.select("id", (B.hash_number("id", 42) % 4).alias("f")).collect()}
    fold = np.array([folds[i] for i in range(600)])
    design = np.hstack([np.ones((600, 1)), x[:, :3]])
    errors = []
    for k in range(4):
        beta = np.linalg.lstsq(design[fold != k], z[fold != k], rcond=None)[0]
        errors.append(np.sqrt(((z - design @ beta)[fold == k] ** 2).mean()))
    assert found["rmse"] == pytest.approx(np.mean(errors), rel=1e-6)


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 2)) * [3, 0.5] + [10, 0]
    y = (rng.random(900) < 1 / (1 + np.exp(-(x[:, 0] - 10) / 3 + x[:, 1]))).astype(float)
    return spark.createDataFrame(
        [(float(b), float(p), float(q), 7.0, i % 3) for i, (b, (p, q)) in enumerate(zip(y, x))],
        "label double, a double, b double, flat double, fold int").cache()


def test_fits_of_folds_are_those_of_mllib(folded):
    grid = [(0.0, 0.0), (0.1, 0.0), (0.05, 0.5), (0.3, 1.0)]
    fits = B.fold_fits(folded, ["a", "b", "flat"], 3, grid)
    assert [f.held_out for f in fits] == [k for k in range(3) for _ in grid]
    for f, (reg, elastic) in zip(fits, grid * 3):
        train = M.features_of(folded.where(folded.fold != f.held_out), ["a", "b"], "label")
        model = M.logistic(regParam=reg, elasticNetParam=elastic, tol=1e-12, maxIter=1000).fit(train)
        assert f.columns == ("a", "b")  # a constant column has no coefficient
        assert list(f.coefficients.values()) == pytest.approx(model.coefficients.toArray().tolist(), abs=1e-5)
        assert f.intercept == pytest.approx(model.intercept, abs=1e-4)
    assert [f.coefficients["b"] for f, g in zip(fits, grid * 3) if g == (0.3, 1.0)] == [0.0] * 3


def test_areas_of_folds_are_those_of_their_own_rows(folded):
    fits = B.fold_fits(folded, ["a", "b"], 3, [(0.0, 0.0), (0.1, 0.5)])
    got = B.areas(folded, "label", fits)
    for f, area in zip(fits, got):
        own = folded.where(folded.fold == f.held_out).select("label", f.margin().alias("m")).toPandas()
        pos, neg = (own.m[own.label == v].to_numpy() for v in (1, 0))
        assert area == pytest.approx(((pos[:, None] > neg) + (pos[:, None] == neg) / 2).mean(), abs=1e-12)


def test_missing_values_stop_a_grid(spark, frame):
    rows = frame([(0, 1.0), (1, None), (1, 2.0), (0, 3.0)], "y int, x double")
    with pytest.raises(PythonException, match="missing values"):
        B.logistic_grid_folds(rows, ["x"], "y", [0.0], [0.0], folds=2)


def test_passes_of_a_grid_do_not_grow_with_its_fits(spark):
    from abacist.queries import QUERIES

    spark.sparkContext.setJobGroup("grid", "grid", True)
    try:
        found = QUERIES["cv_grid"](spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("grid")) < 100  # 12 fits, each with passes of its own, took more
    assert {r["params"] for r in found} == {f"elasticNetParam={e}, regParam={r}" for e in (0.0, 0.5) for r in (0.0, 0.1)}
    assert all(0.5 < r["metric"] < 1 for r in found)
