"""Forests on counted bins against MLlib's."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from abacist.operators import evaluate as E
from abacist.operators import forests as T
from abacist.operators import models as M


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.integers(1, 51, 6000), rng.normal(size=6000), rng.integers(0, 11, 6000), rng.integers(0, 9, 6000)])
    margin = 0.1 * (x[:, 0] - 25) + x[:, 1] + 0.3 * (x[:, 2] - 5) * (x[:, 3] > 4)
    y = rng.random(6000) < 1 / (1 + np.exp(-margin))
    rows = [(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, d double, y int").repartition(3).cache()


def trees(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_tree_of_all_rows_is_that_of_mllib(noisy, impurity):
    rows = M.features_of(noisy.selectExpr("a % 20 as a", "c", "d", "y"), ["a", "c", "d"], "y")
    est = M.forest(1, 7, featureSubsetStrategy="all", bootstrap=False, impurity=impurity, minInstancesPerNode=3)
    mine, whole = T.fit_forest(est, rows, 6000), est.fit(rows)
    assert trees(mine) == trees(whole)
    assert mine.featureImportances.toArray() == pytest.approx(whole.featureImportances.toArray())
    probe = rows.limit(200)
    both = [[r["prob"] for r in M.score(m, probe).collect()] for m in (mine, whole)]
    assert both[0] == pytest.approx(both[1])


def test_jobs_of_a_large_forest_do_not_hang_on_its_depth(spark, noisy, monkeypatch):
    monkeypatch.setattr(T, "PLAIN_WORK", 0, raising=False)
    rows = M.features_of(noisy, ["a", "b", "c", "d"], "y")
    jobs = []
    for depth in (2, 30):
        spark.sparkContext.setJobGroup(f"depth {depth}", "")
        model = M.fit(M.forest(5, depth), rows)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"depth {depth}")))
        assert model.getNumTrees == 5 and (max(t.depth for t in model.trees) > 12) == (depth == 30)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_forest_is_like_that_of_mllib(noisy):
    train, test = (M.features_of(noisy.where(f"id % 2 = {k}"), ["a", "b", "c", "d"], "y").cache() for k in (0, 1))
    est = M.forest(20, 30)
    mine, whole = T.fit_forest(est, train, train.count()), est.fit(train)
    areas = [E.auc(M.score(m, test), "prob", "label").first()["auc_roc"] for m in (mine, whole)]
    assert areas[0] == pytest.approx(areas[1], abs=0.02)
    assert mine.totalNumNodes == pytest.approx(whole.totalNumNodes, rel=0.05)
    assert len(set(trees(mine))) == 20


def test_forest_does_not_hang_on_how_rows_lie_or_repeat_runs(noisy):
    rows = M.features_of(noisy, ["a", "b", "c", "d"], "y")
    one, many, other = (T.fit_forest(M.forest(3, 8, seed=s), rows.repartition(n), 6000) for n, s in ((1, 1), (5, 1), (5, 2)))
    assert trees(one) == trees(many) != trees(other)


def test_a_node_asks_only_its_share_of_columns():
    rng = np.random.default_rng(1)
    bins = [rng.integers(0, 2, 500) for _ in range(6)]
    label = bins[0]  # the first column tells all; a tree that may always ask it needs one split
    grown = [T.grow(bins, label, np.ones(500, int), np.random.default_rng(s), 2, [2] * 6, share, 10) for share in (6, 2) for s in range(8)]
    assert all(len(g["id"]) == 3 for g in grown[:8]) and any(len(g["id"]) > 3 for g in grown[8:])


def test_leaves_of_one_prediction_are_merged():
    bins, label = [np.array([0] * 10 + [1] * 10)], np.array([0] * 10 + [0] * 8 + [1] * 2)
    grown = T.grow(bins, label, np.ones(20, int), np.random.default_rng(0), 2, [2], 1, 5)
    assert grown["stats"].tolist() == [[18, 2]] and grown["left"].tolist() == [-1]


def test_bins_lie_between_values_and_at_equal_shares():
    assert T.cut_points([1.0, 2.0, 4.0], [5, 1, 1], 32).tolist() == [1.5, 3.0]
    assert T.cut_points(np.arange(100.0), [1] * 100, 4).tolist() == [24.5, 49.5, 74.5]
    assert T.cut_points([7.0], [9], 32).tolist() == []
    values, counts = T.value_counts(np.array([3.0, 1.0, 3.0]), 2)
    assert values.tolist() == [1.0, 3.0] and counts.tolist() == [1, 2]
    values, counts = T.value_counts(np.arange(1000.0)[::-1], 10)
    assert counts.tolist() == [100] * 10 and np.abs(values - np.arange(50, 1000, 100)).max() <= 1


def test_chunks_give_the_same_bins(noisy, monkeypatch):
    rows = M.features_of(noisy, ["a", "c"], "y")
    whole = trees(T.fit_forest(M.forest(2, 6), rows, 6000))
    monkeypatch.setattr(T, "CHUNK_VALUES", 10)
    monkeypatch.setattr(T, "NODES_AT_ONCE", 2)
    assert trees(T.fit_forest(M.forest(2, 6), rows.coalesce(1), 6000)) == whole


def test_what_cannot_be_counted_is_left_to_mllib(noisy, frame, monkeypatch):
    monkeypatch.setattr(T, "PLAIN_WORK", 0)
    rows = M.features_of(noisy, ["a", "b", "c", "d"], "y")
    assert T.is_large(M.forest(2, 2), 6000) and not T.is_large(M.forest(2, 2, featureSubsetStrategy="3"), 6000) and not T.is_large(M.tree(), 6000)
    monkeypatch.setattr(T, "MOST_COUNTED", 10)
    assert T.fit_forest(M.forest(2, 2), rows, 6000) is None
    assert M.fit(M.forest(2, 2), rows).getNumTrees == 2
    one_class = M.features_of(noisy.where("y = 0"), ["a"], "y")
    assert T.fit_forest(M.forest(2, 2), one_class, 3000) is None


def test_missing_values_and_odd_labels_stop_a_forest(frame, monkeypatch):
    monkeypatch.setattr(T, "PLAIN_WORK", 0)
    holed = M.features_of(frame([(0, 1.0), (1, None)], "y int, x double"), ["x"], "y")
    with pytest.raises(Exception, match="missing values"):
        M.fit(M.forest(2, 2), holed)
    with pytest.raises(Exception, match="missing values"):
        M.fit(M.forest(2, 2), holed.withColumn("features", F.when(F.col("label") == 0, F.col("features"))))
    for label in (0.5, -1.0, None):
        rows = M.features_of(frame([(1.0, 1.0), (label, 2.0)], "y double, x double"), ["x"], "y")
        with pytest.raises(Exception, match="whole numbers"):
            M.fit(M.forest(2, 2), rows)


def test_packed_nodes_score_like_mllib(noisy, frame):
    train = M.features_of(noisy, ["a", "b", "c", "d"], "y")
    model = T.fit_forest(M.forest(20, 30), train, 6000)
    holed = M.features_of(frame([(1.0, None, 2.0, 3.0, 0), (9.0, 0.1, 2.0, 3.0, 1)], "a double, b double, c double, d double, y int"), ["a", "b", "c", "d"], "y")
    rows = train.limit(500).unionByName(holed).coalesce(1).cache()
    assert str(model.transform(rows).collect()) == str(T.RandomForestClassificationModel._transform(model, rows).collect())
    assert M.score(model, rows).where("prob is null").count() == 1
    assert model.transform(rows.where("label > 5")).count() == 0


def test_the_zoo_has_a_whole_forest(spark, frame, monkeypatch, tmp_path):
    from abacist.queries import models as Q

    rows = [(i, float(i % 50 + 1), 100.0 * i, (i % 11) / 100, (i % 9) / 100, i % 7) for i in range(400)]
    columns = "l_orderkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_linenumber int"
    frame(rows, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    taken = []
    monkeypatch.setattr(Q.M, "compare_models", lambda zoo, train, test: taken.append(zoo))
    Q.model_zoo(spark, str(tmp_path))
    assert (taken[0]["forest"].getNumTrees(), taken[0]["forest"].getMaxDepth()) == (100, 30)


def test_compared_models_score_their_rows_once(noisy, monkeypatch):
    monkeypatch.setattr(T, "PLAIN_WORK", 0)
    train, test = (M.features_of(noisy.where(f"id % 2 = {k}"), ["a", "b", "c", "d"], "y") for k in (0, 1))
    zoo = {"forest": M.forest(10, 30), "logistic": M.logistic(), "boosting": M.gbt("regressor", maxIter=2, seed=1)}
    got = {r["model"]: (r["accuracy"], r["auc"]) for r in M.compare_models(zoo, train, test).collect()}
    for name, est in zoo.items():
        model = M.fit(est, train)
        hit = M.score(model, test).agg(F.avg((F.col("predicted") == F.col("label")).cast("double"))).first()[0]
        assert got[name] == pytest.approx((hit, M._auc(model, test)), abs=1e-4)  # MLlib's area joins scores by how rows lie
