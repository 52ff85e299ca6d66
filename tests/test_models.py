import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from abacist.operators import credit as C
from abacist.operators import evaluate as E
from abacist.operators import models as M
from abacist.operators import neighbors as N
from abacist.operators import prep as P
from abacist.operators import survival as S

BLOCKS = dict(group_limit=1, parts=4)


@pytest.mark.parametrize("how", [{}, BLOCKS])
def test_kaplan_meier(frame, how):
    df = frame([(1, 1), (2, 1), (2, 0), (3, 1)], "t int, e int")
    km = S.kaplan_meier(df, "t", "e", **how).orderBy("time").collect()
    assert [r["survival"] for r in km] == pytest.approx([0.75, 0.5, 0.0])
    assert [(r["removed"], r["observed"], r["censored"], r["at_risk"]) for r in km] == [(1, 1, 0, 4), (2, 1, 1, 3), (1, 1, 0, 1)]


def test_curve_without_censoring_is_one_minus_ecdf(frame):
    rng = random.Random(2)
    times = [rng.randint(1, 30) for _ in range(200)]
    km = S.kaplan_meier(frame([(t, 1) for t in times], "t int, e int"), "t", "e")
    for r in km.collect():
        assert r["survival"] == pytest.approx(1 - sum(t <= r["time"] for t in times) / 200)
    at = S.survival_at(km, [0, 15]).orderBy("time").collect()
    assert at[0]["survival"] == 1.0 and at[1]["survival"] == pytest.approx(1 - sum(t <= 15 for t in times) / 200)


def test_logrank_against_a_direct_sum(frame):
    rng = random.Random(4)
    data = [(rng.randint(1, 12), rng.randint(0, 1), rng.randint(0, 1)) for _ in range(120)]
    got = S.logrank(frame(data, "t int, e int, g int"), "t", "e", "g", 1).first()
    o = x = v = 0.0
    for t in {d[0] for d in data if d[1]}:
        n = sum(d[0] >= t for d in data)
        n1 = sum(d[0] >= t and d[2] == 1 for d in data)
        d_all = sum(d[0] == t and d[1] for d in data)
        o += sum(d[0] == t and d[1] and d[2] == 1 for d in data)
        x += d_all * n1 / n
        v += d_all * n1 * (n - n1) * (n - d_all) / (n * n * (n - 1)) if n > 1 else 0
    assert got["test_statistic"] == pytest.approx((o - x) ** 2 / v)
    assert got["p_value"] == pytest.approx(math.erfc(math.sqrt((o - x) ** 2 / v / 2)))


def efron(data, beta):
    """Partial log likelihood with Efron ties, summed directly."""
    total = 0.0
    for t in {stop for _, stop, e, *_ in data if e}:
        risk = [np.dot(beta, x) for a, b, _, *x in data if a < t <= b]
        dead = [np.dot(beta, x) for _, b, e, *x in data if b == t and e]
        s, d = sum(map(math.exp, risk)), sum(map(math.exp, dead))
        total += sum(dead) - sum(math.log(s - i / len(dead) * d) for i in range(len(dead)))
    return total


@pytest.mark.parametrize("how,chunk", [({}, 100_000), (BLOCKS, 2)])
def test_cox_maximises_the_efron_likelihood(frame, monkeypatch, how, chunk):
    monkeypatch.setattr(S, "TIES_CHUNK", chunk)
    rng = random.Random(8)
    data = []
    for _ in range(60):
        a = rng.randint(0, 3)
        x, z = rng.gauss(0, 1), rng.randint(0, 1)
        data.append((a, a + 1 + int(rng.expovariate(0.3 * math.exp(0.5 * x - 0.4 * z))) % 9, int(rng.random() < 0.7), x, z))
    out = S.cox_tv(frame(data, "a int, b int, e int, x double, z int"), "a", "b", "e", ["x", "z"], **how).collect()
    beta = np.array([r["coef"] for r in out])
    h = 1e-4
    for i in range(2):
        step = np.eye(2)[i] * h
        up, mid, down = efron(data, beta + step), efron(data, beta), efron(data, beta - step)
        assert abs(up - down) / (2 * h) < 1e-3
        assert up <= mid + 1e-9 and down <= mid + 1e-9
    hess = np.array([[
        (efron(data, beta + h * (np.eye(2)[i] + np.eye(2)[j])) - efron(data, beta + h * (np.eye(2)[i] - np.eye(2)[j]))
         - efron(data, beta - h * (np.eye(2)[i] - np.eye(2)[j])) + efron(data, beta - h * (np.eye(2)[i] + np.eye(2)[j]))) / (4 * h * h)
        for j in range(2)] for i in range(2)])
    assert [r["se"] for r in out] == pytest.approx(list(np.sqrt(np.diag(np.linalg.inv(-hess)))), rel=1e-2)


def direct_bins(x, y, max_bin=20):
    """Quantile bins by direct search, for columns whose bins are never empty."""
    x, y = np.array(x), np.array(y)
    for n in range(max_bin, 1, -1):
        edges = np.quantile(x, np.arange(n + 1) / n)
        if len(set(edges)) < n + 1:
            continue
        which = np.maximum(np.searchsorted(edges, x, side="left") - 1, 0)
        rates = [y[which == b].mean() for b in range(n)]
        steps = np.diff(rates)
        if (steps > 0).all() or (steps < 0).all():
            return [(x[which == b].min(), x[which == b].max(), int((which == b).sum()), int(y[which == b].sum())) for b in range(n)]
    return None


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_monotone_bins_match_a_direct_search(frame, seed):
    rng = random.Random(seed)
    x = [rng.gauss(0, 5) for _ in range(400)]
    y = [int(rng.random() < 1 / (1 + math.exp(-v / 3))) for v in x]
    got = C.mono_bins(frame(list(zip(x, y)), "x double, y int"), "y", ["x"]).orderBy("min_value").collect()
    assert [(r["min_value"], r["max_value"], r["count"], r["event"]) for r in got] == direct_bins(x, y)


def test_forced_bins_of_a_skewed_column(frame):
    x = [1] * 80 + [2, 3, 4, 5] * 5
    df = frame([(v, i % 2) for i, v in enumerate(x)] + [(None, 1)], "x int, y int")
    got = {(r["min_value"], r["max_value"], r["count"], r["event"]) for r in C.mono_bins(df, "y", ["x"]).collect()}
    assert got == {(1.0, 1.0, 80, 40), (2.0, 5.0, 20, 10), (None, None, 1, 1)}


def test_woe_of_a_bin_without_events_is_zero(frame):
    df = frame([("a", 0)] * 4 + [("b", 1), ("b", 0)], "c string, y int")
    rows = {r["category"]: r for r in C.woe_iv(C.char_bins(df, "y", ["c"])).collect()}
    assert rows["a"]["woe"] == 0.0
    assert rows["b"]["woe"] == pytest.approx(math.log(1 / 0.2)) and rows["b"]["iv"] == pytest.approx((1 - 0.2) * math.log(5))
    assert sum(r["dist_event"] for r in rows.values()) == pytest.approx(1) and sum(r["dist_non_event"] for r in rows.values()) == pytest.approx(1)


def test_transform_above_the_top_bin_and_missing(frame):
    bins = frame([("x", 0.0, 1.0, None, 0.5), ("x", 2.0, 3.0, None, -0.5), ("x", None, None, None, 0.9)],
                 "var string, min_value double, max_value double, category string, woe double")
    df = frame([(0.5,), (1.5,), (9.0,), (None,)], "x double")
    assert [r["new_x"] for r in C.woe_transform(df, bins, ["x"]).collect()] == [0.5, -0.5, 0.0, 0.9]


def test_kinds(frame):
    df = frame([(1, 1, 5.0, "t"), (2, 0, 6.0, "u"), (3, 1, None, "u")], "three int, two int, holed double, text string")
    assert C.split_kinds(df, df.columns) == (["three"], ["two", "holed", "text"])


def test_points_formula():
    want = (0.4 * 0.7 + -1.0 / 16) * (20 / math.log(2)) + (600 - 20 / math.log(2) * math.log(50)) / 16
    from abacist.operators.credit import points

    assert "0.7" in str(points(F.lit(0.4), F.lit(0.7), -1.0, 16)) and want == pytest.approx(36.7, abs=1)


def test_areas_match_mllib(frame):
    rng = random.Random(6)
    data = [(round(rng.random(), 2), int(rng.random() < 0.4)) for _ in range(500)]
    df = frame(data, "s double, y int")
    for how in ({}, BLOCKS):
        got = E.auc(df, "s", "y", **how).first()
        mllib = lambda m: BinaryClassificationEvaluator(
            rawPredictionCol="s", labelCol="y", metricName=m, numBins=0).evaluate(df)
        assert got["auc_roc"] == pytest.approx(mllib("areaUnderROC"))
        assert got["auc_pr"] == pytest.approx(mllib("areaUnderPR"), abs=5e-3)


def test_lift_table_adds_up(frame):
    df = frame([(i / 1000, int(i >= 900)) for i in range(1000)], "s double, y int")
    rows = E.lift_table(df, "s", "y", 10).orderBy("bin").collect()
    assert [r["rows"] for r in rows] == [100] * 10 and rows[0]["lift"] == pytest.approx(10.0)
    assert rows[0]["cum_gain"] == 1.0 and rows[-1]["perc_selected"] == 1.0
    profit = E.campaign_profit(E.lift_table(df, "s", "y", 10), 50, 3, 1000).orderBy("bin").first()["profit"]
    assert profit == pytest.approx(50 * 100 - 3 * 100)


def vectors(n, seed, dim=4):
    rng = random.Random(seed)
    # a third of the rows share one crowded corner
    return [(i, [0.01 * rng.random() if i % 3 == 0 else rng.gauss(0, 3) for _ in range(dim)], i % 4) for i in range(n)]


@pytest.mark.parametrize("blocks", [16, 2048])
def test_nearest_is_exact(frame, blocks):
    rows = vectors(150, 1)
    df = frame(rows, "id int, x array<double>, y int")
    got = {}
    for r in N.nearest(df, df, "x", "id", 4, exclude_self=True, pivots=6, block_rows=blocks).collect():
        got.setdefault(r["id"], {})[r["rank"]] = r["neighbour"]
    for i, x, _ in rows:
        want = sorted((math.dist(x, z), j) for j, z, _ in rows if j != i)[:4]
        assert [got[i][k] for k in (1, 2, 3, 4)] == [j for _, j in want]


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_block_search_equals_plain_distances(offset):
    rng = np.random.default_rng(5)
    b = rng.normal(size=(900, 6)).round(1) + offset
    b[100:700] = b[0]  # more copies than are wanted
    b[3, 2], b[4, 1] = np.nan, np.inf
    ids = rng.permutation(900)
    at, near, d = N.block_search(3, True)(b, ids, b, ids)
    for i in range(900):
        with np.errstate(invalid="ignore"):
            plain = np.sqrt(((b - b[i]) ** 2).sum(axis=1))
        want = sorted((v, ids[j]) for j, v in enumerate(plain) if j != i and np.isfinite(v))[:3]
        assert list(zip(d[at == i], ids[near[at == i]])) == want


def test_blocks_grow_with_the_points(frame, monkeypatch):
    written = []
    plain = N.materialise
    monkeypatch.setattr(N, "materialise", lambda df: written.append(plain(df)) or written[-1])
    monkeypatch.setattr(N, "BLOCK_ROWS", 10)
    df = frame(vectors(1600, 2), "id int, x array<double>, y int")
    N.nearest(df, df, "x", "id", 1, exclude_self=True).count()
    pairs = [w for w in written if "q_part" in w.columns][0]
    assert pairs.count() <= (3 * N.BLOCKS) ** 2


def test_votes(frame):
    train = frame([(1, [0.0, 0.0], 0), (2, [0.1, 0.0], 0), (3, [5.0, 5.0], 1), (4, [5.1, 5.0], 1)], "id int, x array<double>, y int")
    test = frame([(10, [0.05, 0.0]), (11, [5.0, 5.1])], "id int, x array<double>")
    got = N.knn_vote(train, test, "x", "y", "id", k=2, pivots=2).collect()
    assert {r["id"]: r["prediction"] for r in got} == {10: 0, 11: 1}


def test_smote_balances_inside_the_minority(frame):
    rng = random.Random(2)
    rare = [(i, [rng.uniform(0, 1), rng.uniform(0, 1)], 1) for i in range(10)]
    df = frame(rare + [(100 + i, [9.0, 9.0], 0) for i in range(37)], "id int, x array<double>, y int")
    made = N.smote(df, "x", "y", "id", minority=1, k=3).collect()
    assert len(made) == 27 and all(r["y"] == 1 and all(0 <= v <= 1 for v in r["x"]) for r in made)


def test_rows_of_a_fits_task_are_bounded(frame, monkeypatch):
    class Probe:
        def fit(self, rows):
            return [len(p) for p in rows.rdd.glom().collect()]

    monkeypatch.setattr(M, "TASK_ROWS", 100)
    rows = M.features_of(frame([(float(i), i % 2) for i in range(5000)], "a double, y int").coalesce(1), ["a"], "y")
    sizes = M.fit(Probe(), rows)
    assert sum(sizes) == 5000 and max(sizes) <= 120
    assert max(len(p) for p in M.deal(rows).rdd.glom().collect()) <= 120


def test_selection_and_names(frame):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((a, b, rng.gauss(0, 1), int(a + 0.5 * b + rng.gauss(0, 0.5) > 0)))
    df = frame(rows, "a double, b double, c double, y int")
    steps = M.stepwise(df, df, ["c", "b", "a"], "y", M.logistic(), max_steps=2).orderBy("step").collect()
    assert [r["features"] for r in steps] == ["a", "a, b"] and steps[1]["auc_test"] > steps[0]["auc_test"]
    assert M.next_best(df, [], ["c", "b", "a"], "y", M.logistic(), max_n=2) == ["a", "b"]
    train = M.features_of(df, ["a", "b", "c"], "y")
    top = M.importance(M.tree().fit(train), train).first()
    assert top["feature"] == "a"


def test_poisson_rate(frame):
    df = frame([(x, 2 + x) for x in range(1, 11)], "x int, y int")
    model = M.poisson().fit(M.features_of(df, ["x"], "y"))
    assert M.poisson_rate(df, model, "x").first()["rate"] == pytest.approx(7.5, rel=1e-3)


def test_rows_with_missing_features_are_scored_as_null_and_never_learned_from(frame):
    rows = [(i, float(i % 7), float(i % 5) if i % 10 else None, i % 2) for i in range(60)]
    df = frame(rows, "id int, a double, b double, y int")
    known = df.where("b is not null")
    model = M.fit(M.logistic(), M.features_of(known, ["a", "b"], "y"))
    scored = M.score(model, M.features_of(df, ["a", "b"], keep=["id"])).collect()
    assert sorted(r["id"] for r in scored) == list(range(60))
    assert {r["id"] for r in scored if r["prob"] is None and r["predicted"] is None} == {0, 10, 20, 30, 40, 50}
    prepared = M.assemble(["a", "b"], "y").fit(known).transform(df)
    assert prepared.count() == 60 and M.score(model, prepared).where("prob is null").count() == 6
    scaled = P.scale_features(known, [df], ["a", "b"], "standard")[1]
    assert scaled.count() == 60
    whole = M.features_of(df, ["a", "b"], "y")
    for job in (lambda: M.fit(M.logistic(), whole), lambda: M.by_formula("y ~ a + b", df)[0].collect(),
                lambda: M.compare_models({"tree": M.tree()}, M.features_of(known, ["a", "b"], "y"), whole).collect(),
                lambda: P.select_by_corr(df, "y", ["a", "b"], 0.5), lambda: P.scale_features(df, [], ["a", "b"], "standard"),
                lambda: M.stepwise(known, df, ["a", "b"], "y", M.logistic()).collect()):
        with pytest.raises(Exception, match="(?i)missing values|null|nan"):
            job()


def test_next_best_orders_all_five_variables(spark):
    from abacist.queries import QUERIES

    rows = QUERIES["next_best"](spark, "/root/testdata/sf0.001").orderBy("step").collect()
    assert [r["step"] for r in rows] == [1, 2, 3, 4, 5] and len({r["variable"] for r in rows}) == 5
