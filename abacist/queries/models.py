"""Models on line items and orders; results are coefficients, metrics or scored rows."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from abacist.operators import batched as B
from abacist.operators import evaluate as E
from abacist.operators import models as M
from abacist.operators import neighbors as N
from abacist.operators import prep as D
from abacist.operators.network import fit_network
from abacist.operators.sampling import hash_split
from abacist.queries.registry import load, query
from abacist.session import materialise

DRAW = "CAST('0x' || substr(md5('123' || CAST({key} AS VARCHAR)), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0"
"""The draw of ``hash_split`` with seed 123 in SQL."""
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _rows(spark, sf):
    """Line items; the label is a high combined discount and tax on a large quantity."""
    return load(spark, sf, "lineitem").select(
        "l_orderkey", *FEATURES,
        ((F.col("l_discount") + F.col("l_tax") > 0.09) & (F.col("l_quantity") > 15)).cast("int").alias("target"),
    )


def _parts(spark, sf):
    """Training and test rows; the draw per row is made once and the rows lie evenly over the cores."""
    rows = M.deal(_rows(spark, sf))
    parts = materialise(hash_split(rows, "l_orderkey", {"train": 0.7, "test": 0.3}, 123))
    return [parts.where(F.col("split") == p) for p in ("train", "test")]


def _split(spark, sf):
    return [M.features_of(p, FEATURES, "target", keep=["l_orderkey"]) for p in _parts(spark, sf)]


def _metrics(est, spark, sf):
    """Areas under the curves of the fitted model on the test rows, from probabilities."""
    train, test = _split(spark, sf)
    scored = M.score(M.fit(est, train), test).withColumn("label", F.col("label").cast("int"))
    return E.auc(scored, "prob", "label", digits=4)


@query("model_lr")
def model_lr(spark, sf):
    return _metrics(M.logistic(), spark, sf)


@query("model_gbt")
def model_gbt(spark, sf):
    """Boosted regression on the 0/1 label; the prediction is the score."""
    return _metrics(M.gbt("regressor", maxIter=10), spark, sf)


@query("model_rf")
def model_rf(spark, sf):
    return _metrics(M.forest(trees=20, depth=30), spark, sf)


@query("model_dt")
def model_dt(spark, sf):
    return _metrics(M.tree(), spark, sf)


@query("model_svm")
def model_svm(spark, sf):
    return _metrics(M.svm(maxIter=20), spark, sf)


@query("model_mlp")
def model_mlp(spark, sf):
    """Two hidden layers of sixteen nodes on standardised features."""
    train, test = _parts(spark, sf)
    train, test = D.scale_features(train, [test], FEATURES, "standard")
    label = F.col("target").cast("double").alias("label")
    model = fit_network(M.mlp([5, 16, 16, 2], maxIter=30), train.select(label, "features"))
    scored = M.score(model, test.select(label, "features")).withColumn("label", F.col("label").cast("int"))
    return E.auc(scored, "prob", "label", digits=4)


LINEAR = ["l_quantity", "l_discount", "l_tax"]


@query("model_lin")
def model_lin(spark, sf):
    """Linear regression with ridge and with lasso penalty, by ten folds of the orders."""
    items = load(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", *LINEAR)
    found = B.elastic_net_folds(items, LINEAR, "l_extendedprice", "l_orderkey", [0.01], [0.0, 1.0], folds=10)
    return found.select("reg", "elastic", F.round("rmse", 4).alias("rmse"))


@query(
    "model_least_squares",
    """WITH c AS (
      SELECT var_pop(l_quantity) AS qq, var_pop(l_discount) AS dd, var_pop(l_tax) AS tt, covar_pop(l_quantity, l_discount) AS qd,
        covar_pop(l_quantity, l_tax) AS qt, covar_pop(l_discount, l_tax) AS dt, covar_pop(l_quantity, l_extendedprice) AS qy,
        covar_pop(l_discount, l_extendedprice) AS dy, covar_pop(l_tax, l_extendedprice) AS ty, avg(l_quantity) AS q, avg(l_discount) AS d,
        avg(l_tax) AS t, avg(l_extendedprice) AS y FROM lineitem),
    s AS (SELECT *, qq * (dd * tt - dt * dt) - qd * (qd * tt - dt * qt) + qt * (qd * dt - dd * qt) AS det FROM c),
    b AS (SELECT *, (qy * (dd * tt - dt * dt) - qd * (dy * tt - dt * ty) + qt * (dy * dt - dd * ty)) / det AS bq,
      (qq * (dy * tt - dt * ty) - qy * (qd * tt - dt * qt) + qt * (qd * ty - dy * qt)) / det AS bd,
      (qq * (dd * ty - dy * dt) - qd * (qd * ty - dy * qt) + qy * (qd * dt - dd * qt)) / det AS bt FROM s)
    SELECT unnest(['intercept', 'l_quantity', 'l_discount', 'l_tax']) AS variable,
      unnest([round(y - bq * q - bd * d - bt * t, 3), round(bq, 3), round(bd, 3), round(bt, 3)]) AS coef FROM b""",
)
def model_least_squares(spark, sf):
    """Least squares from the moments of ten folds, by the normal equations."""
    items = load(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", *LINEAR)
    fit = B.elastic_net_folds(items, LINEAR, "l_extendedprice", "l_orderkey", [0.0], [0.0], folds=10).first()
    rows = list(zip(["intercept", *LINEAR], [fit["intercept"], *fit["coefficients"]]))
    return spark.createDataFrame(rows, "variable string, coef double").withColumn("coef", F.round("coef", 3))


@query("model_poisson")
def model_poisson(spark, sf):
    """Line number by quantity: intercept, slope and the mean fitted rate."""
    items = load(spark, sf, "lineitem", "l_linenumber", "l_quantity")
    model = M.poisson().fit(M.features_of(items, ["l_quantity"], "l_linenumber"))
    return M.poisson_rate(items, model, "l_quantity").select(
        F.lit(float(model.intercept)).alias("b0"), F.lit(float(model.coefficients[0])).alias("b1"), "rate"
    )


@query(
    "poisson_moments",
    """SELECT unnest(['intercept', 'l_quantity']) AS variable, unnest([round(avg(l_linenumber), 4),
      round(sum(l_linenumber * l_quantity) / sum(l_quantity), 4)]) AS mean FROM lineitem""",
)
def poisson_moments(spark, sf):
    """First-order conditions of the Poisson regression: mean rate, plain and weighted by quantity, as the counts have it."""
    items = load(spark, sf, "lineitem", "l_linenumber", "l_quantity")
    model = M.poisson(tol=1e-10, maxIter=100).fit(M.features_of(items, ["l_quantity"], "l_linenumber"))
    rate = F.exp(F.lit(float(model.intercept)) + F.lit(float(model.coefficients[0])) * F.col("l_quantity"))
    found = items.agg(F.avg(rate).alias("intercept"), (F.sum(rate * F.col("l_quantity")) / F.sum("l_quantity")).alias("l_quantity"))
    return found.select(F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.round(c, 4).alias("mean")) for c in found.columns])))


@query("model_formula")
def model_formula(spark, sf):
    """Formula features learned on the training rows, logistic regression, coefficient per feature."""
    orders = load(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.month("o_orderdate").alias("month"),
        (F.col("o_totalprice") > F.when(F.col("o_orderstatus") == "F", 200000).otherwise(300000)).cast("int").alias("target"),
    )
    parts = hash_split(orders, "o_orderkey", {"train": 0.7, "test": 0.3}, 123)
    train, test = M.by_formula(
        "target ~ . - o_orderkey - split", parts.where(F.col("split") == "train"), parts.where(F.col("split") == "test")
    )
    model = M.fit(M.logistic(), train)
    return M.coefficients(model, M.feature_names(train), spark)


@query("model_pipeline")
def model_pipeline(spark, sf):
    """Indexed texts, assembled features and a tree in one fitted pipeline; confusion counts."""
    items = load(spark, sf, "lineitem").select(
        "l_quantity", "l_discount", "l_linestatus", "l_returnflag"
    )
    prepared = M.assemble(["l_quantity", "l_discount"], "l_returnflag", ["l_linestatus"]).fit(items).transform(items)
    model = M.fit(M.tree(), prepared)
    return model.transform(prepared).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "model_scaled",
    f"""WITH r AS (SELECT l_quantity AS x, CASE WHEN {DRAW.format(key='l_orderkey')} < 0.7 THEN 'train' ELSE 'test' END AS split FROM lineitem),
    t AS (SELECT min(x) AS low, max(x) AS high FROM r WHERE split = 'train')
    SELECT split, round(min((x - t.low) / (t.high - t.low)), 9) AS low, round(max((x - t.low) / (t.high - t.low)), 9) AS high FROM r, t GROUP BY split""",
)
def model_scaled(spark, sf):
    """Min-max scaling fitted on the training rows; range of the first slot in both parts."""
    train, test = _parts(spark, sf)
    train, test = D.scale_features(train, [test], FEATURES, "minmax")
    both = train.unionByName(test).select("split", vector_to_array("features")[0].alias("x"))
    return both.groupBy("split").agg(F.round(F.min("x"), 9).alias("low"), F.round(F.max("x"), 9).alias("high"))


@query("cv_grid")
def cv_grid(spark, sf):
    """Logistic regression over a grid with three folds; all folds and grid points are fitted together."""
    train, _ = _parts(spark, sf)
    return B.logistic_grid_folds(train, FEATURES, "target", [0.0, 0.1], [0.0, 0.5], folds=3)


@query("model_zoo")
def model_zoo(spark, sf):
    """Five estimators on the same rows."""
    train, test = [d.select("label", "features") for d in _split(spark, sf)]
    zoo = {
        "logistic": M.logistic(), "tree": M.tree(), "forest": M.forest(trees=100, depth=30),
        "boosting": M.gbt(maxIter=5), "svm": M.svm(maxIter=10),
    }
    return M.compare_models(zoo, train, test)


@query("stepwise")
def stepwise(spark, sf):
    """Forward selection over the five columns; all candidates of a step are fitted together."""
    train, test = _parts(spark, sf)
    return B.stepwise_logistic(train, test, FEATURES, "target")


@query("next_best")
def next_best(spark, sf):
    """Order in which variables raise the area under ROC of a logistic regression most, at most five."""
    names = B.next_best_logistic(_rows(spark, sf), [], FEATURES, "target", max_n=5)
    return spark.createDataFrame(list(enumerate(names, 1)), "step int, variable string")


SETS = [[f] for f in FEATURES] + [FEATURES]


@query(
    "logit_moments",
    "WITH r AS (SELECT *, l_discount + l_tax > 0.09 AND l_quantity > 15 AS y FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{', '.join(s)}' AS features, '{v}' AS variable, round(sum(CASE WHEN y THEN {x} ELSE 0 END) / sum({x}), 6) AS share FROM r"
                         for s in SETS for v, x in [("intercept", "1"), *[(c, f"CAST({c} AS DOUBLE)") for c in s]]),
)
def logit_moments(spark, sf):
    """First-order conditions of six logistic regressions fitted together: shares of each column that the fits and the labels expect."""
    rows = materialise(_rows(spark, sf).select("target", *FEATURES))
    shares, names = [], []
    for fit in B.logistic_fits(rows, "target", SETS):
        p = 1 / (1 + F.exp(-fit.margin()))
        for name, x in [("intercept", F.lit(1.0)), *[(c, F.col(c).cast("double")) for c in fit.columns]]:
            names.append((", ".join(fit.columns), name))
            shares.append((F.sum(p * x) / F.sum(x)).alias(f"s{len(names)}"))
    found = rows.agg(*shares).first()
    out = [(*name, round(value, 6)) for name, value in zip(names, found)]
    return spark.createDataFrame(out, "features string, variable string, share double")


@query(
    "select_by_corr",
    "WITH r AS (SELECT *, CASE WHEN l_discount + l_tax > 0.09 AND l_quantity > 15 THEN 1 ELSE 0 END AS y FROM lineitem), c AS ("
    + " UNION ALL ".join(f"SELECT '{f}' AS variable, corr({f}, y) AS r, count(*) AS n FROM r" for f in FEATURES)
    + ") SELECT variable FROM c WHERE r * r * (n - 2) / (1 - r * r) > 10.8283",  # the 0.999 quantile of F with 1 and many degrees
)
def select_by_corr(spark, sf):
    """Columns whose correlation with the label has a small p-value."""
    names = D.select_by_corr(_rows(spark, sf), "target", FEATURES, 0.001)
    return spark.createDataFrame([(n,) for n in names], "variable string")


@query("feature_importance")
def feature_importance(spark, sf):
    train, _ = _split(spark, sf)
    return M.importance(M.fit(M.tree(), train), train)


@query("batch_scores")
def batch_scores(spark, sf):
    """Probability and class of every test row."""
    train, test = _split(spark, sf)
    return M.score(M.fit(M.logistic(), train), test).select("l_orderkey", "prob", "predicted")


def _vectors(spark, sf):
    return load(spark, sf, "embeddings").select("vec_id", "embedding", "label")


@query(
    "knn_vote",
    f"""WITH p AS (SELECT *, {DRAW.format(key='vec_id')} < 0.7 AS train FROM embeddings),
    d AS (SELECT a.vec_id, b.vec_id AS neighbour, b.label,
      list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))) AS distance
      FROM p a JOIN p b ON NOT a.train AND b.train),
    r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) AS rank FROM d),
    v AS (SELECT vec_id, label, COUNT(*) AS n FROM r WHERE rank <= 5 GROUP BY ALL)
    SELECT vec_id, arg_min(label, (-n, label)) AS prediction FROM v GROUP BY vec_id""",
)
def knn_vote(spark, sf):
    """Label of every test embedding by its five nearest training embeddings."""
    parts = hash_split(_vectors(spark, sf), "vec_id", {"train": 0.7, "test": 0.3}, 123)
    train, test = parts.where(F.col("split") == "train"), parts.where(F.col("split") == "test")
    return N.knn_vote(train, test, "embedding", "label", "vec_id", 5)


@query(
    "nearest_vectors",
    """WITH d AS (SELECT a.vec_id AS id, b.vec_id AS neighbour,
      sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)))) AS distance
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
    r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY distance, neighbour) AS rank FROM d)
    SELECT id, neighbour, ROUND(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""",
)
def nearest_vectors(spark, sf):
    """Three nearest other embeddings of every embedding, exact."""
    rows = _vectors(spark, sf)
    return N.nearest(rows, rows, "embedding", "vec_id", 3, exclude_self=True).withColumn("distance", F.round("distance", 6))


@query("smote")
def smote(spark, sf):
    """Synthetic rows of the label that fills the gap to all other labels; size and mean per slot."""
    rows = _vectors(spark, sf).withColumn("embedding", F.col("embedding").cast("array<double>"))
    made = N.smote(rows, "embedding", "label", "vec_id", minority=0, k=5)
    return made.groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.col("embedding")[0]).alias("first"), F.avg(F.size("embedding")).alias("size")
    )
