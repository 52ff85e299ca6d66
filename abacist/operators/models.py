"""Model training, tuning, selection and scoring on MLlib."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import RFormula, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.operators import forests
from abacist.session import materialise

AT_ONCE = 4
"""Candidate models trained at the same time on the cluster."""
TASK_ROWS = 500_000
"""Rows of one task of a fit: a cached partition is read whole, so it must not grow with the table."""


def logistic(**params) -> Estimator:
    return C.LogisticRegression(**params)


def gbt(mode: str = "classifier", **params) -> Estimator:
    return C.GBTClassifier(**params) if mode == "classifier" else R.GBTRegressor(**params)


def forest(trees: int = 20, depth: int = 30, seed: int = 42, **params) -> Estimator:
    return C.RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **params)


def tree(depth: int = 5, bins: int = 32, **params) -> Estimator:
    return C.DecisionTreeClassifier(maxDepth=depth, maxBins=bins, **params)


def linear(reg: float = 0.0, elastic: float = 0.0, **params) -> Estimator:
    return R.LinearRegression(regParam=reg, elasticNetParam=elastic, **params)


def svm(**params) -> Estimator:
    """Linear support vector machine."""
    return C.LinearSVC(**params)


def mlp(layers: Sequence[int], seed: int = 42, **params) -> Estimator:
    """Feed-forward network; ``layers`` starts with the inputs and ends with the classes."""
    return C.MultilayerPerceptronClassifier(layers=list(layers), seed=seed, **params)


def poisson(**params) -> Estimator:
    """Poisson regression with log link."""
    return R.GeneralizedLinearRegression(family="poisson", link="log", **params)


def poisson_rate(df: DataFrame, model: Model, x: str) -> DataFrame:
    """Mean fitted rate."""
    return df.agg(F.avg(F.exp(F.lit(float(model.intercept)) + F.lit(float(model.coefficients[0])) * F.col(x))).alias("rate"))


def lacks(col: str = "features") -> Column:
    """Whether a feature vector is null or has a missing number."""
    return F.col(col).isNull() | F.exists(vector_to_array(col), F.isnan)


def complete(rows: DataFrame, col: str = "features") -> DataFrame:
    """The same rows; one without all its features stops the job."""
    stop = F.raise_error(F.lit(f"missing values in {col}: impute them, or only score such rows"))
    return rows.where(F.when(lacks(col), stop).otherwise(F.lit(True)))


def by_formula(formula: str, train: DataFrame, *others: DataFrame) -> list[DataFrame]:
    """Features and label of an R formula, learned on the training rows only. Missing values and new categories raise."""
    model = RFormula(formula=formula, handleInvalid="error").fit(train)
    return [model.transform(d) for d in (train, *others)]


def assemble(cols: Sequence[str], label: str | None = None, indexed: Sequence[str] = ()) -> Pipeline:
    """Stages that index text columns and the label and assemble the feature vector; no row is left out."""
    stages = [StringIndexer(inputCol=c, outputCol=c + "_ix", handleInvalid="keep") for c in indexed]
    if label:
        stages.append(StringIndexer(inputCol=label, outputCol="label", handleInvalid="error"))
    inputs = [*cols, *[c + "_ix" for c in indexed]]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")])


def features_of(df: DataFrame, cols: Sequence[str], label: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Feature vector of numeric columns, with label and kept columns only. Missing numbers are NaN: no row is left out."""
    out = VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep").transform(df)
    labels = [F.col(label).cast("double").alias("label")] if label else []
    return out.select(*keep, *labels, "features")


def grid(est: Estimator, options: Mapping[str, Sequence]) -> list:
    builder = ParamGridBuilder()
    for name, values in options.items():
        builder = builder.addGrid(est.getParam(name), list(values))
    return builder.build()


def cross_validate(est: Estimator, options: Mapping[str, Sequence], evaluator, train: DataFrame, folds: int = 3, seed: int = 42):
    return CrossValidator(
        estimator=est, estimatorParamMaps=grid(est, options), evaluator=evaluator, numFolds=folds,
        parallelism=AT_ONCE, seed=seed,
    ).fit(complete(deal_more(train)))


def train_validation(est: Estimator, options: Mapping[str, Sequence], evaluator, train: DataFrame, ratio: float = 0.75, seed: int = 42):
    return TrainValidationSplit(
        estimator=est, estimatorParamMaps=grid(est, options), evaluator=evaluator, trainRatio=ratio,
        parallelism=AT_ONCE, seed=seed,
    ).fit(complete(deal_more(train)))


def cv_results(fitted, options: Mapping[str, Sequence], spark) -> DataFrame:
    """Mean metric per grid point."""
    metrics = getattr(fitted, "avgMetrics", None) or fitted.validationMetrics
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda e: e[0].name)), float(x))
        for m, x in zip(fitted.getEstimatorParamMaps(), metrics)
    ]
    return spark.createDataFrame(rows, "params string, metric double")


def deal(rows: DataFrame, task_rows: int | None = None) -> DataFrame:
    """The same rows dealt evenly over tasks: one per core, more where a task would exceed ``task_rows``."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, -(-rows.count() // (task_rows or TASK_ROWS))))


def deal_more(rows: DataFrame, task_rows: int | None = None) -> DataFrame:
    """The same rows, dealt over more tasks only where one per core would exceed ``task_rows``."""
    n, task_rows = rows.count(), task_rows or TASK_ROWS
    return rows if n <= task_rows * rows.sparkSession.sparkContext.defaultParallelism else rows.repartition(-(-n // task_rows))


def fit(est: Estimator, rows: DataFrame) -> Model:
    """Fit on cached label and features: a fit passes over its rows many times. A large forest grows on counts and reads them twice."""
    rows = rows.select("label", "features")
    grown = _large_forest(est, rows)
    if grown:
        return grown
    rows = complete(deal_more(rows)).cache()
    try:
        return est.fit(rows)
    finally:
        rows.unpersist()


def _large_forest(est: Estimator, rows: DataFrame) -> Model | None:
    """The forest on counted bins; None for a fit that is left to MLlib's trainer."""
    if not isinstance(est, C.RandomForestClassifier):
        return None
    n = rows.count()
    return forests.fit_forest(est, rows, n) if forests.is_large(est, n) else None


def fit_counted(est: Estimator, rows: DataFrame, cols: Sequence[str], label: str) -> Model:
    """Fit on the distinct rows of label and features, weighted by their number.

    Features that take few values, such as weights of evidence, leave a small table, whose size hangs on the values and not on the rows:
    the many passes of a fit read that one. An estimator that weights would not serve alike gets every row.
    """
    if not _weighs_alike(est):
        return fit(est, features_of(rows, cols, label))
    counts = materialise(
        rows.select(F.col(label).cast("double").alias("label"), *cols).groupBy("label", *cols)
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    dealt = complete(deal(features_of(counts, cols, "label", ["weight"]))).cache()
    try:
        model = est.copy({est.weightCol: "weight"}).fit(dealt)
    finally:
        dealt.unpersist()
    model.clear(model.weightCol)
    return model


def _weighs_alike(est: Estimator) -> bool:
    """Whether n equal rows and one of weight n give the same model: a penalty would meet other deviations, samples other rows."""
    return isinstance(est, C.LogisticRegression) and not est.isSet(est.weightCol) and est.getRegParam() == 0


def score(model: Model, df: DataFrame, threshold: float = 0.5, name: str = "prob") -> DataFrame:
    """Probability of class 1 and the prediction at the threshold.

    A model without probabilities gives its raw margin, and a regression gives its prediction.
    A row without all its features stays, with null for both.
    """
    out = model.transform(df)
    if "probability" in out.columns:
        p = vector_to_array("probability")[1]
    elif "rawPrediction" in out.columns:
        p, threshold = vector_to_array("rawPrediction")[1], 0.0
    else:
        p = F.col("prediction")
    if "features" in out.columns:
        p = F.when(~lacks(), p)
    return out.withColumn(name, p).withColumn("predicted", (F.col(name) > threshold).cast("int"))


def score_columns(model: Model, df: DataFrame, cols: Sequence[str], keep: Sequence[str], name: str = "prob") -> DataFrame:
    """``score`` of plain columns, with kept columns only: two classes of a logistic model are an expression without feature vectors."""
    if not isinstance(model, C.LogisticRegressionModel) or model.coefficientMatrix.numRows != 1:
        return score(model, features_of(df, cols, keep=keep), name=name).select(*keep, name, "predicted")
    margin = sum((F.col(c).cast("double") * F.lit(float(v)) for c, v in zip(cols, model.coefficients.toArray())), F.lit(float(model.intercept)))
    prob = F.nanvl(F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)), F.lit(None))
    return df.select(*keep, prob.alias(name)).withColumn("predicted", (F.col(name) > 0.5).cast("int"))


def rank_scores(df: DataFrame, score_col: str) -> DataFrame:
    return df.orderBy(F.desc(score_col))


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of the slots of a feature vector, from its metadata."""
    attrs = df.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for kind in attrs.values() for a in kind)
    return [name for _, name in slots]


def importance(model: Model, df: DataFrame, col: str = "features") -> DataFrame:
    """Importance per feature name, largest first."""
    names = feature_names(df, col)
    rows = list(zip(names, [float(v) for v in model.featureImportances.toArray()]))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


def coefficients(model: Model, names: Sequence[str], spark) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, model.coefficients.toArray())]
    return spark.createDataFrame(rows, "var string, coef double")


def attach_scores(df: DataFrame, scored: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Scores joined back to their source rows by key."""
    return df.join(scored.select(key, *cols), key, "left")


def _auc(model: Model, df: DataFrame) -> float:
    raw = "rawPrediction" if "rawPrediction" in model.transform(df).columns else "prediction"
    return float(BinaryClassificationEvaluator(rawPredictionCol=raw).evaluate(model.transform(df)))


def compare_models(zoo: Mapping[str, Estimator], train: DataFrame, test: DataFrame) -> DataFrame:
    """Fit every estimator on the same cached rows; accuracy and area under ROC on the test rows."""
    train, test = complete(deal_more(train)).cache(), complete(deal_more(test)).cache()
    try:
        def one(item):
            name, est = item
            model = _large_forest(est, train) or est.fit(train)  # the rows are cached for all estimators
            scored = score(model, test)
            raw = vector_to_array("rawPrediction")[1] if "rawPrediction" in scored.columns else F.col("prediction")
            scored = scored.select("label", "predicted", raw.alias("raw")).cache()  # rows are scored once
            try:
                hit = scored.agg(F.avg((F.col("predicted") == F.col("label").cast("int")).cast("double"))).first()[0]
                return name, float(hit), float(BinaryClassificationEvaluator(rawPredictionCol="raw").evaluate(scored))
            finally:
                scored.unpersist()

        with ThreadPoolExecutor(AT_ONCE) as pool:
            rows = list(pool.map(one, zoo.items()))
    finally:
        train.unpersist()
        test.unpersist()
    return test.sparkSession.createDataFrame(rows, "model string, accuracy double, auc double")


def _try_features(est: Estimator, train: DataFrame, test: DataFrame, target: str, chosen: Sequence[str]):
    a, b = features_of(train, chosen, target), features_of(test, chosen, target)
    model = fit(est, a)
    return _auc(model, complete(a)), _auc(model, complete(b))


def stepwise(
    train: DataFrame, test: DataFrame, candidates: Sequence[str], target: str, est: Estimator,
    max_steps: int | None = None,
) -> DataFrame:
    """Forward selection: each step adds the column that gives the best area under ROC on the test rows."""
    cols = [*candidates, target]
    train, test = train.select(*cols).cache(), test.select(*cols).cache()
    chosen: list[str] = []
    rows = []
    try:
        with ThreadPoolExecutor(AT_ONCE) as pool:
            for step in range(1, (max_steps or len(candidates)) + 1):
                left = [c for c in candidates if c not in chosen]
                if not left:
                    break
                tried = list(pool.map(lambda c: (c, *_try_features(est, train, test, target, [*chosen, c])), left))
                name, on_train, on_test = max(tried, key=lambda t: (t[2], t[0]))
                chosen.append(name)
                rows.append((step, ", ".join(chosen), on_train, on_test))
    finally:
        train.unpersist()
        test.unpersist()
    return train.sparkSession.createDataFrame(rows, "step int, features string, auc_train double, auc_test double")


def next_best(
    df: DataFrame, current: Sequence[str], candidates: Sequence[str], target: str, est: Estimator, max_n: int = 5
) -> list[str]:
    """Variables in the order that raises area under ROC on the same rows most, up to ``max_n``."""
    chosen = list(current)
    while len(chosen) < max_n and any(c not in chosen for c in candidates):
        steps = stepwise_once(df, chosen, [c for c in candidates if c not in chosen], target, est)
        chosen.append(steps)
    return chosen


def stepwise_once(df: DataFrame, chosen: Sequence[str], left: Sequence[str], target: str, est: Estimator) -> str:
    rows = df.select(*chosen, *left, target).cache()
    try:
        with ThreadPoolExecutor(AT_ONCE) as pool:
            tried = list(pool.map(lambda c: (_try_features(est, rows, rows, target, [*chosen, c])[0], c), left))
    finally:
        rows.unpersist()
    return max(tried)[1]
