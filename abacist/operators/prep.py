"""Preparation of analytical base tables: missing values, outliers, dummies, gift features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.functions.scalars import days_between, exact_mean, safe_divide
from abacist.operators.aggregates import bundle
from abacist.operators.quantiles import exact_quantiles


def fill_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Numeric nulls to 0; text columns stay."""
    return df.fillna(0, subset=list(cols) if cols else None)


def fill_value(df: DataFrame, col: str, value: float) -> DataFrame:
    return df.fillna(value, subset=[col])


def null_flags(df: DataFrame, cols: Sequence[str], suffix: str = "_NA") -> DataFrame:
    return df.withColumns({c + suffix: F.col(c).isNull().cast("int") for c in cols})


def median_impute(df: DataFrame, cols: Sequence[str], flag: bool = False) -> DataFrame:
    """Missing values to the exact median of the column, all columns from the same passes."""
    medians = exact_quantiles(df, cols, [0.5])
    out = null_flags(df, cols) if flag else df
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(medians[c][0])) for c in cols})


def clip_sigma(df: DataFrame, col: str, k: float = 3.0, name: str | None = None) -> DataFrame:
    """Pull values in to the mean plus or minus ``k`` sample standard deviations."""
    limits = df.agg(F.avg(col).alias("m"), F.stddev_samp(col).alias("s"))
    low = limits.select(F.col("m") - F.col("s") * k).scalar()
    high = limits.select(F.col("m") + F.col("s") * k).scalar()
    clipped = F.when(F.col(col).isNotNull(), F.least(F.greatest(F.col(col), low), high))
    return df.withColumn(name or col, clipped)


def winsorize(df: DataFrame, cols: Sequence[str], lower: float = 0.0, upper: float = 0.04) -> DataFrame:
    """Largest ``upper`` share takes the next value below it; ``lower`` likewise at the bottom."""
    out = df
    top = exact_quantiles(df, cols, [1 - upper], how="higher_tail") if upper else None
    bottom = None
    if lower:
        mirrored = df.select(*[(-F.col(c)).alias(c) for c in cols])
        bottom = exact_quantiles(mirrored, cols, [1 - lower], how="higher_tail")
    changes = {}
    for c in cols:
        v = F.col(c)
        if top is not None and top[c][0] is not None:
            v = F.when(F.col(c).isNotNull(), F.least(v, F.lit(top[c][0])))
        if bottom is not None and bottom[c][0] is not None:
            v = F.when(F.col(c).isNotNull(), F.greatest(v, F.lit(-bottom[c][0])))
        changes[c] = v
    return out.withColumns(changes)


def one_hot(
    df: DataFrame, col: str, categories: Sequence[str], drop_first: bool = False, nan: bool = False,
    prefix: str | None = None,
) -> DataFrame:
    """0/1 column per category in the given order, optionally one for missing."""
    p = (prefix or col) + "_"
    kept = list(categories)[1:] if drop_first else list(categories)
    made = {f"{p}{c}": F.coalesce((F.col(col) == F.lit(c)).cast("int"), F.lit(0)) for c in kept}
    if nan:
        made[f"{p}NaN"] = F.col(col).isNull().cast("int")
    return df.withColumns(made).drop(col)


def rfm(gifts: DataFrame, id_col: str, amount: str, date_col: str, ref: date) -> list[Column]:
    """Aggregates of one donor up to the reference date: amount bundle and days since the last gift."""
    return [*bundle(amount), days_between(F.max(date_col), F.lit(ref)).alias("recency_days")]


def window_features(amount: str, date_col: str, ref: date) -> list[Column]:
    """Aggregates over the last month, the last year and the year before it, from the same rows."""
    month = F.add_months(F.lit(ref), -1)
    year1 = F.add_months(F.lit(ref), -12)
    year2 = F.add_months(F.lit(ref), -24)
    d, a = F.col(date_col), F.col(amount)
    in_month = F.when(d.between(month, F.lit(ref)), a)
    in_year1 = F.when(d.between(year1, F.lit(ref)), a)
    in_year2 = F.when((d >= year2) & (d < year1), a)
    count = lambda c: F.nullif(F.count(c), F.lit(0))  # noqa: E731  a period without gifts is missing, not 0
    return [
        exact_mean(in_month).alias("last_month_mean"),
        exact_mean(in_year1).alias("year1_mean"),
        count(in_year1).alias("year1_count"),
        exact_mean(in_year2).alias("year2_mean"),
        count(in_year2).alias("year2_count"),
    ]


def gift_features(
    gifts: DataFrame, id_col: str, amount: str, date_col: str, ref: date
) -> DataFrame:
    """All gift features of every donor in one aggregation and one shuffle."""
    known = gifts.where(F.col(date_col) <= F.lit(ref))
    return known.groupBy(id_col).agg(
        *rfm(known, id_col, amount, date_col, ref), *window_features(amount, date_col, ref)
    )


def ratios(df: DataFrame, pairs: Mapping[str, tuple[str, str]], fill: float | None = None) -> DataFrame:
    """Named quotients of two columns; null (or ``fill``) when the divisor is zero or missing."""
    made = {n: safe_divide(a, b) for n, (a, b) in pairs.items()}
    if fill is not None:
        made = {n: F.coalesce(c, F.lit(fill)) for n, c in made.items()}
    return df.withColumns(made)


def segment(mean: str, count: str, overall: Column) -> Column:
    """Value segment against the mean of all gifts."""
    m, n = F.col(mean), F.col(count)
    return (
        F.when((m > 1.5 * overall) & (n >= 5), "Gold")
        .when((m >= overall) & (n >= 3), "Silver")
        .when((m > 0.5 * overall) & (n >= 3), "Bronze")
        .otherwise("Regular")
    )


def bucket(col: str, edges: Sequence[float]) -> Column:
    """Ordinal class of a ratio: class i from edge i up to edge i+1, the first edge itself excluded.

    Zero and missing ratios fall in no class and are then set to 0, as missing numbers are.
    """
    c = F.col(col)
    out = F.when((c > edges[0]) & (c < edges[1]), 0)
    for i in range(1, len(edges) - 1):
        out = out.when((c >= edges[i]) & (c < edges[i + 1]), i)
    return F.coalesce(out.when(c >= edges[-1], len(edges) - 1), F.lit(0))


def label_at_least(col: str, n: int) -> Column:
    return F.when(F.col(col) >= n, 1).otherwise(0)


def relabel(col: str, cut: float, high: str, low: str) -> Column:
    """``high`` from the cut upwards, else ``low``; missing counts as below every number."""
    return F.when(F.col(col) >= cut, high).otherwise(low)


def interact(a: str, b: str) -> Column:
    return F.col(a) * F.col(b)


def select_by_corr(df: DataFrame, target: str, candidates: Sequence[str], p_below: float) -> list[str]:
    """Candidates whose linear correlation with the target has a p-value below the bound. Missing values raise."""
    from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler

    rows = VectorAssembler(inputCols=list(candidates), outputCol="features", handleInvalid="error").transform(
        df.select(F.col(target).cast("double").alias("label"), *candidates)
    )
    selector = UnivariateFeatureSelector(
        featuresCol="features", labelCol="label", outputCol="kept", selectionMode="fpr"
    ).setFeatureType("continuous").setLabelType("continuous").setSelectionThreshold(p_below)
    return [candidates[i] for i in selector.fit(rows).selectedFeatures]


def scale_features(train: DataFrame, others: Sequence[DataFrame], cols: Sequence[str], kind: str) -> list[DataFrame]:
    """Standardise or min-max scale an assembled vector; fitted on the training rows only.

    Missing numbers raise in training rows and stay missing in the others.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    scalers = {
        "standard": StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
        "minmax": MinMaxScaler(inputCol="raw_features", outputCol="features"),
    }
    assembler = VectorAssembler(inputCols=list(cols), outputCol="raw_features", handleInvalid="keep")
    VectorAssembler(inputCols=list(cols), outputCol="raw_features", handleInvalid="error").transform(train).select(
        F.sum(F.size(vector_to_array("raw_features")))).first()
    model = Pipeline(stages=[assembler, scalers[kind]]).fit(train)
    return [model.transform(d).drop("raw_features") for d in (train, *others)]
