"""Scorecard: split, bins, oversampling, model, reject inference, refit and points."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.operators import credit, models
from abacist.operators.neighbors import smote
from abacist.operators.prep import fill_zero
from abacist.operators.sampling import hash_number, split_by_draw
from abacist.session import materialise

SHARES = {"train": 0.6, "valid": 0.2, "test": 0.2}


@dataclass
class Scorecard:
    bins: DataFrame
    iv: DataFrame
    card: DataFrame
    model: Model
    mono: list[str]
    chars: list[str]


def _woe_features(rows: DataFrame, bins: DataFrame, mono: Sequence[str], chars: Sequence[str], keep: Sequence[str]) -> DataFrame:
    woe = credit.woe_transform(rows, bins, mono, chars)
    cols = ["new_" + x for x in [*mono, *chars]]
    return VectorAssembler(inputCols=cols, outputCol="features").transform(woe).select(*keep, "features")


def run_scorecard(
    accepts: DataFrame, rejects: DataFrame, id_col: str, y: str, xs: Sequence[str],
    estimator: Estimator | None = None, accept: float = 0.2, seed: int = 42, pooled: bool = False,
    oversample: Mapping | None = None, draw: str | None = None,
) -> tuple[Scorecard, DataFrame]:
    """Scorecard and scored test rows.

    The first model learns on the accepted training rows and labels the rejects; bins, model and
    points then come from accepted rows and labelled rejects together. ``oversample`` holds the
    arguments for synthetic minority rows in the first training set. ``draw`` names a column of a written
    ``accepts`` with a ``hash_number`` per row, in place of ``seed``; without it they are written with one.
    """
    est = estimator or models.logistic()
    accepts = fill_zero(accepts)
    rejects = fill_zero(rejects)
    drawn = accepts if draw else materialise(accepts.withColumn("__draw", hash_number(id_col, seed)))
    split = drawn.withColumn("split", split_by_draw(drawn, draw or "__draw", y, [0, 1], SHARES))
    train = split.where(F.col("split") == "train")
    mono, chars = credit.split_kinds(train, xs)
    bins = credit.bin_all(train, y, xs, (mono, chars))
    names = ["new_" + x for x in [*mono, *chars]]
    if oversample is None:
        first = models.fit_counted(est, credit.woe_transform(train, bins, mono, chars), names, y)
    else:
        rows = _woe_features(train, bins, mono, chars, [id_col, y]).withColumnRenamed(y, "label")
        arrays = rows.withColumn("features", vector_to_array("features"))
        extra = smote(arrays, "features", "label", id_col, minority=1, **oversample)
        first = models.fit(est, rows.select(F.col("label").cast("double").alias("label"), "features").unionByName(
            extra.select(F.col("label").cast("double").alias("label"), array_to_vector("features").alias("features"))
        ))

    reject_woe = credit.woe_transform(rejects, bins, mono, chars)
    reject_scored = materialise(models.score_columns(first, reject_woe, names, xs, "prob_default").select(*xs, "prob_default"))
    labelled = credit.infer_rejects(reject_scored, "prob_default", accept, y, pooled)

    both = split.where(F.col("split").isin("train", "valid")).select(y, *xs).unionByName(labelled.select(y, *xs))  # of two written tables
    more, _ = credit.split_kinds(both, chars)  # what takes many values in a part does so in the whole
    mono, chars = [x for x in xs if x in (*mono, *more)], [x for x in xs if x not in (*mono, *more)]
    final_bins = credit.bin_all(both, y, xs, (mono, chars))
    names = ["new_" + x for x in [*mono, *chars]]
    final = models.fit_counted(est, credit.woe_transform(both, final_bins, mono, chars), names, y)
    coefs = models.coefficients(final, [*mono, *chars], accepts.sparkSession)
    card = credit.scorecard(final_bins, coefs, float(final.intercept), len(mono) + len(chars))
    test = split.where(F.col("split") == "test")
    points = credit.score_applicants(test, card, mono, chars)
    out = models.score_columns(final, credit.woe_transform(points, final_bins, mono, chars), names, [id_col, y, "score"])
    out = out.select(id_col, y, "prob", "predicted", "score")
    return Scorecard(final_bins, credit.iv_table(final_bins), card, final, mono, chars), out
