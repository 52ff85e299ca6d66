"""Evaluation of scores and predictions, all from counts per distinct score or class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacist.functions.scalars import safe_divide
from abacist.operators.ordered import Running, running
from abacist.operators.quantiles import exact_quantiles
from abacist.session import materialise


def score_counts(df: DataFrame, score: str, label: str, digits: int | None = None) -> DataFrame:
    """Positives and negatives per distinct score, optionally of the score rounded to ``digits``."""
    s = F.round(F.col(score), digits) if digits is not None else F.col(score)
    return materialise(
        df.groupBy(s.alias("score")).agg(
            F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
        )
    )


def auc(df: DataFrame, score: str, label: str, digits: int | None = None, **how) -> DataFrame:
    """Areas under the ROC and the precision-recall curve; equal scores share their rank.

    ROC is the share of (positive, negative) pairs in the right order; pairs are counted from running
    totals, never formed. PR follows the trapezoids between distinct scores, from the first precision.
    """
    counts = score_counts(df, score, label, digits)
    ranked = running(
        counts, [], ["score"],
        [
            Running("neg_below", "sum", F.col("neg"), exclusive=True),
            Running("tp", "sum", F.col("pos"), backward=True),
            Running("fp", "sum", F.col("neg"), backward=True),
        ],
        **how,
    )
    total = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    p, n = total.select("p").scalar(), total.select("n").scalar()
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    before_tp, before_fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    # scores above the current one; at the very first point precision equals the current one
    precision_before = F.when(before_tp + before_fp > 0, before_tp / F.greatest(before_tp + before_fp, F.lit(1))).otherwise(precision)
    won = F.col("pos").cast("double") * (F.coalesce("neg_below", F.lit(0)) + F.col("neg") / 2)
    return ranked.agg(
        safe_divide(F.sum(won), F.first(p.cast("double") * n)).alias("auc_roc"),
        safe_divide(F.sum(F.col("pos") * (precision + precision_before) / 2), F.first(p)).alias("auc_pr"),
    )


def roc_points(df: DataFrame, score: str, label: str, digits: int | None = None, **how) -> DataFrame:
    """False and true positive rate at every distinct score used as threshold."""
    counts = score_counts(df, score, label, digits)
    ranked = running(
        counts, [], ["score"],
        [Running("tp", "sum", F.col("pos"), backward=True), Running("fp", "sum", F.col("neg"), backward=True)],
        **how,
    )
    total = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return ranked.select(
        F.col("score").alias("threshold"),
        safe_divide(F.col("fp"), total.select("n").scalar()).alias("fpr"),
        safe_divide(F.col("tp"), total.select("p").scalar()).alias("tpr"),
    )


def accuracy(df: DataFrame, pred: str, label: str) -> DataFrame:
    return df.agg((F.count_if(F.col(pred) == F.col(label)) / F.count(label)).alias("accuracy"))


def class_report(df: DataFrame, pred: str, label: str) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    confusion = df.groupBy(F.col(label).alias("l"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = confusion.select(
        F.explode(F.array(
            F.struct(F.col("l").alias("class"), F.lit(1).alias("actual"), F.lit(0).alias("predicted")),
            F.struct(F.col("p").alias("class"), F.lit(0).alias("actual"), F.lit(1).alias("predicted")),
        )).alias("s"),
        "n", (F.col("l") == F.col("p")).alias("hit"),
    ).select("s.*", "n", "hit")
    per_class = sides.groupBy("class").agg(
        F.sum(F.col("n") * F.col("actual")).alias("support"),
        F.sum(F.col("n") * F.col("predicted")).alias("predicted"),
        F.coalesce(F.sum(F.when(F.col("hit") & (F.col("actual") == 1), F.col("n"))), F.lit(0)).alias("hits"),
    )
    zero = F.lit(0.0)
    return per_class.select(
        "class",
        F.coalesce(safe_divide("hits", "predicted"), zero).alias("precision"),
        F.coalesce(safe_divide("hits", "support"), zero).alias("recall"),
        F.coalesce(safe_divide(F.col("hits") * 2, F.col("support") + F.col("predicted")), zero).alias("f1"),
        "support",
    )


def lift_table(df: DataFrame, score: str, label: str, bins: int = 20) -> DataFrame:
    """Per score bin, best first: rows, targets, response, lift and the running versions of them.

    Cut points are exact quantiles; a score equal to a cut falls in the lower bin. Score and label are
    written once, because a score is often the output of a model and several passes read it. The
    running totals go over ``bins`` rows.
    """
    df = materialise(df.select(score, label))
    cuts = exact_quantiles(df, [score], [i / bins for i in range(1, bins)])[score]
    bucket: Column = F.lit(bins)
    for i, c in enumerate(cuts, start=1):
        bucket = bucket - (F.col(score) > F.lit(c)).cast("int")
    counts = df.where(F.col(score).isNotNull()).groupBy(bucket.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("long")).alias("targets")
    )
    total = counts.agg(F.sum("rows").alias("r"), F.sum("targets").alias("t"))
    rows, targets = total.select("r").scalar(), total.select("t").scalar()
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.withColumns({"cum_rows": F.sum("rows").over(w), "cum_targets": F.sum("targets").over(w)})
    incidence = targets / rows
    return cum.select(
        "bin", "rows", "targets",
        (F.col("targets") / F.col("rows")).alias("response"),
        safe_divide(F.col("targets") / F.col("rows"), incidence).alias("lift"),
        (F.col("cum_rows") / rows).alias("perc_selected"),
        (F.col("cum_targets") / F.col("cum_rows")).alias("cum_response"),
        safe_divide(F.col("cum_targets") / F.col("cum_rows"), incidence).alias("cum_lift"),
        safe_divide(F.col("cum_targets"), targets).alias("cum_gain"),
    )


def campaign_profit(lift: DataFrame, reward: float, cost: float, population: int) -> DataFrame:
    """Profit of selecting the best rows down to each bin."""
    selected = F.col("perc_selected") * population
    return lift.withColumn("profit", reward * F.col("cum_response") * selected - cost * selected)


def reach(lift: DataFrame, targets: Sequence[int], incidence: float, population: int) -> DataFrame:
    """For each wanted number of targets: first bin that reaches it and the rows to select."""
    reached = lift.withColumn("reached", F.col("cum_lift") * incidence * F.col("perc_selected") * population)
    # the wanted numbers are parameters, and the lift table has one row per bin
    return reached.select("bin", "perc_selected", "reached", F.explode(F.array(*[F.lit(t) for t in targets])).alias("wanted")).where(
        F.col("reached") >= F.col("wanted") - F.lit(1e-6)
    ).groupBy("wanted").agg(
        F.min("bin").alias("bin"), (F.min("perc_selected") * population).alias("rows_to_select")
    )


def class_totals(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def incidence(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.round(F.sum(F.col(target).cast("long")) / F.count(target), 3).alias("incidence"))
