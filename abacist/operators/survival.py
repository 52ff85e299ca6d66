"""Survival analysis on event tables: raw rows are reduced to one row per distinct time first."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abacist.operators.aggregates import max_all
from abacist.operators.ordered import Running, running
from abacist.operators.quantiles import exact_quantiles
from abacist.session import materialise

TIES_CHUNK = 100_000
"""Tied events whose terms are added up in one row."""


def episodic_to_static(df: DataFrame, id_col: str) -> DataFrame:
    """One row per id with the largest value of every column."""
    return max_all(df, id_col)


def event_table(df: DataFrame, time: str, event: str, group: str | None = None, **how) -> DataFrame:
    """Per distinct time: removed, observed, censored and at risk."""
    by = [group] if group else []
    tallies = materialise(
        df.groupBy(*by, F.col(time).alias("time")).agg(
            F.count(F.lit(1)).alias("removed"), F.sum(F.col(event).cast("long")).alias("observed")
        )
    ).withColumn("censored", F.col("removed") - F.col("observed"))
    return running(tallies, by, ["time"], [Running("at_risk", "sum", F.col("removed"), backward=True)], **how)


def kaplan_meier(df: DataFrame, time: str, event: str, group: str | None = None, **how) -> DataFrame:
    """Survival probability after each distinct time."""
    by = [group] if group else []
    table = event_table(df, time, event, group, **how)
    hazard = F.lit(1.0) - F.col("observed") / F.col("at_risk")
    return running(table, by, ["time"], [Running("survival", "product", hazard)], **how)


def cumulative_density(km: DataFrame) -> DataFrame:
    return km.withColumn("cumulative_density", F.lit(1.0) - F.col("survival"))


def median_event_time(df: DataFrame, time: str, event: str) -> float | None:
    """Exact median time among the rows with the event."""
    return exact_quantiles(df.where(F.col(event) == 1), [time], [0.5])[time][0]


def survival_at(km: DataFrame, times: Sequence[float], group: str | None = None) -> DataFrame:
    """Survival at given times: the last step not after the time, 1 before the first step."""
    by = [group] if group else []
    wide = km.groupBy(*by).agg(
        *[
            F.coalesce(F.max_by("survival", F.when(F.col("time") <= t, F.col("time"))), F.lit(1.0)).alias(f"t{i}")
            for i, t in enumerate(times)
        ]
    )
    rows = F.array(*[F.struct(F.lit(t).alias("time"), F.col(f"t{i}").alias("survival")) for i, t in enumerate(times)])
    return wide.select(*by, F.inline(rows))


def split_by_quantile(df: DataFrame, col: str, p: float, name: str = "group") -> DataFrame:
    """1 above the exact quantile of the column, else 0."""
    cut = exact_quantiles(df, [col], [p])[col][0]
    return df.withColumn(name, (F.col(col) > F.lit(cut)).cast("int"))


@F.pandas_udf(T.DoubleType())
def _chi_square_tail(x: pd.Series) -> pd.Series:
    """Upper tail of chi-square with one degree of freedom; used on one-row results."""
    return x.map(lambda v: math.erfc(math.sqrt(max(v, 0.0) / 2.0)) if v == v else v)


def logrank(df: DataFrame, time: str, event: str, group: str, first: object, **how) -> DataFrame:
    """Log-rank test of the rows in group ``first`` against all other rows."""
    mine = F.col(group).eqNullSafe(F.lit(first))
    e = F.col(event).cast("long")
    tallies = materialise(
        df.groupBy(F.col(time).alias("time")).agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(mine).alias("n1"),
            F.sum(e).alias("d"),
            F.coalesce(F.sum(F.when(mine, e)), F.lit(0)).alias("d1"),
        )
    )
    risk = running(
        tallies, [], ["time"],
        [Running("r", "sum", F.col("n"), backward=True), Running("r1", "sum", F.col("n1"), backward=True)],
        **how,
    )
    share = F.col("r1") / F.col("r")
    variance = F.when(
        F.col("r") > 1, F.col("d") * share * (1 - share) * (F.col("r") - F.col("d")) / (F.col("r") - 1)
    ).otherwise(0.0)
    sums = risk.agg(
        F.sum("d1").cast("double").alias("observed"),
        F.sum(F.col("d") * share).alias("expected"),
        F.sum(variance).alias("variance"),
    )
    stat = F.try_divide(F.pow(F.col("observed") - F.col("expected"), 2), F.col("variance"))
    return sums.withColumn("test_statistic", stat).withColumn("p_value", _chi_square_tail("test_statistic"))


def cox_tv(
    df: DataFrame, start: str, stop: str, event: str, covariates: Sequence[str],
    max_iter: int = 25, tol: float = 1e-7, **how,
) -> DataFrame:
    """Cox model with time-varying covariates and Efron ties: coef, se, z and p per covariate.

    A row is at risk after its start and up to its stop. Each Newton step is one distributed job:
    rows are reduced to sums per distinct time, risk-set sums follow by running from the last time
    backwards, and only the gradient and the information matrix reach the driver. The rows are written
    once, spread evenly over the cores, with covariates centred on their means; that leaves the
    coefficients as they are and keeps the exponentials small.
    """
    p = len(covariates)
    means = df.agg(*[F.avg(c).alias(c) for c in covariates]).first()
    data = materialise(
        df.select(
            F.col(start).cast("double").alias("__start"),
            F.col(stop).cast("double").alias("__stop"),
            F.col(event).cast("int").alias("__event"),
            *[(F.col(c).cast("double") - F.lit(means[c])).alias(f"x{i}") for i, c in enumerate(covariates)],
        ).repartition(df.sparkSession.sparkContext.defaultParallelism)
    )
    beta = np.zeros(p)
    previous = -math.inf
    for _ in range(max_iter):
        loglik, gradient, information = _cox_step(data, beta, p, how)
        if abs(loglik - previous) < tol * (abs(loglik) + tol):
            break
        previous = loglik
        beta = beta + np.linalg.solve(information, gradient)
    se = np.sqrt(np.diag(np.linalg.inv(information)))
    z = beta / se
    rows = [
        (c, float(b), float(math.exp(b)), float(s), float(v), float(math.erfc(abs(v) / math.sqrt(2))))
        for c, b, s, v in zip(covariates, beta, se, z)
    ]
    return df.sparkSession.createDataFrame(
        rows, "covariate string, coef double, exp_coef double, se double, z double, p double"
    )


def _cox_step(data: DataFrame, beta: np.ndarray, p: int, how: dict) -> tuple[float, np.ndarray, np.ndarray]:
    x = [F.col(f"x{i}") for i in range(p)]
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    eta: Column = F.lit(0.0)
    for i in range(p):
        eta = eta + F.lit(float(beta[i])) * x[i]
    weighted = data.withColumn("__eta", eta).withColumn("__w", F.exp("__eta"))
    moments = {"s": F.col("__w")}
    moments |= {f"s{i}": F.col("__w") * x[i] for i in range(p)}
    moments |= {f"s{i}_{j}": F.col("__w") * x[i] * x[j] for i, j in pairs}
    # a row joins the risk set at its stop when walking back in time and leaves it at its start
    edges = weighted.withColumn(
        "__edge",
        F.explode(F.array(
            F.struct(F.col("__stop").alias("time"), F.lit(1).alias("sign")),
            F.struct(F.col("__start").alias("time"), F.lit(-1).alias("sign")),
        )),
    )
    ends = F.col("__edge.sign") == 1
    dies = ends & (F.col("__event") == 1)
    table = materialise(
        edges.groupBy(F.col("__edge.time").alias("time")).agg(
            F.count_if(dies).alias("d"),
            F.coalesce(F.sum(F.when(dies, F.col("__eta"))), F.lit(0.0)).alias("eta"),
            *[F.coalesce(F.sum(F.when(dies, x[i])), F.lit(0.0)).alias(f"x{i}") for i in range(p)],
            *[F.sum(F.when(ends, m).otherwise(F.lit(0.0))).alias(f"in_{n}") for n, m in moments.items()],
            *[F.sum(F.when(ends, F.lit(0.0)).otherwise(m)).alias(f"out_{n}") for n, m in moments.items()],
            *[F.coalesce(F.sum(F.when(dies, m)), F.lit(0.0)).alias(f"d_{n}") for n, m in moments.items()],
        )
    )
    # at time t: everyone who stops at t or later, less those who start at t or later
    specs = [Running(f"r_{n}", "sum", F.col(f"in_{n}") - F.col(f"out_{n}"), backward=True) for n in moments]
    risk = running(table, [], ["time"], specs, **how).where(F.col("d") > 0)
    # Efron: the l-th of d tied events sees the risk set less l/d of the tied rows
    chunks = risk.withColumn(
        "__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("d") - 1, F.lit(TIES_CHUNK).cast("long")))
    ).repartition(data.sparkSession.sparkContext.defaultParallelism, "time", "__from").withColumn(
        "__l",
        F.explode(F.sequence(F.col("__from"), F.least(F.col("__from") + TIES_CHUNK, F.col("d")) - 1)),
    )
    f = F.col("__l") / F.col("d")
    left = {n: F.col(f"r_{n}") - f * F.col(f"d_{n}") for n in moments}
    terms = chunks.select(
        "__l", "eta", *[f"x{i}" for i in range(p)], *[c.alias(n) for n, c in left.items()]
    )
    first = F.col("__l") == 0
    got = terms.agg(
        F.sum(F.when(first, F.col("eta")).otherwise(0.0) - F.ln("s")).alias("loglik"),
        *[
            F.sum(F.when(first, F.col(f"x{i}")).otherwise(0.0) - F.col(f"s{i}") / F.col("s")).alias(f"g{i}")
            for i in range(p)
        ],
        *[
            F.sum(F.col(f"s{i}_{j}") / F.col("s") - F.col(f"s{i}") * F.col(f"s{j}") / F.pow("s", F.lit(2))).alias(f"h{i}_{j}")
            for i, j in pairs
        ],
    ).first()
    gradient = np.array([got[f"g{i}"] for i in range(p)])
    information = np.zeros((p, p))
    for i, j in pairs:
        information[i, j] = information[j, i] = got[f"h{i}_{j}"]
    return got["loglik"], gradient, information
