"""Gap filling, alignment, moving-average forecasts and period filters for many series at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.functions.scalars import exact_mean
from abacist.operators.ordered import GROUP_LIMIT, Running, hot_groups, position, running

FORECAST_CHUNK = 10_000
"""Forecast steps generated by one task from one starting state."""


def interpolate(
    df: DataFrame, series: str, order: Sequence[str], col: str, limit: int | None = None,
    name: str | None = None, group_limit: int = GROUP_LIMIT, parts: int | None = None,
) -> DataFrame:
    """Linear interpolation by row position.

    Nulls before the first value stay, nulls after the last value take it. With ``limit`` only the
    first ``limit`` rows of a gap are filled.
    """
    hot = hot_groups(df, [series], group_limit)
    how = dict(group_limit=group_limit, parts=parts, hot=hot)
    placed = position(df, [series], order, "__pos", **how)
    known = F.when(F.col(col).isNotNull(), F.struct(F.col("__pos").alias("p"), F.col(col).cast("double").alias("v")))
    both = running(
        placed, [series], order,
        [Running("__before", "last", known), Running("__after", "last", known, backward=True)],
        **how,
    )
    gap = F.col("__pos") - F.col("__before.p")
    step = (F.col("__after.v") - F.col("__before.v")) / (F.col("__after.p") - F.col("__before.p"))
    estimate = F.when(F.col("__after").isNull(), F.col("__before.v")).otherwise(F.col("__before.v") + step * gap)
    reach = F.lit(True) if limit is None else gap <= limit
    value = F.coalesce(F.col(col).cast("double"), F.when(F.col("__before").isNotNull() & reach, estimate))
    return both.withColumn(name or col, value).drop("__pos", "__before", "__after")


def wide_prices(df: DataFrame, series: str, date_col: str, value: str, names: Sequence[str]) -> DataFrame:
    """One column per named series; only dates on which every series has a value."""
    wide = df.where(F.col(series).isin(*names)).groupBy(date_col).pivot(series, list(names)).agg(F.first(value))
    return wide.dropna(subset=list(names))


def ma_forecast(
    df: DataFrame, series: str, order: Sequence[str], col: str, n_train: int, window: int = 102, **how
) -> DataFrame:
    """Forecast every row after the first ``n_train`` of its series from the training rows alone.

    Each forecast is the mean of the ``window`` values before it, earlier forecasts included. Only
    the last ``window`` training values of a series are gathered. The recursion is linear, so the
    state at a later step is a matrix power times the first state: a long horizon is cut into chunks
    that different tasks generate independently.
    """
    if n_train < window:
        raise ValueError("the training part must hold a whole window")
    placed = position(df, [series], order, "__pos", **how)
    start = n_train - window
    seed = placed.where((F.col("__pos") > start) & (F.col("__pos") <= n_train)).groupBy(series).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("__pos", F.col(col).cast("double").alias("v")))), lambda s: s["v"])
        .alias("seed")
    )
    length = placed.groupBy(series).agg((F.count(F.lit(1)) - n_train).alias("horizon"))
    starts = seed.join(length.where(F.col("horizon") > 0), series).select(
        series, "seed", "horizon",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("horizon") - 1) / FORECAST_CHUNK))).alias("chunk"),
    )
    kind = df.schema[series].dataType.simpleString()

    def generate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, seed_values, horizon, chunk in batch.itertuples(index=False):
                state = _advance(np.asarray(seed_values, dtype=float), int(chunk) * FORECAST_CHUNK)
                first = int(chunk) * FORECAST_CHUNK
                steps = min(FORECAST_CHUNK, int(horizon) - first)
                values = np.concatenate([state, np.empty(steps)])
                w = len(state)
                for i in range(steps):
                    values[w + i] = values[i:w + i].sum() / window
                yield pd.DataFrame(
                    {series: key, "__pos": np.arange(steps) + n_train + first + 1, "forecast": values[w:]}
                )

    forecast = starts.repartition(series, "chunk").mapInPandas(
        generate, f"`{series}` {kind}, __pos bigint, forecast double"
    )
    return placed.where(F.col("__pos") > n_train).join(forecast, [series, "__pos"]).drop("__pos")


def _advance(state: np.ndarray, steps: int) -> np.ndarray:
    """State of the moving-average recursion after a number of steps."""
    if steps == 0:
        return state
    w = len(state)
    step = np.zeros((w, w))
    step[np.arange(w - 1), np.arange(1, w)] = 1.0
    step[w - 1, :] = 1.0 / w
    return np.linalg.matrix_power(step, steps) @ state


def rmse(df: DataFrame, by: str, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(by).agg(F.sqrt(F.avg(F.pow(F.col(actual) - F.col(predicted), 2))).alias("rmse"))


def period(df: DataFrame, date_col: str, span: str) -> DataFrame:
    """Rows of the last ``1m``, ``6m``, ``ytd``, ``1y`` or ``all``, counted back from the last date."""
    if span == "all":
        return df
    last = df.agg(F.max(date_col).alias("d"))
    if span == "ytd":
        start = last.select(F.trunc("d", "year")).scalar()
    elif span in ("1m", "6m", "1y"):
        months = {"1m": 1, "6m": 6, "1y": 12}[span]
        start = last.select(F.add_months("d", -months)).scalar()
    else:
        raise ValueError(f"unknown span {span!r}")
    return df.where(F.col(date_col) >= start)


def daily_mean(df: DataFrame, series: str, date_col: str, amount: str, name: str = "close") -> DataFrame:
    """One value per series and day."""
    return df.groupBy(series, F.to_date(date_col).alias("date")).agg(exact_mean(amount).alias(name))

