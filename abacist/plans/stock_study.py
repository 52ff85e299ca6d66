"""Price study: missing values, filled and aligned series, forecasts and their errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from abacist.operators.aggregates import null_profile
from abacist.operators.ordered import fill
from abacist.operators.timeseries import interpolate, ma_forecast, period, rmse, wide_prices


def run_stock_study(
    prices: DataFrame, series: str, date_col: str, close: str, names: Sequence[str], n_train: int, window: int = 102,
    span: str = "1y",
) -> dict[str, DataFrame]:
    filled = interpolate(prices, series, [date_col], close)
    forecast = ma_forecast(filled, series, [date_col], close, n_train, window)
    return {
        "missing": null_profile(prices),
        "interpolated": filled,
        "carried": fill(prices, [series], [date_col], close),
        "wide": wide_prices(filled, series, date_col, close, names),
        "recent": period(filled, date_col, span),
        "forecast": forecast,
        "errors": rmse(forecast, series, close, "forecast"),
    }
