"""Daily mean order price per priority as five series; weekends are made missing."""

from __future__ import annotations

from pyspark.sql import functions as F

from abacist.operators import ordered as W
from abacist.operators import timeseries as T
from abacist.plans.stock_study import run_stock_study
from abacist.queries.registry import load, mean_sql, query

SERIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
N_TRAIN = 200

DAILY_SQL = f"""daily AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date, {mean_sql('o_totalprice')} AS full_close
    FROM orders GROUP BY 1, 2),
  holed AS (SELECT series, date, CASE WHEN dayofweek(date) IN (0, 6) THEN NULL ELSE full_close END AS close, full_close,
    ROW_NUMBER() OVER (PARTITION BY series ORDER BY date) AS pos FROM daily)"""


def _daily(spark, sf):
    return T.daily_mean(load(spark, sf, "orders"), "o_orderpriority", "o_orderdate", "o_totalprice").withColumnRenamed(
        "o_orderpriority", "series"
    )


def _holed(spark, sf):
    weekend = F.dayofweek("date").isin(1, 7)
    return _daily(spark, sf).withColumn("close", F.when(~weekend, F.col("close")))


def _interpolate_sql(limit=None):
    reach = "" if limit is None else f"AND pos - bp <= {limit}"
    return f"""WITH {DAILY_SQL},
  near AS (SELECT *, MAX(CASE WHEN close IS NOT NULL THEN pos END) OVER (PARTITION BY series ORDER BY pos) AS bp,
    MIN(CASE WHEN close IS NOT NULL THEN pos END) OVER (PARTITION BY series ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ap FROM holed)
  SELECT n.series, n.date, ROUND(CASE WHEN n.close IS NOT NULL THEN n.close WHEN n.bp IS NULL THEN NULL
    WHEN TRUE {reach.replace('pos', 'n.pos').replace('bp', 'n.bp')} THEN CASE WHEN n.ap IS NULL THEN b.close
      ELSE b.close + (a.close - b.close) / (n.ap - n.bp) * (n.pos - n.bp) END END, 6) AS close
  FROM near n LEFT JOIN holed b ON b.series = n.series AND b.pos = n.bp LEFT JOIN holed a ON a.series = n.series AND a.pos = n.ap"""


@query("interpolate", _interpolate_sql())
def interpolate(spark, sf):
    return T.interpolate(_holed(spark, sf), "series", ["date"], "close").withColumn("close", F.round("close", 6))


@query("interpolate_limit", _interpolate_sql(1))
def interpolate_limit(spark, sf):
    """At most one row per gap; the series are forced through range-partitioned blocks."""
    filled = T.interpolate(_holed(spark, sf), "series", ["date"], "close", limit=1, group_limit=500, parts=8)
    return filled.withColumn("close", F.round("close", 6))


@query(
    "ffill_bfill",
    f"""WITH {DAILY_SQL} SELECT series, date, LAST_VALUE(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY date ROWS UNBOUNDED PRECEDING) AS forward,
    FIRST_VALUE(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS backward FROM holed""",
)
def ffill_bfill(spark, sf):
    ahead = W.fill(_holed(spark, sf), ["series"], ["date"], "close", "forward", "forward")
    return W.fill(ahead, ["series"], ["date"], "close", "backward", "backward").drop("close")


@query(
    "wide_prices",
    f"""WITH {DAILY_SQL} SELECT date, {', '.join(f"MAX(CASE WHEN series = '{s}' THEN close END) AS {chr(34)}{s}{chr(34)}" for s in SERIES)}
    FROM holed GROUP BY date HAVING COUNT(close) = 5""",
)
def wide_prices(spark, sf):
    return T.wide_prices(_holed(spark, sf), "series", "date", "close", SERIES)


FORECAST_SQL = f"""WITH RECURSIVE {DAILY_SQL},
  seed AS (SELECT series, list(full_close ORDER BY pos) AS w FROM holed WHERE pos > {N_TRAIN} - 102 AND pos <= {N_TRAIN} GROUP BY 1),
  horizon AS (SELECT series, MAX(pos) AS last FROM holed GROUP BY 1),
  r AS (SELECT s.series, CAST({N_TRAIN} AS BIGINT) AS pos, w, CAST(NULL AS DOUBLE) AS f, last FROM seed s JOIN horizon USING (series)
    UNION ALL SELECT series, pos + 1, list_append(w[2:], list_sum(w) / 102), list_sum(w) / 102, last FROM r WHERE pos < last)
"""


@query(
    "ma_forecast",
    FORECAST_SQL + "SELECT h.series, h.date, h.full_close AS close, ROUND(r.f, 4) AS forecast FROM r JOIN holed h ON h.series = r.series AND h.pos = r.pos WHERE r.f IS NOT NULL",
)
def ma_forecast(spark, sf):
    return T.ma_forecast(_daily(spark, sf), "series", ["date"], "close", N_TRAIN).withColumn("forecast", F.round("forecast", 4))


@query(
    "forecast_rmse",
    FORECAST_SQL + """SELECT h.series, ROUND(sqrt(AVG((h.full_close - r.f) * (h.full_close - r.f))), 4) AS rmse
    FROM r JOIN holed h ON h.series = r.series AND h.pos = r.pos WHERE r.f IS NOT NULL GROUP BY 1""",
)
def forecast_rmse(spark, sf):
    forecast = T.ma_forecast(_daily(spark, sf), "series", ["date"], "close", N_TRAIN)
    return T.rmse(forecast, "series", "close", "forecast").withColumn("rmse", F.round("rmse", 4))


FILLED_SQL = _interpolate_sql().replace(f"WITH {DAILY_SQL},", "").replace("SELECT n.series, n.date, ROUND(", "SELECT n.series, n.pos, (", 1)
FILLED_SQL = FILLED_SQL.replace(" END, 6) AS close", " END) AS close", 1)
NEAR_SQL, FILL_SQL = FILLED_SQL.split("FROM holed)", 1)


@query(
    "stock_study",
    f"""WITH RECURSIVE {DAILY_SQL}, {NEAR_SQL} FROM holed), filled AS ({FILL_SQL}),
  seed AS (SELECT series, list(close ORDER BY pos) AS w FROM filled WHERE pos > {N_TRAIN} - 102 AND pos <= {N_TRAIN} GROUP BY 1),
  horizon AS (SELECT series, MAX(pos) AS last FROM filled GROUP BY 1),
  r AS (SELECT s.series, CAST({N_TRAIN} AS BIGINT) AS pos, w, CAST(NULL AS DOUBLE) AS f, last FROM seed s JOIN horizon USING (series)
    UNION ALL SELECT series, pos + 1, list_append(w[2:], list_sum(w) / 102), list_sum(w) / 102, last FROM r WHERE pos < last)
  SELECT h.series, ROUND(sqrt(AVG((h.close - r.f) * (h.close - r.f))), 4) AS rmse
  FROM r JOIN filled h ON h.series = r.series AND h.pos = r.pos WHERE r.f IS NOT NULL GROUP BY 1""",
)
def stock_study(spark, sf):
    """Forecast errors of the interpolated series, from the whole study."""
    errors = run_stock_study(_holed(spark, sf), "series", "date", "close", SERIES, N_TRAIN)["errors"]
    return errors.withColumn("rmse", F.round("rmse", 4))


@query("interpolate_limit_two", _interpolate_sql(2))
def interpolate_limit_two(spark, sf):
    """At most two rows per gap: both days of a weekend."""
    return T.interpolate(_holed(spark, sf), "series", ["date"], "close", limit=2).withColumn("close", F.round("close", 6))
