"""Registry of the queries over the driver's tables and of the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; ``oracle`` is the equivalent SQL, left out where SQL cannot say it."""

    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return keep


def load(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def sum_sql(col: str) -> str:
    """Exact sum of the numbers as printed; by way of text, as the casts between double and decimal round."""
    return f"CAST(CAST(SUM(CAST(CAST({col} AS VARCHAR) AS DECIMAL(38, 18))) AS VARCHAR) AS DOUBLE)"


def mean_sql(col: str) -> str:
    return f"({sum_sql(col)}) / NULLIF(COUNT({col}), 0)"
