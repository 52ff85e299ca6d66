"""Nested report payloads to flat tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.functions.scalars import iso_date

REPORT_SCHEMA = (
    "columns struct<columnIds: array<string>>, "
    "rows array<struct<itemId: string, value: string, data: array<double>>>"
)
REQUEST_SCHEMA = "metricContainer struct<metrics: array<struct<columnId: string, id: string>>>"


def metric_names(request: DataFrame) -> DataFrame:
    """(columnId, id) pairs of a report request; a request lists a few dozen metrics."""
    return request.select(F.explode("metricContainer.metrics").alias("m")).select("m.columnId", "m.id")


def flatten_report_long(reports: DataFrame, names: DataFrame) -> DataFrame:
    """One row per report row and metric: itemId, Date, metric, value."""
    rows = reports.select(F.col("columns.columnIds").alias("ids"), F.explode("rows").alias("r"))
    cells = rows.select(
        F.col("r.itemId").alias("itemId"),
        iso_date("r.value").alias("Date"),
        "ids",
        F.posexplode("r.data").alias("pos", "value"),
    ).withColumn("columnId", F.get("ids", F.col("pos")))
    return cells.join(names, "columnId", "inner").select(
        "itemId", "Date", F.col("id").alias("metric"), "value"
    )


def flatten_report(reports: DataFrame, mapping: Sequence[tuple[str, str]]) -> DataFrame:
    """Report rows with one column per metric, named by metric id.

    The mapping from column id to metric id is the request itself, a short list, so each metric is
    read at its place in the row's own array and no shuffle is needed.
    """
    rows = reports.select(F.col("columns.columnIds").alias("ids"), F.explode("rows").alias("r"))
    # array_position is 0 when the report lacks the column: that metric is null
    return rows.select(
        F.col("r.itemId").alias("itemId"),
        iso_date("r.value").alias("Date"),
        *[
            F.get("r.data", (F.array_position("ids", column_id) - 1).cast("int")).alias(metric)
            for column_id, metric in mapping
        ],
    )


def flatten_objects(df: DataFrame, array_col: str, keys: Sequence[str]) -> DataFrame:
    """One row per object of an array, with the named keys as columns."""
    return df.select(F.explode(array_col).alias("o")).select(*[F.col(f"o.{k}").alias(k) for k in keys])
