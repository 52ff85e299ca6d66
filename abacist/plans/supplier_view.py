"""Supplier information, year-over-year revenue and feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abacist.operators.aggregates import yoy
from abacist.operators.relational import year_range
from abacist.sources.tables import ensure_table, insert_feedback

GRADES_SCHEMA = T.StructType([
    T.StructField("s_suppkey", T.StringType()),
    T.StructField("grade", T.IntegerType()),
    T.StructField("comment", T.StringType()),
])


def supplier_info(supplier: DataFrame, name: str | None = None) -> DataFrame:
    picked = supplier.where(F.col("s_name") == F.lit(name)) if name else supplier
    return picked.withColumnsRenamed({
        "s_suppkey": "supplier_key", "s_name": "supplier_name", "s_nationkey": "nation_key", "s_acctbal": "account_balance",
    })


def supplier_yoy(
    supplier: DataFrame, lineitem: DataFrame, name: str | None = None, years: tuple[int, int] | None = None
) -> DataFrame:
    """Yearly revenue, previous year's revenue and growth of every supplier, or of one by name.

    Line items are reduced to one row per supplier and year before the name is joined on. Years
    outside the range are cut after the growth is known, so its first year still has one.
    """
    items = lineitem.select("l_suppkey", "l_shipdate", "l_extendedprice")
    if name:
        keys = supplier.where(F.col("s_name") == F.lit(name)).select(F.col("s_suppkey").alias("l_suppkey"))
        items = items.join(keys, "l_suppkey", "left_semi")
    growth = yoy(items, ["l_suppkey"], "l_shipdate", "l_extendedprice")
    if years:
        if years[0] > years[1]:
            raise ValueError("the start year is after the end year")
        growth = growth.where(F.col("year").between(*years))
    names = supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return growth.join(names, "l_suppkey").select(
        F.col("l_suppkey").alias("s_suppkey"), "s_name", "year", "revenue", "previous_revenue", "yoy_growth"
    )


def items_of_years(lineitem: DataFrame, start: int, end: int) -> DataFrame:
    """Line items shipped in the years; the bounds are dates, so the scan can skip row groups."""
    return year_range(lineitem, "l_shipdate", start, end)


def record_feedback(batch: DataFrame, supplier: DataFrame, target: str, path: str | None = None) -> None:
    ensure_table(batch.sparkSession, target, GRADES_SCHEMA, path=path)
    insert_feedback(batch, supplier, target)
