"""Supplier view: information, yearly growth, feedback."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from abacist.functions.scalars import exact_sum
from abacist.plans import supplier_view
from abacist.queries.registry import load, query, sum_sql
from abacist.session import shared_dir

YOY_SQL = f"""
WITH y AS (
  SELECT l_suppkey, CAST(year(l_shipdate) AS BIGINT) AS year, {sum_sql('l_extendedprice')} AS revenue
  FROM lineitem GROUP BY 1, 2
), g AS (
  SELECT *, LAG(revenue) OVER (PARTITION BY l_suppkey ORDER BY year) AS previous_revenue FROM y
)
SELECT l_suppkey AS s_suppkey, s_name, year, revenue, previous_revenue,
       (revenue - previous_revenue) / NULLIF(previous_revenue, 0) AS yoy_growth
FROM g JOIN supplier ON s_suppkey = l_suppkey
"""


@query("supplier_yoy", YOY_SQL)
def supplier_yoy(spark, sf):
    return supplier_view.supplier_yoy(load(spark, sf, "supplier"), load(spark, sf, "lineitem"))


@query("supplier_yoy_years", f"SELECT * FROM ({YOY_SQL}) WHERE year BETWEEN 1997 AND 1999")
def supplier_yoy_years(spark, sf):
    return supplier_view.supplier_yoy(load(spark, sf, "supplier"), load(spark, sf, "lineitem"), years=(1997, 1999))


@query("supplier_yoy_by_name", f"SELECT * FROM ({YOY_SQL}) WHERE s_name = 'Supplier#000000003'")
def supplier_yoy_by_name(spark, sf):
    return supplier_view.supplier_yoy(
        load(spark, sf, "supplier"), load(spark, sf, "lineitem"), name="Supplier#000000003"
    )


@query(
    "items_of_years",
    f"""SELECT l_suppkey, COUNT(*) AS items, {sum_sql('l_extendedprice')} AS revenue FROM lineitem
    WHERE year(l_shipdate) BETWEEN 1996 AND 1998 GROUP BY 1""",
)
def items_of_years(spark, sf):
    items = supplier_view.items_of_years(load(spark, sf, "lineitem"), 1996, 1998)
    return items.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("items"), exact_sum("l_extendedprice").alias("revenue")
    )


@query(
    "supplier_info",
    """SELECT s_suppkey AS supplier_key, s_name AS supplier_name, s_nationkey AS nation_key,
    s_acctbal AS account_balance FROM supplier""",
)
def supplier_info(spark, sf):
    return supplier_view.supplier_info(load(spark, sf, "supplier"))


@query(
    "supplier_feedback",
    """SELECT CAST(s.s_suppkey AS VARCHAR) AS s_suppkey,
       CAST(CASE WHEN o.n > 600 THEN 5 ELSE 3 END AS INTEGER) AS grade, 'shipped ' || o.n AS comment
    FROM (SELECT l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY 1) o
    JOIN supplier b ON b.s_suppkey = o.l_suppkey JOIN supplier s ON s.s_name = b.s_name""",
)
def supplier_feedback(spark, sf):
    """A batch of grades, one per supplier name, stored with the key looked up by name."""
    supplier = load(spark, sf, "supplier")
    shipped = load(spark, sf, "lineitem", "l_suppkey").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    batch = shipped.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_name").alias("name"),
        F.when(F.col("n") > 600, 5).otherwise(3).alias("grade"),
        F.concat(F.lit("shipped "), F.col("n").cast("string")).alias("comment"),
    )
    run = uuid.uuid4().hex
    target = f"supplier_grades_{run}"
    supplier_view.record_feedback(batch, supplier, target, path=f"{shared_dir(spark)}/{target}")
    return spark.table(target)
