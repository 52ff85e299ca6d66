"""Web analytics: country sources to staging, staging to warehouse, both as rolling reloads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abacist.functions.scalars import as_col, case_map
from abacist.sources.reload import in_window, reload_window
from abacist.sources.tables import append_rows, check_rows, ensure_table

COUNTS = ["bounces", "pageviews", "uniquevisitors", "visits"]
SOURCE_MEASURES = [f"cm1006_{i}" for i in range(1, 22)]

# Warehouse names of the measures, by position
WAREHOUSE_MEASURES = [
    "Qualified_Visits",
    "KBA",
    "Lead",
    "K_Configurator_Engagement",
    "K_Vehicle_Brochure_Download",
    "K_Offer_Engagement",
    "K_Compare_tool_Interactions",
    "K_Dealer_Search",
    "Configurator_Completion",
    "K_Dealer_Contact",
    "K_Click_to_Dealer_Website",
    "L_Contact_Dealer",
    "L_Test_Drive_Request",
    "L_Book_a_Service",
    "L_Reserve_Online",
    "L_Request_a_Brochure",
    "L_Request_a_Quote",
    "L_Keep_Me_Informed",
    "L_Request_a_Call_Back",
    "L_Offer_Details_Request",
    "L_Video_Call_Request",
]

STAGING_SCHEMA = T.StructType(
    [T.StructField("date", T.DateType()), T.StructField("country", T.StringType()), T.StructField("trackingcode", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in COUNTS + SOURCE_MEASURES]
)
WAREHOUSE_SCHEMA = T.StructType(
    [T.StructField("date", T.DateType()), T.StructField("country", T.StringType()), T.StructField("trackingcode", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in ["uniquevisitors", "bounces", "pageviews", "visits"] + WAREHOUSE_MEASURES]
    + [T.StructField("channel_type", T.StringType())]
)


def channel(code: str | Column) -> Column:
    """Marketing channel from the start of a tracking code; the underscore is literal."""
    c = as_col(code)
    return case_map(
        [
            (c.startswith("ban_"), "display"),
            (c.startswith("SM_") | c.startswith("sm_"), "social"),
            (c.startswith("PS_") | c.startswith("ps_"), "marin"),
        ],
        "other",
    )


def rollup(staging: DataFrame) -> DataFrame:
    """Sums per date, country and tracking code as written; the country is shown in upper case after
    grouping, so 'de' and 'DE' stay two rows."""
    pairs = list(zip(SOURCE_MEASURES, WAREHOUSE_MEASURES))
    have = set(staging.columns)
    sums = [F.sum(c).alias(c) for c in ["uniquevisitors", "bounces", "pageviews", "visits"]]
    sums += [F.sum(s).alias(w) for s, w in pairs if s in have]
    return (
        staging.groupBy("date", "country", "trackingcode").agg(*sums)
        .withColumn("channel_type", channel("trackingcode"))
        .withColumn("country", F.upper("country"))
    )


def stage_rows(source: DataFrame, country: str, as_of: date, days: int = 2) -> DataFrame:
    """Distinct rows of one country's source for the window."""
    return in_window(source, "date", as_of, days).withColumn("country", F.lit(country)).distinct()


def run_staging(
    spark: SparkSession, template: str, countries: Sequence[str], staging: str, as_of: date, days: int = 2,
    path: str | None = None,
) -> None:
    """Reload the window of every country's partition of the staging table in one job.

    All countries are reloaded together, which is the same as one scoped reload per country: each
    (date, country) partition of the window ends with exactly that country's source rows.
    """
    ensure_table(spark, staging, STAGING_SCHEMA, ["date", "country"], path)
    rows = append_rows(*[stage_rows(spark.table(template.format(tag=c)), c, as_of, days) for c in countries], allow_missing=True)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in STAGING_SCHEMA if f.name not in rows.columns}
    reload_window(rows.withColumns(missing), staging, "date", as_of, days, among={"country": list(countries)})


def run_warehouse(
    spark: SparkSession, staging: str, warehouse: str, as_of: date, days: int = 2, path: str | None = None
) -> None:
    """Gate on yesterday's rows, then reload the window of the warehouse table from staging."""
    check_rows(spark.table(staging), "date", as_of - timedelta(days=1))
    ensure_table(spark, warehouse, WAREHOUSE_SCHEMA, ["date"], path)
    reload_window(rollup(in_window(spark.table(staging), "date", as_of, days)), warehouse, "date", as_of, days)
