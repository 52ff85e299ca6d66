"""Delivered ad report: scan, clean, load, typed copy, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.functions.scalars import iso_date, strip_quotes, try_cast
from abacist.operators.relational import clean_names
from abacist.sources.files import export_csv, read_report
from abacist.sources.tables import replace_table

TEXTS = [
    "Day", "Seat name", "Country name", "Campaign name", "Line item name",
    "Creative external integration code", "Budget spent currency",
]
COUNTS = [
    "Video first quartile", "Video third quartile", "Video midpoint", "Video starts", "Video completes",
    "Clicks", "Impressions",
]
RAW_SCHEMA = ", ".join(f"`{c}` string" for c in [*TEXTS, "Budget spent", *COUNTS])

OUTPUT = [
    "Date", "Seat_name", "Country_name", "Campaign_name", "Line_item_name", "Creative_external_integration_code",
    "Budget_spent_currency", "Budget_spent", "Video_first_quartile", "Video_third_quartile", "Video_midpoint",
    "Video_starts", "Video_completes", "Clicks", "Impressions",
]


def clean_report(raw: DataFrame) -> DataFrame:
    """Missing counts to 0, quotes off texts, rows without a day dropped, day to a date, names joined by _."""
    number = lambda c, t, zero: F.coalesce(try_cast(f"`{c}`", t), F.lit(zero).cast(t))
    typed = raw.withColumns({
        **{c: number(c, "long", 0) for c in COUNTS if c in raw.columns},
        **{c: number(c, "double", 0.0) for c in ["Budget spent"] if c in raw.columns},
        **{c: F.coalesce(strip_quotes(F.col(f"`{c}`")), F.lit("")) for c in TEXTS if c in raw.columns},
    })
    dated = typed.where(F.col("Day") != "").withColumnRenamed("Day", "Date").withColumn("Date", iso_date("Date"))
    return clean_names(dated)


def run_report_ingest(
    spark: SparkSession, path: str, table: str, export_path: str | None = None, table_path: str | None = None
) -> DataFrame:
    """Load a delivered report into a typed table, replacing it."""
    raw = read_report(spark, path, RAW_SCHEMA)
    replace_table(clean_report(raw).select(*OUTPUT), table, path=table_path)
    if export_path:
        export_csv(raw, export_path)
    return spark.table(table)
