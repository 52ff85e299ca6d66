"""File scans and exports with declared schemas and one missing-value rule per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abacist.functions.scalars import two_digit_date


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",", null: str = "NA"
) -> DataFrame:
    """Delimited file with a header line. Give a schema at scale: inference reads the data twice."""
    reader = spark.read.option("header", True).option("sep", sep).option("nullValue", null)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; pass ``schema`` to skip the inference pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_document(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that each hold one JSON document over many lines."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Delivered ad report: header line, commas inside quotes allowed."""
    return read_csv(spark, path, schema, null="")


BANK_SCHEMAS = {
    "account": "account_id int, district_id int, frequency string, date string",
    "card": "card_id int, disp_id int, type string, issued string",
    "client": "client_id int, birth_number string, district_id int",
    "disp": "disp_id int, client_id int, account_id int, type string",
    "district": (
        "A1 int, A2 string, A3 string, A4 int, A5 int, A6 int, A7 int, A8 int, A9 int, A10 double, "
        "A11 int, A12 double, A13 double, A14 int, A15 int, A16 int"
    ),
    "loan": "loan_id int, account_id int, date string, amount int, duration int, payments double, status string",
    "order": (
        "order_id int, account_id int, bank_to string, account_to string, amount double, k_symbol string"
    ),
}
"""Column layout of the bank files."""


def read_bank(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Bank file: ``;`` separated, quoted texts, ``?`` for missing, two-digit years of the 1900s."""
    df = read_csv(spark, f"{folder}/{table}.asc", BANK_SCHEMAS[table], sep=";", null="?")
    if "date" in df.columns:
        df = df.withColumn("date", two_digit_date("date"))
    if table == "card":
        stamp = F.concat(F.lit("19"), F.col("issued"))
        df = df.withColumn("issued", F.to_timestamp(stamp, "yyyyMMdd HH:mm:ss"))
    if table == "client":
        df = df.withColumns(birth_number_parts("birth_number"))
    return df


def birth_number_parts(name: str) -> dict[str, Column]:
    """Birth numbers write women's months plus fifty; split into a date and a gender."""
    text = F.lpad(F.col(name), 6, "0")
    month = F.substring(text, 3, 2).cast("int")
    plain = F.when(month > 50, month - 50).otherwise(month)
    year = F.lit(1900) + F.substring(text, 1, 2).cast("int")
    return {
        "birth_date": F.make_date(year, plain, F.substring(text, 5, 2).cast("int")),
        "gender": F.when(month > 50, "Female").otherwise("Male"),
    }


def export_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with header. ``single`` writes one file through one task: for small results only."""
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").option("header", True).csv(path)
