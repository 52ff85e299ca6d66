"""Web analytics report payload to a dated table, and the list of report suites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from abacist.sources.files import read_document
from abacist.sources.nested import REPORT_SCHEMA, REQUEST_SCHEMA, flatten_objects, flatten_report, metric_names


def run_web_report(spark: SparkSession, report_path: str, request_path: str) -> DataFrame:
    """itemId, Date and one column per requested metric.

    The request is one small document that names the columns to make, so its pairs are read first.
    """
    pairs = metric_names(read_document(spark, request_path, REQUEST_SCHEMA)).collect()
    report = read_document(spark, report_path, REPORT_SCHEMA)
    return flatten_report(report, [(r["columnId"], r["id"]) for r in pairs])


def report_suites(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    schema = "content array<struct<" + ", ".join(f"{k}: string" for k in keys) + ">>"
    return flatten_objects(read_document(spark, path, schema), "content", keys)
