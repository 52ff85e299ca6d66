"""Catalog tables: discovery, multi-source scans, loads and gates."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class EmptyLoad(RuntimeError):
    """A load gate found no rows for the day it checks."""


def table(spark: SparkSession, name: str, cols: Sequence[str] | None = None) -> DataFrame:
    df = spark.table(name)
    return df.select(*cols) if cols else df


def append_rows(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Rows of several tables under one schema, matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def union_sources(
    spark: SparkSession,
    template: str,
    tags: Iterable[str],
    build: Callable[[DataFrame], DataFrame] = lambda df: df,
    tag_col: str = "market",
) -> DataFrame:
    """The same query over one table per tag, as one plan and one job.

    ``template`` holds ``{tag}``; each branch carries its tag as a literal, so a filter on the tag
    prunes whole branches.
    """
    return append_rows(
        *[build(spark.table(template.format(tag=t))).withColumn(tag_col, F.lit(t)) for t in tags]
    )


def discover(
    spark: SparkSession, must: Sequence[str], must_not: Sequence[str] = (), part: int = 2, start: int = 6,
    database: str | None = None,
) -> DataFrame:
    """Distinct country codes found in the names of the tables that match.

    The code is what follows the first ``start`` characters of the ``part``-th ``_`` piece.
    """
    names = spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES").select("tableName")
    for text in must:
        names = names.where(F.col("tableName").contains(text))
    for text in must_not:
        names = names.where(~F.col("tableName").contains(text))
    piece = F.split("tableName", "_").getItem(part)
    return names.select(F.substring(piece, start + 1, 64).alias("country")).distinct()


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = (), path: str | None = None
) -> None:
    """Create an empty parquet table unless one of that name exists."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{parts}{where}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema, by name, in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def replace_table(df: DataFrame, name: str, schema: T.StructType | None = None, path: str | None = None) -> None:
    """Create or replace a typed table."""
    writer = (conform(df, schema) if schema is not None else df).write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def create_as(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create a table from a query; fails when the table exists."""
    writer = df.write.mode("errorifexists").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def append(df: DataFrame, name: str) -> None:
    """Append by column name in the order of the target; columns the source lacks become null."""
    target = df.sparkSession.table(name).schema
    have = set(df.columns)
    full = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in target if f.name not in have})
    conform(full, target).write.insertInto(name)


def truncate_load(df: DataFrame, name: str) -> None:
    """Replace all rows of an existing table, keeping its schema."""
    conform(df, df.sparkSession.table(name).schema).write.insertInto(name, overwrite=True)


def insert_feedback(batch: DataFrame, supplier: DataFrame, target: str) -> None:
    """Store a batch of (name, grade, comment), with the supplier key looked up by name."""
    append(with_supplier_key(batch, supplier), target)


def with_supplier_key(batch: DataFrame, supplier: DataFrame) -> DataFrame:
    keys = supplier.select("s_suppkey", "s_name")
    return batch.join(keys, batch["name"] == keys["s_name"], "left").select(
        F.col("s_suppkey").cast("string").alias("s_suppkey"), "grade", "comment"
    )


def register(frames: Mapping[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, frames: Mapping[str, DataFrame], **args: object) -> DataFrame:
    """SQL over named frames, with values passed as parameters."""
    register(frames)
    return spark.sql(text, args=args or None)


def check_rows(df: DataFrame, date_col: str, day: date) -> None:
    """Stop the load unless the day has at least one row; reads no more than it must."""
    if df.where(F.col(date_col) == F.lit(day)).isEmpty():
        raise EmptyLoad(f"no rows with {date_col} = {day.isoformat()}")


def uniform_ints(spark: SparkSession, n: int, ranges: Mapping[str, tuple[int, int]], seed: int) -> DataFrame:
    """``n`` rows of independent uniform integers, both ends included."""
    return spark.range(n).select(
        *[
            (F.floor(F.rand(seed + i) * (hi - lo + 1)) + lo).cast("int").alias(name)
            for i, (name, (lo, hi)) in enumerate(ranges.items())
        ]
    )
