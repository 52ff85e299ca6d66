"""Rolling-window reload: replace the last days of a dated table, leave the rest alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.session import materialise
from abacist.sources.tables import conform

# Fixed value: the catalog's name of a null partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def window_of(as_of: date, days: int) -> tuple[date, date]:
    """First and last day of the window; both are included."""
    return as_of - timedelta(days=days), as_of


def in_window(df: DataFrame, date_col: str, as_of: date, days: int) -> DataFrame:
    first, last = window_of(as_of, days)
    return df.where(F.col(date_col).between(F.lit(first), F.lit(last)))


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """Overwrite replaces only the partitions that get rows, for the duration of one insert."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def replace_partitions(rows: DataFrame, target: str) -> None:
    """Replace the partitions that the rows belong to; the rows are in the target's column order.

    Rebalancing gathers each partition's rows into few files and splits a partition that is too large
    for one task.
    """
    spark = rows.sparkSession
    part_cols = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
    with _dynamic_overwrite(spark):
        conform(rows, spark.table(target).schema).hint("rebalance", *part_cols).write.insertInto(target, overwrite=True)


def reload_window(
    source: DataFrame,
    target: str,
    date_col: str,
    as_of: date,
    days: int = 2,
    among: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Make the target hold exactly the source's rows for the window (and the scope).

    ``among`` limits the reload to the listed values of further partition columns, such as one
    country. The target is partitioned by the date and by those columns. Only
    partitions of the window are written: each is replaced when the job commits, so running it again,
    or after a lost executor, gives the same table. Partitions of the window that the source no
    longer fills are dropped, because an overwrite keeps partitions it gets no rows for.
    """
    spark = source.sparkSession
    scope = {name: [str(v) for v in values] for name, values in (among or {}).items()}
    schema = spark.table(target).schema
    rows = in_window(source, date_col, as_of, days)
    for name, values in scope.items():
        rows = rows.where(F.col(name).isin(values))
    rows = materialise(conform(rows, schema))
    part_cols = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
    first, last = window_of(as_of, days)

    replace_partitions(rows, target)

    filled = {
        tuple(None if v is None else str(v) for v in r)
        for r in rows.select(*part_cols).distinct().collect()
    }
    for key in [r[0] for r in spark.sql(f"SHOW PARTITIONS {target}").collect()]:
        values = partition_values(key)
        in_scope = all(values.get(n) in listed for n, listed in scope.items())
        if first.isoformat() <= (values[date_col] or "") <= last.isoformat() and in_scope:
            if tuple(values[c] for c in part_cols) not in filled:
                spec = ", ".join(f"`{c}`={sql_text(values[c])}" for c in part_cols)
                spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({spec})")


def partition_values(name: str) -> dict[str, str | None]:
    """Values of a partition as the catalog lists it: escaped signs and the mark for null are undone."""
    pieces = (piece.split("=", 1) for piece in name.split("/"))
    return {unquote(c): None if v == NULL_PARTITION else unquote(v) for c, v in pieces}


def sql_text(value: str | None) -> str:
    if value is None:
        return "NULL"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
