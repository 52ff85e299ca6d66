"""Projections, predicates, joins and set operations that need more than one DataFrame call.

Plain select, drop, where, distinct, orderBy, limit and inner/left joins on named keys are the
DataFrame methods themselves and have no wrapper here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.functions.scalars import as_col, exact_sum, total_parts


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.toDF(*[c if c in keep else prefix + c for c in df.columns])


def columns_like(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Columns whose name holds the text, after the ones to keep."""
    return df.select(*keep, *[c for c in df.columns if text in c and c not in keep])


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def take_columns(df: DataFrame, n: int) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns[:n]])


def between_dates(col: str, lo, hi, closed: str = "both") -> Column:
    """Date range; ``left`` leaves out the last day."""
    c = F.col(col)
    if closed == "both":
        return c.between(F.lit(lo), F.lit(hi))
    if closed == "left":
        return (c >= F.lit(lo)) & (c < F.lit(hi))
    raise ValueError(f"unknown closed {closed!r}")


def year_range(df: DataFrame, col: str, start: int, end: int) -> DataFrame:
    """Rows whose date falls in the years from start to end."""
    if start > end:
        raise ValueError("the start year is after the end year")
    return df.where(between_dates(col, F.make_date(F.lit(start), F.lit(1), F.lit(1)),
                                  F.make_date(F.lit(end + 1), F.lit(1), F.lit(1)), closed="left"))


def semi(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows with a partner in the other table (IN and EXISTS); partners do not multiply rows.

    The partners' keys are made distinct first, so a key that fills a third of the other table
    crosses the shuffle once per map task.
    """
    return df.join(other.select(*on.values()).distinct(), _equal(on), "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not listed."""
    return df.join(keys.select(on).distinct(), on, "left_anti")


def less_than_any(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """Rows below at least one value of the other table; none when that table is empty."""
    return df.where(F.col(col) < other.agg(F.max(other_col)).scalar())


def star_left(base: DataFrame, sides: Sequence[DataFrame], on: str) -> DataFrame:
    """Left joins on one key; Spark keeps the key's partitioning through the chain."""
    return reduce(lambda a, b: a.join(b, on, "left"), sides, base)


def flag_member(df: DataFrame, ids: DataFrame, on: str, name: str) -> DataFrame:
    """1 when the id is in the list, else 0."""
    listed = ids.select(on).where(F.col(on).isNotNull()).distinct().withColumn("__listed", F.lit(1))
    return df.join(listed, on, "left").withColumn(name, F.coalesce("__listed", F.lit(0))).drop("__listed")


def fanout_mean(
    left: DataFrame, right: DataFrame, on: str, group: str, value: str, name: str
) -> DataFrame:
    """Mean of ``value`` by ``group`` over the many-to-many join, without building the join.

    Each right row counts once per matching left row. Both sides are collapsed per join key (left to
    a count, right to sum and count by group), so the product of the two multiplicities is never
    emitted and a hot key costs one row per group. Whole and broken parts of a total are weighted
    apart, so that both products fit a decimal without rounding.
    """
    weight = left.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("__w"))
    plain, rest = total_parts(value)
    part = right.groupBy(on, group).agg(
        F.coalesce(plain, F.lit(0)).alias("__s"), rest.alias("__rest"), F.count(F.col(value)).alias("__n")
    )
    whole = F.floor("__s").cast("decimal(19,0)")
    broken = (F.col("__s") - F.floor("__s")).cast("decimal(19,18)")
    times = F.col("__w").cast("decimal(18,0)")
    return part.join(weight, on).groupBy(group).agg(
        F.try_divide(
            (F.sum(whole * times).cast("decimal(37,18)") + F.sum(broken * times).cast("decimal(37,18)")).cast("double")
            + F.coalesce(exact_sum(F.col("__rest") * F.col("__w")), F.lit(0.0)),
            F.sum(F.col("__n") * F.col("__w")),
        ).alias(name)
    )


def join_on_value(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """Inner join of two aggregated tables on an aggregated value; equal values all match."""
    return a.join(b, value, "inner")


def order(df: DataFrame, *keys: tuple[str, bool]) -> DataFrame:
    """Sort by (column, descending) pairs; missing values count as lowest."""
    return df.orderBy(*[F.desc(c) if desc else F.asc(c) for c, desc in keys])


def _equal(on: Mapping[str, str]) -> Column:
    return reduce(lambda a, b: a & b, (as_col(l) == as_col(r) for l, r in on.items()))
