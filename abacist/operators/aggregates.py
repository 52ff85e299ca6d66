"""Grouped aggregates, profiles and tables of counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abacist.functions.scalars import any_match, exact_mean, exact_sum, safe_divide
from abacist.operators.ordered import attach
from abacist.operators.quantiles import exact_quantiles, group_quantiles


@dataclass(frozen=True)
class ActionRule:
    """An output column and the (column, mode, text) tests of which one must hold."""

    name: str
    tests: tuple[tuple[str, str, str], ...]


def conditional_sums(df: DataFrame, by: Sequence[str], rules: Sequence[ActionRule], value: str, *more: Column) -> DataFrame:
    """One summed column per rule over the rows the rule matches; text that is no number is skipped.

    All rules are evaluated in one pass with map-side partial sums.
    """
    number = F.col(value).try_cast("long")
    sums = [
        F.sum(F.when(any_match(r.tests), number).otherwise(F.lit(0))).alias(r.name) for r in rules
    ]
    return df.groupBy(*by).agg(*sums, *more)


def apportion(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Share each measure evenly over the rows of its key group.

    The group size comes from an aggregate joined back rather than a window, so a key group of any
    size is counted with partial sums.
    """
    joined = group_rows(df, keys, "__rows")
    return joined.select(
        *[safe_divide(F.col(c), F.col("__rows")).alias(c) if c in measures else F.col(c) for c in df.columns]
    )


def group_rows(df: DataFrame, keys: Sequence[str], name: str = "group_rows") -> DataFrame:
    """Row count of the key group on every row."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return attach(df, sizes, keys)


def freq_encode(df: DataFrame, col: str) -> DataFrame:
    """Replace a category by its number of rows; a missing category becomes 0."""
    counts = df.groupBy(col).agg(F.count(col).alias("__freq"))
    return attach(df, counts, [col]).withColumn(col, F.col("__freq")).drop("__freq")


def remerge_sum(df: DataFrame, group: str, keep: Sequence[str], measure: str, name: str) -> DataFrame:
    """Distinct rows of the kept columns, each with the total of its group."""
    totals = df.groupBy(group).agg(F.sum(measure).alias(name))
    distinct = df.select(group, *keep).distinct()
    return attach(distinct, totals, [group])


def bundle(measure: str) -> list[Column]:
    """Max, min, mean, sum and count of one measure."""
    return [
        F.max(measure).alias("max"),
        F.min(measure).alias("min"),
        exact_mean(measure).alias("mean"),
        exact_sum(measure).alias("sum"),
        F.count(measure).alias("count"),
    ]


def max_all(df: DataFrame, by: str) -> DataFrame:
    """Largest value of every other column per id."""
    return df.groupBy(by).agg(*[F.max(c).alias(c) for c in df.columns if c != by])


def pivot_count(df: DataFrame, by: str, category: str, values: Sequence, prefix: str = "") -> DataFrame:
    """Row count per id and category, one column per listed category, 0 where there is none."""
    return df.groupBy(by).agg(
        *[F.count_if(F.col(category) == F.lit(v)).alias(f"{prefix}{v}") for v in values]
    )


def yoy(df: DataFrame, by: Sequence[str], date_col: str, amount: str) -> DataFrame:
    """Yearly total, the total of the row before it and the growth; null in the first year.

    The window runs over one row per group and year.
    """
    yearly = df.groupBy(*by, F.year(date_col).cast("long").alias("year")).agg(
        exact_sum(amount).alias("revenue")
    )
    before = F.lag("revenue", 1).over(Window.partitionBy(*by).orderBy("year"))
    return yearly.withColumn("previous_revenue", before).withColumn(
        "yoy_growth", safe_divide(F.col("revenue") - F.col("previous_revenue"), F.col("previous_revenue"))
    )


def means_long(df: DataFrame, by: str, col: str) -> DataFrame:
    """Statistics as rows: N, MIN, MAX, MEAN, STD per group."""
    stats = df.groupBy(by).agg(
        F.count(col).cast("double").alias("N"),
        F.min(col).alias("MIN"),
        F.max(col).alias("MAX"),
        exact_mean(col).alias("MEAN"),
        F.stddev_samp(col).alias("STD"),
    )
    return stats.unpivot(by, ["N", "MIN", "MAX", "MEAN", "STD"], "stat", col)


def freq_table(df: DataFrame, row: str, col: str) -> DataFrame:
    """Two-way table in long form: count, percent of all, of the row and of the column.

    Rows with a missing category are left out. Totals come from the cell counts, not from the rows.
    """
    cells = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row, col).agg(
        F.count(F.lit(1)).alias("count")
    )
    by_row = cells.groupBy(row).agg(F.sum("count").alias("__row"))
    by_col = cells.groupBy(col).agg(F.sum("count").alias("__col"))
    grand = cells.agg(F.sum("count")).scalar()
    return cells.join(by_row, row).join(by_col, col).select(
        row,
        col,
        "count",
        (F.col("count") * 100.0 / grand).alias("percent"),
        (F.col("count") * 100.0 / F.col("__row")).alias("row_percent"),
        (F.col("count") * 100.0 / F.col("__col")).alias("col_percent"),
    )


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Count and share of each value."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("share", F.col("count") / counts.agg(F.sum("count")).scalar())


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, from one aggregate over all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], counts.columns, "column", "missing")


def unique_profile(df: DataFrame) -> DataFrame:
    """Number of distinct non-null values per column.

    (column, value) pairs are reduced on the map side, so a value that fills a third of the rows
    crosses the shuffle once per map task.
    """
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in df.columns])
        ).alias("e")
    ).select("e.column", "e.v")
    distinct = pairs.groupBy("column", "v").agg(F.count(F.lit(1)).alias("rows"))
    return distinct.groupBy("column").agg(F.count("v").alias("unique_values"))


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def describe_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max per numeric column."""
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    one = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                exact_mean(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                *[F.lit(q).cast("double").alias(n) for q, n in zip(quartiles[c], ["q25", "median", "q75"])],
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in cols
        ]
    )
    return one.select(F.inline(F.array(*[F.col(c) for c in cols])))


def stats(df: DataFrame, col: str) -> DataFrame:
    return describe_profile(df, [col])


def seasonality(df: DataFrame, date_col: str, amount: str) -> DataFrame:
    """Mean, number and median of the amount per calendar month."""
    monthly = df.select(F.month(date_col).cast("long").alias("month"), F.col(amount))
    medians = group_quantiles(monthly, "month", list(range(1, 13)), amount, [0.5])
    known = {m: v[0] for m, v in medians.items() if v[0] is not None}
    out = monthly.groupBy("month").agg(
        exact_mean(amount).alias("mean"), F.count(amount).alias("size")
    )
    lookup = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    return out.withColumn("median", lookup[F.col("month")])


def group_total(df: DataFrame, by: str, col: str, cond: Column, name: str) -> DataFrame:
    return df.where(cond).groupBy(by).agg(exact_sum(col).alias(name))


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns as one row."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def schema_listing(df: DataFrame) -> Mapping[str, str]:
    return dict(df.dtypes)
