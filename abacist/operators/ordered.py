"""Ordered computations inside groups of any size.

A window ``partitionBy(key).orderBy(t)`` sends a whole group to one task. That is the right plan for
groups that fit a task and the wrong one for a group that holds a third of the table. Here the group
sizes are measured first (one aggregation that reads only the key columns). Groups within the limit
use the plain window. Larger groups are range-partitioned on (key, order) into blocks, each block
computes its own running value, and one small table with a row per (group, block) supplies what the
earlier blocks carry in.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacist.session import materialise

GROUP_LIMIT = 4_000_000
"""Rows of one group that a single task may sort and scan."""

BROADCAST_ROWS = 100_000
"""Counted rows of a narrow side table up to which it is sent to every task."""

KEY = "__key"
BLOCK = "__block"
ROW = "__row"


@dataclass(frozen=True)
class Running:
    """A running value: ``kind`` is sum, count, product, max or last (last non-null).

    ``backward`` runs from the end of the group; ``exclusive`` leaves out the current row.
    """

    name: str
    kind: str
    value: Column
    backward: bool = False
    exclusive: bool = False

    def within(self, window) -> Column:
        v = self.value
        return {
            "sum": lambda: F.sum(v),
            "count": lambda: F.count(v),
            "product": lambda: F.product(v),
            "max": lambda: F.max(v),
            "last": lambda: F.last(v, ignorenulls=True),
        }[self.kind]().over(window)

    def of_block(self) -> Column:
        v = self.value
        return {
            "sum": lambda: F.sum(v),
            "count": lambda: F.count(v),
            "product": lambda: F.product(v),
            "max": lambda: F.max(v),
            "last": lambda: (F.min_by if self.backward else F.max_by)(v, F.when(v.isNotNull(), F.col(ROW))),
        }[self.kind]()

    def over_blocks(self, block_value: Column, window) -> Column:
        return {
            "sum": lambda: F.sum(block_value),
            "count": lambda: F.sum(block_value),
            "product": lambda: F.product(block_value),
            "max": lambda: F.max(block_value),
            "last": lambda: F.last(block_value, ignorenulls=True),
        }[self.kind]().over(window)

    def combine(self, carried: Column, own: Column) -> Column:
        if self.kind == "last":
            return F.coalesce(own, carried)
        if self.kind == "max":
            return F.greatest(own, carried)
        op = (lambda a, b: a * b) if self.kind == "product" else (lambda a, b: a + b)
        return F.when(carried.isNull(), own).when(own.isNull(), carried).otherwise(op(carried, own))


def null_safe_join(left: DataFrame, right: DataFrame, names: Sequence[str], how: str, small: bool = False) -> DataFrame:
    """Equi-join that also matches null keys to null keys."""
    renamed = right.withColumnsRenamed({n: f"__right_{n}" for n in names})
    renamed = F.broadcast(renamed) if small else renamed
    cond = reduce(lambda a, b: a & b, (F.col(n).eqNullSafe(F.col(f"__right_{n}")) for n in names))
    return left.join(renamed, cond, how).drop(*[f"__right_{n}" for n in names])


def is_small(side: DataFrame) -> bool:
    """Whether a written side table has few enough rows to broadcast; counts no further than the limit."""
    return side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def attach(df: DataFrame, side: DataFrame, names: Sequence[str]) -> DataFrame:
    """Inner join of a narrow aggregated table, null keys included.

    The side table is written and counted. A small one is broadcast, so the rows it is attached to are
    not shuffled; a large one is joined by shuffle, where adaptive execution splits hot keys.
    """
    side = materialise(side)
    return null_safe_join(df, side, names, "inner", is_small(side))


def hot_groups(df: DataFrame, by: Sequence[str], limit: int) -> DataFrame | None:
    """Keys of the groups above the limit, or None. At most rows/limit keys exist."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    hot = materialise(counts.select(*by))
    return None if hot.isEmpty() else hot


def in_blocks(df: DataFrame, by: Sequence[str], order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows in (by, order) sequence over range partitions, numbered once and written durably.

    ``order`` must end in a unique column, so that no partition is forced to hold equal keys. The group
    columns are also kept as one struct, which is never null and compares null fields as equal: windows,
    totals and the join on it share one hash partitioning.
    """
    keys = [*by, *order]
    ranged = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    numbered = ranged.sortWithinPartitions(*keys).withColumn(ROW, F.monotonically_increasing_id())
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    return materialise(numbered.withColumns({BLOCK: F.shiftright(F.col(ROW), 33), KEY: group}))


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    specs: Sequence[Running],
    group_limit: int = GROUP_LIMIT,
    parts: int | None = None,
    hot: DataFrame | None | str = "measure",
) -> DataFrame:
    """Add running values per group, in ascending order of the order columns.

    ``hot`` may pass the result of an earlier ``hot_groups`` on the same keys.
    """
    ascending, descending = [F.asc(o) for o in order], [F.desc(o) for o in order]

    def plain(s: Running):
        return Window.partitionBy(*by).orderBy(*(descending if s.backward else ascending)).rowsBetween(
            Window.unboundedPreceding, -1 if s.exclusive else 0
        )

    def windowed(rows: DataFrame) -> DataFrame:
        return rows.withColumns({s.name: s.within(plain(s)) for s in specs})

    def blocked(rows: DataFrame) -> DataFrame:
        rows = in_blocks(rows, by, order, parts)
        keys = [KEY, BLOCK]

        def turn(s: Running, c: str) -> Column:
            return F.desc(c) if s.backward else F.asc(c)

        def inside(s: Running):
            return Window.partitionBy(*keys).orderBy(turn(s, ROW)).rowsBetween(
                Window.unboundedPreceding, -1 if s.exclusive else 0
            )

        def earlier(s: Running):
            return Window.partitionBy(KEY).orderBy(turn(s, BLOCK)).rowsBetween(Window.unboundedPreceding, -1)

        blocks = rows.groupBy(*keys).agg(*[s.of_block().alias(f"__v_{s.name}") for s in specs])
        carried = blocks.select(
            *keys, *[s.over_blocks(F.col(f"__v_{s.name}"), earlier(s)).alias(f"__c_{s.name}") for s in specs]
        )
        own = rows.withColumns({f"__o_{s.name}": s.within(inside(s)) for s in specs})
        joined = own.join(carried, keys, "left")
        return joined.select(
            *df.columns,
            *[s.combine(F.col(f"__c_{s.name}"), F.col(f"__o_{s.name}")).alias(s.name) for s in specs],
        )

    if not by:
        return blocked(df) if df.count() > group_limit else windowed(df)
    if isinstance(hot, str):
        hot = hot_groups(df, by, group_limit)
    if hot is None:
        return windowed(df)
    few = is_small(hot)
    cold = null_safe_join(df, hot, by, "left_anti", few)
    large = null_safe_join(df, hot, by, "left_semi", few)
    return windowed(cold).unionByName(blocked(large))


def position(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str, **how) -> DataFrame:
    """Row number inside the group, from 1."""
    return running(df, by, order, [Running(name, "count", F.lit(1))], **how)


def running_total(
    df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, name: str, nulls: str = "skip", **how
) -> DataFrame:
    """Running total where a missing value either counts as nothing (``skip``) or makes every
    later total missing (``propagate``)."""
    out = running(
        df, by, order,
        [Running("__sum", "sum", F.col(col)), Running("__missing", "max", F.col(col).isNull().cast("int"))],
        **how,
    )
    total = F.coalesce(F.col("__sum"), F.lit(0))
    if nulls == "propagate":
        total = F.when(F.col("__missing") == 0, F.col("__sum"))
    elif nulls != "skip":
        raise ValueError(f"unknown nulls rule {nulls!r}")
    return out.withColumn(name, total).drop("__sum", "__missing")


def fill(
    df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, direction: str = "forward",
    name: str | None = None, **how,
) -> DataFrame:
    """Replace nulls with the last value before them, or the next one after them (``backward``)."""
    if direction not in ("forward", "backward"):
        raise ValueError(f"unknown direction {direction!r}")
    last = Running("__filled", "last", F.col(col), backward=direction == "backward")
    return running(df, by, order, [last], **how).withColumn(name or col, F.col("__filled")).drop("__filled")


def cumulative_product(df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, name: str, **how) -> DataFrame:
    return running(df, by, order, [Running(name, "product", F.col(col))], **how)


def split_first(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int, name: str = "part", **how) -> DataFrame:
    """Mark the first ``n`` rows of each group as train, the rest as test."""
    placed = position(df, by, order, "__pos", **how)
    return placed.withColumn(name, F.when(F.col("__pos") <= n, "train").otherwise("test")).drop("__pos")
