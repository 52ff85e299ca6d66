"""Exact quantiles of columns of any length.

The built-in exact percentile keeps every distinct value of a group in one task. Here the rows are
first cut at bounds that an approximate sketch proposes around each wanted rank, and one counting
pass over the cuts shows which interval holds the rank. Intervals that are still large are cut again;
the values of the small ones are ranked. All columns and all ranks share each pass, and nothing but
interval counts and the wanted values themselves returns to the caller.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abacist.operators.cells import cells

BAND_LIMIT = 250_000
"""Distinct values of one interval that a single task may rank."""

SKETCH_ACCURACY = 10_000
ROUNDS = 8


@dataclass
class Span:
    """Values in [low, high) of a column: rows below and inside, an upper bound of the number of
    distinct values, and the ranks looked for."""

    name: str
    low: float
    high: float
    below: int
    rows: int
    values: int
    ranks: list[int]


def order_statistics(
    df: DataFrame, ranks: Mapping[str, Sequence[int]], counts: Mapping[str, int], band_limit: int = BAND_LIMIT,
    distinct: Mapping[str, int] | None = None,
) -> dict[tuple[str, int], float]:
    """Value at each zero-based rank among the non-missing values of each column.

    ``distinct`` may bound the number of distinct values: a column with few is never cut.
    """
    found: dict[tuple[str, int], float] = {}
    values = {n: min(counts[n], (distinct or counts)[n]) for n in ranks}
    spans = [Span(n, -math.inf, math.inf, 0, counts[n], values[n], sorted(set(rs))) for n, rs in ranks.items() if rs]
    for _ in range(ROUNDS):
        large = [s for s in spans if s.values > band_limit]
        if not large:
            break
        spans = [s for s in spans if s.values <= band_limit] + _cut(df, large, found)
    if spans:
        found.update(_rank(df, spans))
    return found


def _cut(df: DataFrame, large: list[Span], found: dict) -> list[Span]:
    """Smaller spans that hold the ranks of the large ones; ranks that fall on a bound are found."""
    slack = 2.0 / SKETCH_ACCURACY

    def inside(s: Span):
        x = F.col(s.name).cast("double")
        return F.when((x >= s.low) & (x < s.high) & ~F.isnan(x), x)

    def shares(s: Span) -> list[float]:
        at = [(r - s.below) / (s.rows - 1) for r in s.ranks]
        return sorted({min(1.0, max(0.0, p + d)) for p in at for d in (-slack, slack)})

    sketch = df.agg(*[
        F.percentile_approx(inside(s), F.array(*map(F.lit, shares(s))), SKETCH_ACCURACY).alias(f"s{i}")
        for i, s in enumerate(large)
    ]).first()
    cuts: dict[str, set[float]] = {}
    for i, s in enumerate(large):
        # a bound and its successor enclose exactly the rows equal to the bound
        bounds = {b for v in sketch[f"s{i}"] for b in (v, math.nextafter(v, math.inf))}
        cuts.setdefault(s.name, set()).update(bounds | {b for b in (s.low, s.high) if math.isfinite(b)})
    ordered = {n: sorted(c) for n, c in cuts.items()}
    names = list(ordered)
    tally = {
        (names[r["i"]], r["cell"]): r["n"]
        for r in cells(df, ordered).where(F.col("x").isNotNull()).groupBy("i", "cell").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    out = []
    for n in names:
        edges = [-math.inf, *ordered[n], math.inf]
        wanted = sorted(r for s in large if s.name == n for r in s.ranks)
        below = 0
        for k in range(len(edges) - 1):
            rows = tally.get((n, k), 0)
            here = [r for r in wanted if below <= r < below + rows]
            if here and edges[k + 1] == math.nextafter(edges[k], math.inf):
                found.update({(n, r): edges[k] for r in here})
            elif here:
                out.append(Span(n, edges[k], edges[k + 1], below, rows, rows, here))
            below += rows
    return out


def _rank(df: DataFrame, spans: list[Span]) -> dict[tuple[str, int], float]:
    """Values at the wanted ranks of small spans.

    The spans are laid end to end, so that one sorted list of positions holds every wanted rank and a
    row that covers one is recognised by binary search rather than by meeting all ranks of its span.
    """
    cuts: dict[str, list[float]] = {}
    for s in spans:
        cuts.setdefault(s.name, []).extend(b for b in (s.low, s.high) if math.isfinite(b))
    cuts = {n: sorted(set(c)) for n, c in cuts.items()}
    names = list(cuts)
    starts, at, places = [], 0, {}
    for s in spans:
        cell = cuts[s.name].index(s.low) + 1 if math.isfinite(s.low) else 0
        starts.append((names.index(s.name), cell, at))
        places |= {at + r - s.below: (s.name, r) for r in s.ranks}
        at += s.rows
    wanted = sorted(places)
    placed = df.sparkSession.createDataFrame(starts, "i int, cell int, start long").coalesce(1)
    tallies = (
        cells(df, cuts).where(F.col("x").isNotNull()).join(F.broadcast(placed), ["i", "cell"])
        .groupBy("start", "x").agg(F.count(F.lit(1)).alias("n"))
    )
    w = Window.partitionBy("start").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    through = (F.col("start") + F.sum("n").over(w)).cast("double")
    ranked = tallies.select("x", through.alias("to"), (through - F.col("n")).alias("from"))
    ends = Bucketizer(
        splitsArray=[[-math.inf, *map(float, wanted), math.inf]] * 2,
        inputCols=["to_last", "from_last"], outputCols=["to_cell", "from_cell"],
    ).transform(ranked.select("x", "to", "from", (F.col("to") - 1).alias("to_last"), (F.col("from") - 1).alias("from_last")))
    out = {}
    for h in ends.where(F.col("to_cell") > F.col("from_cell")).select("x", "to", "from").collect():
        first, last = bisect_left(wanted, h["from"]), bisect_left(wanted, h["to"])
        out.update({places[p]: h["x"] for p in wanted[first:last]})
    return out


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], how: str = "linear", band_limit: int = BAND_LIMIT
) -> dict[str, list[float | None]]:
    """Quantiles of each column, missing values left out.

    ``linear`` interpolates between neighbours; ``higher_tail`` gives the largest value that is left
    when the int((1-p)*n) largest values are set aside.
    """
    if how not in ("linear", "higher_tail"):
        raise ValueError(f"unknown quantile rule {how!r}")
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols])
    # the distinct estimate is within a few percent; the margin keeps it an upper bound in practice,
    # and a wrong one only changes how many rows are ranked together
    seen = numbers.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
        *[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(cols)],
    ).first()
    sizes = {c: seen[f"n{i}"] for i, c in enumerate(cols)}
    distinct = {c: 1 + seen[f"d{i}"] * 5 // 4 for i, c in enumerate(cols)}

    def ranks(n: int, p: float) -> tuple[int, int, float]:
        if how == "higher_tail":
            r = n - 1 - tail_size(n, 1 - p)
            return r, r, 0.0
        at = p * (n - 1)
        return math.floor(at), math.ceil(at), at - math.floor(at)

    need = {c: [r for p in probs for r in ranks(sizes[c], p)[:2]] for c in cols if sizes[c]}
    at = order_statistics(numbers, need, sizes, band_limit, distinct) if need else {}

    def value(c: str, p: float) -> float | None:
        if not sizes[c]:
            return None
        lo, hi, part = ranks(sizes[c], p)
        return at[(c, lo)] + (at[(c, hi)] - at[(c, lo)]) * part

    return {c: [value(c, p) for p in probs] for c in cols}


def tail_size(n: int, share: float) -> int:
    """Whole number of rows in a tail share; 0.04 of 100 is 4 despite binary fractions."""
    return int(round(share * n, 9))


def group_quantiles(
    df: DataFrame, group: str, values: Sequence, col: str, probs: Sequence[float], **how
) -> dict[object, list[float | None]]:
    """Quantiles of one column inside each of a short list of group values, in the same passes."""
    wide = df.select(
        *[F.when(F.col(group).eqNullSafe(F.lit(v)), F.col(col)).alias(f"g{i}") for i, v in enumerate(values)]
    )
    got = exact_quantiles(wide, wide.columns, probs, **how)
    return {v: got[f"g{i}"] for i, v in enumerate(values)}
