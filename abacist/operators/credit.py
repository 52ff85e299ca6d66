"""Credit scorecards: binning, weight of evidence, reject inference and points."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacist.functions.scalars import finite_or_zero, safe_divide
from abacist.operators.aggregates import is_numeric
from abacist.operators.cells import cells
from abacist.operators.ordered import BROADCAST_ROWS
from abacist.operators.quantiles import exact_quantiles
from abacist.session import materialise

BIN_SCHEMA = "var string, min_value double, max_value double, category string, count long, event long"


def mono_bins(
    df: DataFrame, y: str, xs: Sequence[str], max_bin: int = 20, force_bin: int = 3
) -> DataFrame:
    """Monotone bins of numeric columns against a 0/1 event.

    For each column the largest number of quantile bins is taken for which the event rate moves
    strictly in one direction. The search also ends where the direction is undefined (constant event
    rate, or a bin without rows); with a single bin left, ``force_bin`` cut points are used instead.
    Missing values form a bin of their own.

    Every candidate's bins are unions of the intervals between all candidates' cut points, so one
    aggregation over those intervals serves all columns and all candidates. Only that table, at most
    a few hundred rows per column, reaches the driver.
    """
    xs = list(xs)
    fractions = sorted({k / n for n in range(1, max_bin + 1) for k in range(n + 1)})
    forced = [i / (force_bin - 1) for i in range(force_bin)]
    probs = sorted(set(fractions) | set(forced))
    quantiles = exact_quantiles(df, xs, probs)
    at = {x: dict(zip(probs, quantiles[x])) for x in xs if quantiles[x][0] is not None}
    fallback = {x: _forced_edges([at[x][f] for f in forced]) for x in at}
    cuts = {x: sorted(set(at[x].values()) | set(fallback[x])) for x in at}
    tallies = _interval_tallies(df, y, cuts)
    rows = []
    for x in xs:
        parts = tallies.get(x, {})
        if x in at:
            inside = [(k, parts[k]) for k in sorted(k for k in parts if k is not None)]
            for count, event, low, high in _choose_bins(inside, cuts[x], at[x], fallback[x], max_bin):
                rows.append((x, low, high, None, count, event))
        if None in parts:
            count, event = parts[None][:2]
            rows.append((x, None, None, None, count, event))
    return df.sparkSession.createDataFrame(rows, BIN_SCHEMA)


def _forced_edges(q: list[float]) -> list[float]:
    edges = sorted(set(q))
    return edges if len(edges) != 2 else sorted({1.0, q[0] / 2, *q[1:]})


def _interval_tallies(df: DataFrame, y: str, cuts: Mapping[str, list[float]]):
    """Per column and interval (a, b] between cut points: count, events, min and max of x."""
    names = list(cuts)
    if not names:
        return {}
    # cells are closed on the left; on negated values they are closed on the right
    flipped = df.select(F.col(y).cast("long").alias("__y"), *[(-F.col(x).cast("double")).alias(x) for x in names])
    got = cells(flipped, {x: [-c for c in reversed(cuts[x])] for x in names}, keep=["__y"]).groupBy("i", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum("__y").alias("e"), F.min("x").alias("lo"), F.max("x").alias("hi"),
    ).collect()
    out: dict[str, dict] = {}
    for r in got:
        mine = out.setdefault(names[r["i"]], {})
        if r["cell"] is None:
            mine[None] = (r["n"], r["e"], None, None)
        else:
            mine[len(cuts[names[r["i"]]]) - r["cell"]] = (r["n"], r["e"], -r["hi"], -r["lo"])
    return out


def _merge(inside, cuts: list[float], edges: list[float]):
    """Interval tallies joined into the bins between edges; None for a bin without rows."""
    bins = [None] * (len(edges) - 1)
    for k, (n, e, lo, hi) in inside:
        upper = cuts[min(k, len(cuts) - 1)]
        b = next((i for i, edge in enumerate(edges[1:]) if upper <= edge), len(bins) - 1)
        old = bins[b]
        bins[b] = (n, e, lo, hi) if old is None else (old[0] + n, old[1] + e, min(old[2], lo), max(old[3], hi))
    return bins


def _choose_bins(inside, cuts, at, fallback, max_bin):
    for n in range(max_bin, 0, -1):
        edges = [at[k / n] for k in range(n + 1)]
        if len(set(edges)) < len(edges):
            continue
        bins = _merge(inside, cuts, edges)
        if len(bins) == 1:
            break
        if any(b is None for b in bins):
            return [b for b in bins if b is not None]
        # rates are compared as cross products of whole numbers
        signs = {
            (a[1] * b[0] > b[1] * a[0]) - (a[1] * b[0] < b[1] * a[0]) for a, b in zip(bins, bins[1:])
        }
        if signs in ({1}, {-1}, {0}):
            return bins
    return [b for b in _merge(inside, cuts, fallback) if b is not None]


def char_bins(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """One bin per value of each column, missing included."""
    pairs = df.select(
        F.col(y).cast("long").alias("y"),
        F.explode(F.array(*[
            F.struct(F.lit(x).alias("var"), F.col(x).cast("string").alias("category")) for x in xs
        ])).alias("c"),
    ).select("c.var", "c.category", "y")
    counts = pairs.groupBy("var", "category").agg(F.count(F.lit(1)).alias("count"), F.sum("y").alias("event"))
    none = F.lit(None).cast("double")
    return counts.select("var", none.alias("min_value"), none.alias("max_value"), "category", "count", "event")


def woe_iv(bins: DataFrame) -> DataFrame:
    """Rates, shares, weight of evidence and information value; a bin of one kind only counts 0.

    The bins are written first, so that the totals joined back do not count the rows again.
    """
    bins = materialise(bins)
    totals = bins.groupBy("var").agg(
        F.sum("event").alias("__e"), F.sum(F.col("count") - F.col("event")).alias("__ne")
    )
    shares = bins.join(totals, "var").withColumn("nonevent", F.col("count") - F.col("event")).withColumns({
        "event_rate": F.col("event") / F.col("count"),
        "non_event_rate": F.col("nonevent") / F.col("count"),
        "dist_event": safe_divide("event", "__e"),
        "dist_non_event": safe_divide("nonevent", "__ne"),
    })
    both = (F.col("dist_event") > 0) & (F.col("dist_non_event") > 0)
    woe = F.when(both, F.ln(F.col("dist_event") / F.col("dist_non_event"))).otherwise(F.lit(0.0))
    scored = shares.withColumn("woe", finite_or_zero(woe)).withColumn(
        "__iv", (F.col("dist_event") - F.col("dist_non_event")) * F.col("woe")
    )
    per_var = scored.groupBy("var").agg(F.sum("__iv").alias("iv"))
    return scored.drop("__iv", "__e", "__ne").join(per_var, "var")


def split_kinds(df: DataFrame, xs: Sequence[str]) -> tuple[list[str], list[str]]:
    """Columns to bin monotonically (numeric with more than two values) and columns to bin by value.

    The test needs no distinct count: a column has at most two values when all its non-null values
    equal its minimum or its maximum.
    """
    numeric = [x for x in xs if is_numeric(df, x)]
    if not numeric:
        return [], list(xs)
    ends = df.agg(*[f(x).alias(f"{n}{i}") for i, x in enumerate(numeric) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    more = df.agg(*[
        F.coalesce(F.bool_or((F.col(x) > F.lit(ends[f"lo{i}"])) & (F.col(x) < F.lit(ends[f"hi{i}"]))), F.lit(False)).alias(f"m{i}")
        for i, x in enumerate(numeric)
    ]).first()
    mono = [x for i, x in enumerate(numeric) if more[f"m{i}"]]
    return mono, [x for x in xs if x not in mono]


def bin_all(
    df: DataFrame, y: str, xs: Sequence[str], kinds: tuple[Sequence[str], Sequence[str]] | None = None
) -> DataFrame:
    """Bins with weight of evidence and information value of every column, as a written table."""
    mono, chars = kinds or split_kinds(df, xs)
    sets = ([mono_bins(df, y, mono)] if mono else []) + ([char_bins(df, y, chars)] if chars else [])
    bins = sets[0] if len(sets) == 1 else sets[0].unionByName(sets[1])
    return materialise(woe_iv(bins))


def iv_table(bins: DataFrame) -> DataFrame:
    """Information value per column."""
    return bins.groupBy("var").agg(F.max("iv").alias("iv"))


def woe_transform(
    df: DataFrame, bins: DataFrame, mono: Sequence[str], chars: Sequence[str] = (), prefix: str = "new_",
    value: str = "woe",
) -> DataFrame:
    """Add the bin's ``value`` of each column: first bin whose maximum is not below x, else 0.

    Monotone bins number at most a few dozen per column and become a ``when`` chain. Category bins
    may be many: they are counted, broadcast where few and joined by shuffle where not.
    """
    sizes = {r["var"]: r["count"] for r in bins.where(F.col("var").isin(*chars)).groupBy("var").count().collect()} if chars else {}
    few = bins.where(F.col("var").isin(*mono)).select("var", "max_value", value).collect() if mono else []
    made: dict[str, Column] = {}
    for x in mono:
        mine = [(r["max_value"], r[value]) for r in few if r["var"] == x]
        missing = next((v for m, v in mine if m is None), 0.0)
        out = F.when(F.col(x).isNull() | F.isnan(F.col(x).cast("double")), F.lit(missing))
        for top, v in sorted(b for b in mine if b[0] is not None):
            out = out.when(F.col(x) <= F.lit(top), F.lit(v))
        made[prefix + x] = out.otherwise(F.lit(0.0))
    out_df = df.withColumns(made) if made else df
    for x in chars:
        side = bins.where(F.col("var") == x).select(
            F.col("category").alias("__cat"), F.col(value).alias("__value")
        )
        side = F.broadcast(side) if sizes.get(x, 0) <= BROADCAST_ROWS else side
        out_df = out_df.join(side, F.col(x).cast("string").eqNullSafe(F.col("__cat")), "left").withColumn(
            prefix + x, F.coalesce("__value", F.lit(0.0))
        ).drop("__cat", "__value")
    return out_df


def infer_rejects(
    scored: DataFrame, prob: str = "prob_default", accept: float = 0.2, label: str = "label", pooled: bool = False
) -> DataFrame:
    """Label scored rejects: 1 above the exact quantile of the default probability.

    ``pooled`` takes the quantile over both class probabilities together.
    """
    pool = scored.select(prob)
    if pooled:
        pool = pool.unionAll(scored.select((F.lit(1.0) - F.col(prob)).alias(prob)))
    cut = exact_quantiles(pool, [prob], [accept])[prob][0]
    return scored.withColumn(label, (F.col(prob) > F.lit(cut)).cast("int"))


def refit_with_rejects(
    accepted: Sequence[DataFrame], rejects: DataFrame, y: str, xs: Sequence[str], fit
) -> tuple[DataFrame, Model]:
    """Bin and fit again on accepted rows and labelled rejects together: (bins, model)."""
    rows = None
    for part in (*accepted, rejects):
        part = part.select(y, *xs)
        rows = part if rows is None else rows.unionByName(part)
    rows = materialise(rows)
    mono, chars = split_kinds(rows, xs)
    bins = bin_all(rows, y, xs, (mono, chars))
    return bins, fit(woe_transform(rows, bins, mono, chars))


def points(woe: Column, coef: Column, alpha: float, n: int, pdo: float = 20, target: float = 600,
           odds: float = 50, sign: int = 1) -> Column:
    """Scorecard points of one bin; ``sign=-1`` rewards bins with few events."""
    factor = pdo / math.log(2)
    offset = target - factor * math.log(odds)
    return F.lit(sign) * (woe * coef + F.lit(alpha / n)) * F.lit(factor) + F.lit(offset / n)


def scorecard(
    bins: DataFrame, coefs: DataFrame, alpha: float, n: int, pdo: float = 20, target: float = 600,
    odds: float = 50, sign: int = 1,
) -> DataFrame:
    """Points per bin of every column with a coefficient (var, coef)."""
    return bins.join(F.broadcast(coefs), "var").select(
        "var", "min_value", "max_value", "category",
        points(F.col("woe"), F.col("coef"), alpha, n, pdo, target, odds, sign).alias("points"),
    )


def score_applicants(
    df: DataFrame, card: DataFrame, mono: Sequence[str], chars: Sequence[str] = (), name: str = "score"
) -> DataFrame:
    """Sum of the points of an applicant's bins."""
    scored = woe_transform(df, card, mono, chars, prefix="__pts_", value="points")
    total = sum((F.col("__pts_" + x) for x in [*mono, *chars]), F.lit(0.0))
    return scored.withColumn(name, total).drop(*["__pts_" + x for x in [*mono, *chars]])


def bins_in_order(bins: DataFrame) -> DataFrame:
    """Number the bins of a column by their lower end, missing last; for reports."""
    w = Window.partitionBy("var").orderBy(F.col("min_value").asc_nulls_last(), F.col("category").asc_nulls_last())
    return bins.withColumn("bin", F.row_number().over(w))
