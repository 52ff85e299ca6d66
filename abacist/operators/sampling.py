"""Samples and splits that depend on a row's key and a seed, never on its place in a partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.operators.quantiles import order_statistics
from abacist.session import materialise

HASH_RANGE = 16**13


def hash_number(id_col: str, seed: int | str) -> Column:
    """Leading 52 bits of the md5 of seed and id: a fixed draw per key, exact as a double."""
    digest = F.md5(F.concat(F.lit(str(seed)), F.col(id_col).cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def sample_n(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """The ``n`` rows with the smallest draws; each task keeps at most ``n``."""
    return df.orderBy(hash_number(id_col, seed), F.col(id_col)).limit(n)


def hash_split(
    df: DataFrame, id_col: str, weights: Mapping[str, float], seed: int, name: str = "split"
) -> DataFrame:
    """Assign each key to a named part with the given probabilities."""
    draw = hash_number(id_col, seed) / F.lit(float(HASH_RANGE))
    total, reached, out = sum(weights.values()), 0.0, F
    parts = list(weights)
    for part in parts[:-1]:
        reached += weights[part] / total
        out = out.when(draw < reached, part)
    return df.withColumn(name, out.otherwise(parts[-1]) if len(parts) > 1 else F.lit(parts[0]))


def stratified_split(
    df: DataFrame, id_col: str, label: str, labels: Sequence, weights: Mapping[str, float], seed: int,
    name: str = "split",
) -> DataFrame:
    """Split every class in the given shares, to the row.

    Within a class the rows are ranked by draw. Ranking a class in one task would not scale, so the
    draw at each cut rank is found with exact order statistics and rows are compared with it.
    """
    draws = materialise(df.select(F.col(label), hash_number(id_col, seed).alias("__draw")))  # read several times
    part = split_by_draw(draws, "__draw", label, labels, weights)
    return df.withColumn("__draw", hash_number(id_col, seed)).withColumn(name, part).drop("__draw")


def split_by_draw(rows: DataFrame, draw: str, label: str, labels: Sequence, weights: Mapping[str, float]) -> Column:
    """Part of a row by its draw and label, the classes split in the given shares of ``rows``, which are read several times."""
    shares = _running_shares(weights)
    draws = rows.select(*[F.when(F.col(label) == F.lit(v), F.col(draw)).alias(f"c{i}") for i, v in enumerate(labels)])
    sizes = draws.agg(*[F.count(c).alias(c) for c in draws.columns]).first().asDict()
    cuts = {c: [round(s * sizes[c]) for s in shares] for c in draws.columns}
    ranks = {c: [k - 1 for k in ks if k > 0] for c, ks in cuts.items()}
    at = order_statistics(draws, ranks, sizes)
    parts = list(weights)
    out = F.lit(None).cast("string")
    for i, v in enumerate(labels):
        c, inner = f"c{i}", F.lit(parts[-1])
        for part, k in reversed(list(zip(parts[:-1], cuts[c]))):
            if k > 0:
                inner = F.when(F.col(draw) <= F.lit(int(at[(c, k - 1)])), part).otherwise(inner)
        out = F.when(F.col(label) == F.lit(v), inner).otherwise(out)
    return out


def _running_shares(weights: Mapping[str, float]) -> list[float]:
    total, reached, out = sum(weights.values()), 0.0, []
    for w in list(weights.values())[:-1]:
        reached += w / total
        out.append(reached)
    return out
