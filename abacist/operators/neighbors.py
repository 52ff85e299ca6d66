"""Exact nearest neighbours in bounded blocks, neighbour voting and minority oversampling."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.operators.quantiles import order_statistics
from abacist.operators.sampling import HASH_RANGE, hash_number
from abacist.session import materialise

BLOCK_ROWS, MOST_BLOCK_ROWS, BLOCKS = 2048, 32_768, 16
"""Least and most rows of a block, and blocks aimed at between them: a row is copied once per block it meets."""
MOST_PIVOTS = 256
"""Pivots are kept on the driver and compared with every row."""
TILE, RECHECKED = 500_000, 200_000
"""Pairs of one matrix product, and pairs whose distances are computed again at once."""


def nearest(
    queries: DataFrame, points: DataFrame, features: str, id_col: str, k: int,
    exclude_self: bool = False, pivots: int | None = None, block_rows: int | None = None, seed: int = 7,
) -> DataFrame:
    """The ``k`` nearest points of every query: ``id, neighbour, distance, rank`` (ties by point id).

    Points and queries are assigned to the nearest of a few pivots (by default one per block, up to a
    limit) and cut into blocks of bounded size, so a crowded cell only makes more blocks. A block of points is compared with a block of
    queries unless the triangle inequality proves that it cannot hold one of their nearest. Each
    comparison is a run of matrix products in one task and returns at most ``k`` rows per query.
    """
    points, queries = _vectors(points, features, id_col), _vectors(queries, features, id_col)
    if not (pivots and block_rows):
        n = points.count()
        block_rows = block_rows or min(MOST_BLOCK_ROWS, max(BLOCK_ROWS, n // BLOCKS))
        pivots = pivots or min(MOST_PIVOTS, 1 + n // block_rows)
    chosen = points.orderBy(hash_number("id", seed)).limit(pivots).collect()
    if not chosen:
        raise ValueError("no points to search")
    centres = np.array([r["x"] for r in chosen])
    located_points = _locate(points, centres, block_rows)
    located_queries = _locate(queries, centres, block_rows)
    cells = located_points.groupBy("cell").agg(
        F.max("radius").alias("radius"), F.count(F.lit(1)).alias("n")
    ).collect()
    between = np.sqrt(((centres[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2))
    radius = np.full(len(centres), -np.inf)
    size = np.zeros(len(centres), dtype=int)
    for r in cells:
        radius[r["cell"]], size[r["cell"]] = r["radius"], r["n"]
    need = k + 1 if exclude_self else k

    # Per query block: k nearest are no farther than reach + pivot distance + cell radius, taken over
    # the closest cells that together hold enough points.
    query_blocks = located_queries.groupBy("cell", "part").agg(F.max("radius").alias("reach"))

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for cell, part, reach in batch.itertuples(index=False):
                upper = np.where(size > 0, reach + between[cell] + radius, np.inf)
                byreach = np.argsort(upper)
                enough = np.searchsorted(np.cumsum(size[byreach]), need)
                bound = upper[byreach[enough]] if enough < len(byreach) else np.inf
                lower = between[cell] - reach - radius
                for other in np.flatnonzero((size > 0) & (lower <= bound)):
                    out.append((cell, part, int(other)))
            yield pd.DataFrame(out, columns=["q_cell", "q_part", "cell"])

    wanted = query_blocks.mapInPandas(plan, "q_cell int, q_part long, cell int")
    point_blocks = located_points.select("cell", "part").distinct()
    pairs = materialise(wanted.join(point_blocks, "cell"))
    keys = ["q_cell", "q_part", "cell", "part"]
    left = pairs.join(
        located_queries.select(F.col("cell").alias("q_cell"), F.col("part").alias("q_part"), "id", "x"),
        ["q_cell", "q_part"],
    )
    # the cogroup needs columns of its own on each side
    right = pairs.join(located_points.select("cell", "part", "id", "x"), ["cell", "part"]).select(
        *[F.col(k).alias(f"p_{k}") for k in keys], F.col("id").alias("p_id"), F.col("x").alias("p_x")
    )
    id_type = points.schema["id"].dataType.simpleString()
    search = block_search(k, exclude_self)

    def compare(mine: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if len(mine) == 0 or len(others) == 0:
            return pd.DataFrame({"id": [], "neighbour": [], "distance": []})
        ids, other_ids = mine["id"].to_numpy(), others["p_id"].to_numpy()
        at, near, distance = search(np.stack(mine["x"]).astype(float), ids, np.stack(others["p_x"]).astype(float), other_ids)
        return pd.DataFrame({"id": ids[at], "neighbour": other_ids[near], "distance": distance})

    candidates = left.groupBy(*keys).cogroup(right.groupBy(*[f"p_{k}" for k in keys])).applyInPandas(
        compare, f"id {id_type}, neighbour {id_type}, distance double"
    )
    best = _smallest(candidates, k)
    return best.select(
        "id", F.posexplode("best").alias("pos", "b")
    ).select("id", F.col("b.neighbour").alias("neighbour"), F.col("b.distance").alias("distance"),
             (F.col("pos") + 1).alias("rank"))


def block_search(k: int, exclude_self: bool) -> Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row of ``a``, row of ``b`` and distance of the k nearest of every row of ``a``; ties by ``other_ids``.

    A matrix product in single precision gives squared distances up to rounding. What may be among the nearest, rounding
    allowed for, is measured again from the differences. Non-finite distances are left out. The
    function goes to the tasks by value.
    """
    need = k + 1 if exclude_self else k

    def search(a: np.ndarray, ids: np.ndarray, b: np.ndarray, other_ids: np.ndarray):
        order = np.argsort(other_ids, kind="stable")
        order = order[np.isfinite(b[order]).all(axis=1)]
        if len(order) > need:  # of equal vectors only those with the least ids can be needed
            same = np.unique(b[order], axis=0, return_inverse=True)[1].ravel()
            runs = np.argsort(same, kind="stable")
            copy = np.arange(len(runs)) - np.searchsorted(same[runs], same[runs])
            order = order[np.sort(runs[copy < need])]
        b, other_ids = b[order], other_ids[order]
        found = []
        with np.errstate(over="ignore", invalid="ignore"):
            middle = b.mean(axis=0) if len(b) else 0.0
            squares = ((b - middle) ** 2).sum(axis=1)
            right = np.vstack([(b - middle).T, squares]).astype("float32")
            widest = np.sqrt(squares.max(initial=0.0))
            # of the products in single precision, and of the differences as they are rounded in double precision
            rough, fine = (16 * (b.shape[1] + 4) * np.finfo(t).eps for t in ("float32", "float64"))
            farthest = np.sqrt((b ** 2).sum(axis=1).max(initial=0.0))
            step = max(16, TILE // max(1, len(b)))
            for start in range(0, len(a), step):
                mine = a[start:start + step]
                # the query's own square is the same in its whole row
                gap = np.hstack([-2 * (mine - middle), np.ones((len(mine), 1))]).astype("float32") @ right
                if gap.shape[1] > need:
                    rounding = rough * (np.sqrt(((mine - middle) ** 2).sum(axis=1)) + widest) ** 2
                    rounding += fine * (np.sqrt((mine ** 2).sum(axis=1)) + farthest) ** 2
                    # the least of each of some groups: as many as are needed lie at or under the need-th of them
                    wide = max(need, gap.shape[1] // 16)
                    least = gap[:, :wide].copy()
                    for i in range(wide, gap.shape[1], wide):
                        part = gap[:, i:i + wide]
                        np.minimum(least[:, :part.shape[1]], part, out=least[:, :part.shape[1]])
                    limit = (np.partition(least, need - 1, axis=1)[:, need - 1] + rounding).astype("float32")
                    far = gap > limit[:, None]
                else:
                    far = np.zeros(gap.shape, dtype=bool)
                rows, cols = np.divmod(np.flatnonzero(~far), max(1, len(b)))
                d = np.concatenate([np.zeros(0), *[
                    np.sqrt(((b[cols[i:i + RECHECKED]] - mine[rows[i:i + RECHECKED]]) ** 2).sum(axis=1))
                    for i in range(0, len(rows), RECHECKED)
                ]])
                keep = np.isfinite(d)
                if exclude_self:
                    keep &= other_ids[cols] != ids[start + rows]
                rows, cols, d = rows[keep], cols[keep], d[keep]
                best = np.lexsort((cols, d, rows))  # columns are in order of id
                best = best[np.arange(len(best)) - np.searchsorted(rows[best], rows[best]) < k]
                found.append((start + rows[best], order[cols[best]], d[best]))
        return tuple(np.concatenate(v) for v in zip(*found)) if found else (order[:0], order[:0], np.zeros(0))

    return search


def _vectors(df: DataFrame, features: str, id_col: str) -> DataFrame:
    """Ids and vectors; single precision stays as it is, which halves what is shuffled."""
    kind = df.schema[features].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(features).cast(kind if kind == "array<float>" else "array<double>").alias("x"))


def _smallest(candidates: DataFrame, k: int) -> DataFrame:
    """The k smallest (distance, neighbour) per id.

    A query has one run of k candidates per block it met; runs are first merged in hashed batches.
    """
    pair = F.struct("distance", "neighbour")
    batch = F.pmod(F.hash("neighbour"), F.lit(64))
    some = candidates.groupBy("id", batch.alias("batch")).agg(
        F.slice(F.sort_array(F.collect_list(pair)), 1, k).alias("best")
    )
    return some.groupBy("id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"))


def _locate(rows: DataFrame, centres: np.ndarray, block_rows: int) -> DataFrame:
    """Cell of the nearest pivot, distance to it, and a part number that keeps blocks bounded."""
    id_type, x_type = (rows.schema[c].dataType.simpleString() for c in ("id", "x"))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch["x"]).astype(float) if len(batch) else np.empty((0, centres.shape[1]))
            d = np.stack([np.sqrt(((x - c) ** 2).sum(axis=1)) for c in centres], axis=1)
            cell = d.argmin(axis=1)
            yield batch.assign(cell=cell.astype("int32"), radius=d[np.arange(len(x)), cell])

    placed = materialise(rows.mapInPandas(assign, f"id {id_type}, x {x_type}, cell int, radius double"))
    sizes = placed.groupBy("cell").count().collect()
    parts = F.create_map(*[F.lit(v) for r in sizes for v in (r["cell"], max(1, math.ceil(r["count"] / block_rows)))])
    return placed.withColumn("part", F.pmod(F.xxhash64("id"), parts[F.col("cell")].cast("long")))


def knn_vote(
    train: DataFrame, test: DataFrame, features: str, label: str, id_col: str, k: int = 5, **how
) -> DataFrame:
    """Majority label of the k nearest training rows; the smallest label wins a tie."""
    near = nearest(test, train, features, id_col, k, **how)
    labels = train.select(F.col(id_col).alias("neighbour"), F.col(label).alias("label"))
    votes = near.join(labels, "neighbour").groupBy("id", "label").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("id").agg(
        F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("prediction")
    ).withColumnRenamed("id", id_col)


def smote(
    df: DataFrame, features: str, label: str, id_col: str, minority: object, k: int = 5, ratio: float = 1.0,
    seed: int = 7, **how,
) -> DataFrame:
    """Synthetic minority rows until the minority is ``ratio`` times the rest.

    Each synthetic row lies at a random place on the line from a minority row to one of its k nearest
    minority neighbours. Rows take part equally often; the remainder goes to the rows with the
    smallest draws. Returns the synthetic rows: label and features.
    """
    rare = materialise(
        df.where(F.col(label) == F.lit(minority)).select(
            F.col(id_col).alias("__id"), F.col(label).alias("__label"), F.col(features).alias("__from")
        )
    )
    sizes = df.agg(
        F.count_if(F.col(label) == F.lit(minority)).alias("few"), F.count_if(F.col(label) != F.lit(minority)).alias("many")
    ).first()
    few, wanted = sizes["few"], max(0, round(ratio * sizes["many"]) - sizes["few"])
    base, extra = divmod(wanted, few)
    draw = hash_number("__id", seed)
    copies = F.lit(base)
    if extra:
        draws = rare.select(draw.alias("d"))
        cut = order_statistics(draws, {"d": [extra - 1]}, {"d": few})[("d", extra - 1)]
        copies = F.lit(base) + (draw <= F.lit(int(cut))).cast("int")
    near = nearest(rare, rare, "__from", "__id", k, exclude_self=True, **how)
    pool = near.groupBy(F.col("id").alias("__id")).agg(F.sort_array(F.collect_list("neighbour")).alias("__pool"))
    made = rare.join(pool, "__id").withColumn("__copies", copies).where(F.col("__copies") > 0).withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))
    )
    made = made.withColumn("__key", F.concat_ws("-", F.col("__id").cast("string"), "__copy"))
    pick = F.pmod(hash_number("__key", f"{seed}n"), F.size("__pool").cast("long"))
    made = made.withColumn("__to", F.get("__pool", pick.cast("int"))).withColumn(
        "__u", hash_number("__key", f"{seed}u") / F.lit(float(HASH_RANGE))
    )
    ends = rare.select(F.col("__id").alias("__to"), F.col("__from").alias("__end"))
    return made.join(ends, "__to").select(
        F.col("__label").alias(label),
        F.zip_with("__from", "__end", lambda a, b: a + F.col("__u") * (b - a)).alias(features),
    )
