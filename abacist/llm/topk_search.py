"""Exact top-k search by inner product with bounds from segment statistics.

A vector is cut into equal segments; a segment's mean and deviation bound distances from below:
the squared distance of two segments of length L is at least L ((m - m')^2 + (d - d')^2), which for inner
products reads: at most L (m m' + d d'). Candidates meet the queries in Arrow batches. Bounds are
compared with each query's k-th best score so far, coarse segments first; only survivors are scored
exactly. Queries travel in blocks of at most ``QUERY_BLOCK`` vectors, one job over the candidates each;
every task keeps k rows per query, and one ranking per query merges them.

Components become ``floor(1024 x)``. Defined cases: null vectors and vectors with null or non-finite
components take no part; vectors of different length are not compared, empty ones score 0 with each other; rows with
equal ids are separate rows, and only the query's own row is left out; ties go to the smaller id, null
ids last; results are exact while scores fit 63 bits.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacist.session import materialise

QUERY_BLOCK = 4096
SCALE = 1024
SEGMENTS = (2, 8, 32)
"""Numbers of segments, coarse to fine; those above half the length are left out."""


def whole_numbers(vector: Column) -> Column:
    """``floor(1024 x)`` of every component as double holds it, null where the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == math.inf))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long")))


def features(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Scaled means and deviations: their inner product is the bound."""
    n, dim = vectors.shape
    edges = np.linspace(0, dim, segments + 1).astype(int)[:-1]
    length = np.diff(np.append(edges, dim)).astype(float)
    mean = np.add.reduceat(vectors, edges, axis=1) / length
    square = np.add.reduceat(vectors * vectors, edges, axis=1) / length
    deviation = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.hstack([mean, deviation]) * np.sqrt(np.hstack([length, length]))


class Searcher:
    """The best k of each query among the rows seen so far, all vectors of one length."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, k: int):
        self.rows, self.vectors, self.k = rows, vectors, k
        self.exact = vectors.astype(float)
        self.levels = [s for s in SEGMENTS if 2 * s <= vectors.shape[1]]
        self.features = [features(self.exact, s) for s in self.levels]
        self.best = [(np.empty(0, "i8"),) * 3 for _ in rows]  # score, id, null id
        self.floor = np.full(len(rows), -np.inf)

    def see(self, rows: np.ndarray, ids: np.ndarray, no_id: np.ndarray, vectors: np.ndarray) -> None:
        values = vectors.astype(float)
        peak = np.abs(values).max(initial=0) * np.abs(self.exact).max(initial=0) * max(1, values.shape[1])
        in_double = peak < 2**52
        slack = 1e-9 * peak + 1e-6
        levels = [features(values, s) for s in self.levels]
        first = self.features[0] @ levels[0].T if levels else None
        for i in range(len(self.rows)):
            keep = np.flatnonzero(rows != self.rows[i])
            if first is not None:
                keep = keep[first[i, keep] + slack >= self.floor[i]]
                for mine, theirs in zip(self.features[1:], levels[1:]):
                    keep = keep[theirs[keep] @ mine[i] + slack >= self.floor[i]]
            if not len(keep):
                continue
            scores = (values[keep] @ self.exact[i]).astype("i8") if in_double else vectors[keep] @ self.vectors[i]
            near = scores >= self.floor[i]
            self.merge(i, scores[near], ids[keep][near], no_id[keep][near])

    def merge(self, i: int, *found: np.ndarray) -> None:
        score, ident, no_id = (np.concatenate(pair) for pair in zip(self.best[i], found))
        top = np.lexsort((ident, no_id, -score))[: self.k]
        self.best[i] = (score[top], ident[top], no_id[top])
        if len(top) == self.k:
            self.floor[i] = score[top[-1]]


def stack(vectors, dim: int) -> np.ndarray:
    return np.array([np.asarray(v, dtype="i8") for v in vectors], dtype="i8").reshape(len(vectors), dim)


def partial_best(queries, k: int):
    """Per task: the k best rows of every query in the block."""

    def run(batches):
        by_length = {dim: Searcher(rows, vectors, k) for dim, (rows, _, vectors) in queries.value.items()}
        for batch in batches:
            lengths = batch["v"].map(len)
            for dim, searcher in by_length.items():
                part = batch[lengths == dim]
                if len(part):
                    searcher.see(part["row"].to_numpy(), part["id"].fillna(0).to_numpy("i8"),
                                 part["id"].isna().to_numpy(), stack(part["v"], dim))
        for dim, searcher in by_length.items():
            owner = queries.value[dim][1]
            for i, (score, ident, no_id) in enumerate(searcher.best):
                if len(score):
                    yield pd.DataFrame({
                        "query_row": searcher.rows[i], "query_id": owner[i],
                        "vec_id": pd.array(ident, dtype="Int64").copy() if not no_id.any()
                        else pd.array([None if z else int(v) for v, z in zip(ident, no_id)], dtype="Int64"),
                        "score": score})

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every query row."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), whole_numbers(F.col(vector_col)).alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = materialise(rows.where(F.col("v").isNotNull()).withColumn("row", F.monotonically_increasing_id()))
    asked = rows.where("asks")
    blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    found = []
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("row", "id", "v").collect()
        by_length = {}
        for dim in {len(r.v) for r in block}:
            own = [r for r in block if len(r.v) == dim]
            by_length[dim] = (np.array([r.row for r in own]), [r.id for r in own], stack([r.v for r in own], dim))
        queries = spark.sparkContext.broadcast(by_length)
        found.append(rows.select("row", "id", "v").mapInPandas(
            partial_best(queries, k), "query_row long, query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
