"""Random forests grown on counted bins, one tree per task.

A forest sees its features only as bins. Rows of equal bins and label are counted once for all trees; a tree draws how often each of
them takes part, which is one Poisson draw for all equal rows, and grows in one task without further jobs. The counts, bounded by the
number of bins and by ``MOST_COUNTED``, are what reaches the driver and the tasks. Rows never do.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.session import materialise, shared_dir

PLAIN_WORK = 10_000_000
"""Rows times trees up to which MLlib's own trainer is used: it keeps a number per row and tree and passes over all rows per level."""
MOST_COUNTED = 4_000_000
"""Counted rows that a task may hold; a table with more of them is left to MLlib's trainer."""
CHUNK_VALUES, SUMMARY_VALUES = 4_000_000, 2_000_000
"""Numbers a task sorts at once, and values of all summaries together that the driver reads to place the bins."""
NODES_AT_ONCE = 4_096
"""Nodes whose histograms a task holds at once."""
PATHS_AT_ONCE = 100_000
"""Rows times trees that scoring follows at once."""
SHARES = {"all": lambda p: p, "sqrt": lambda p: math.ceil(math.sqrt(p)), "log2": lambda p: max(1, math.ceil(math.log2(p))), "onethird": lambda p: math.ceil(p / 3)}


def is_large(est: Estimator, n: int) -> bool:
    """Whether the fit is that of a forest which this module can grow and which is too large for MLlib's trainer."""
    return (
        isinstance(est, RandomForestClassifier) and n * est.getNumTrees() > PLAIN_WORK and est.getFeatureSubsetStrategy() in ("auto", *SHARES)
        and not est.isSet(est.weightCol) and not est.isSet(est.thresholds) and est.getMinWeightFractionPerNode() == 0
    )


def fit_forest(est: RandomForestClassifier, rows: DataFrame, n: int) -> Model | None:
    """The forest of an MLlib estimator on ``n`` rows of label and features; None if its bins cannot be counted within the limits.

    Bins lie where MLlib puts them, but between the values of all rows and not of a sample of 10,000.
    """
    attributes = rows.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    first = rows.where("features is not null").first()
    if first is None or "nominal" in attributes or rows.schema["label"].metadata:
        return None
    known = rows.select(F.when(F.col("features").isNotNull(), vector_to_array("features")).alias("x"), F.col("label").cast("double").alias("y"))
    columns = len(first["features"])
    found = _splits(known, n, columns, est.getMaxBins())
    if found is None:
        return None
    splits, classes = found
    if classes < 2 or classes * math.prod(len(s) + 1 for s in splits) >= 2**62:
        return None
    counts = _counted(known, splits, classes)
    if counts.count() > MOST_COUNTED:
        return None
    return _as_model(est, _grown(est, counts, splits, classes), columns, classes)


def chunks(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features, a row per column, and labels of so many rows at once that a task stays small."""
    held, most = [], max(10_000, CHUNK_VALUES // columns)
    for batch in batches:
        if batch.num_rows:
            if batch.column("x").null_count or np.isnan(batch.column("x").flatten().to_numpy()).any():
                raise ValueError("missing values in features: impute them, or only score such rows")
            held.append((batch.column("x").flatten().to_numpy().reshape(-1, columns).T, batch.column("y").to_numpy(zero_copy_only=False)))
            if sum(len(y) for _, y in held) >= most:
                yield tuple(np.concatenate(part, axis=-1) for part in zip(*held))
                held = []
    if held:
        yield tuple(np.concatenate(part, axis=-1) for part in zip(*held))


def value_counts(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their numbers; of more than ``most``, the middles of as many runs of equal length stand for all."""
    x = np.sort(x)
    starts = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
    if len(starts) <= most:
        return x[starts], np.diff(np.append(starts, len(x)))
    edges = np.arange(most + 1) * len(x) // most
    return x[(edges[:-1] + edges[1:]) // 2], np.diff(edges)


def cut_points(values: Sequence[float], counts: Sequence[int], bins: int) -> np.ndarray:
    """MLlib's splits of sorted distinct values: between all of them if they are few, else nearest to equal shares."""
    middles = (np.asarray(values[:-1]) + np.asarray(values[1:])) / 2
    if len(middles) < bins:
        return middles
    stride = sum(counts) / bins
    out, seen, target = [], counts[0], stride
    for middle, count in zip(middles, counts[1:]):
        before, seen = seen, seen + count
        if abs(before - target) < abs(seen - target):
            out.append(middle)
            target += stride
    return np.array(out)


def _splits(known: DataFrame, n: int, columns: int, bins: int) -> tuple[list[np.ndarray], int] | None:
    """Cut points of every column and the number of classes, in one pass; None if too many summaries would reach the driver."""
    pieces = known.rdd.getNumPartitions() + n // max(10_000, CHUNK_VALUES // columns)
    most = max(4 * bins, SUMMARY_VALUES // (columns * pieces))
    if most * columns * pieces > 4 * SUMMARY_VALUES:
        return None

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y in chunks(batches, columns):
            if not (np.isfinite(y).all() and (y >= 0).all() and (y == np.floor(y)).all()):
                raise ValueError("labels of a forest must be whole numbers from 0")
            for k, column in enumerate([*x, y]):
                values, counts = value_counts(column, most) if k < columns else (column.max(keepdims=True), [1])
                yield pa.RecordBatch.from_pydict({"k": pa.array(np.full(len(values), k), pa.int32()), "v": pa.array(values), "n": pa.array(counts, pa.int64())})

    found = known.mapInArrow(summarise, "k int, v double, n long").groupBy("k", "v").agg(F.sum("n").alias("n")).toArrow()
    k, v, n = (found.column(c).to_numpy() for c in ("k", "v", "n"))
    order = np.lexsort((v, k))
    k, v, n = k[order], v[order], n[order]
    return [cut_points(v[k == c], n[k == c].tolist(), bins) for c in range(columns)], int(v[k == columns].max()) + 1


def _counted(known: DataFrame, splits: list[np.ndarray], classes: int) -> DataFrame:
    """Rows per combination of bins and label, as one number each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y in chunks(batches, len(splits)):
            code = np.zeros(len(y), dtype=np.int64)
            for column, cuts in zip(x, splits):
                code = code * (len(cuts) + 1) + np.searchsorted(cuts, column)
            values, counts = np.unique(code * classes + y.astype(np.int64), return_counts=True)
            for at in range(0, len(values), 100_000):
                yield pa.RecordBatch.from_pydict({"code": pa.array(values[at:at + 100_000]), "n": pa.array(counts[at:at + 100_000])})

    return materialise(known.mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")))


def _grown(est: RandomForestClassifier, counts: DataFrame, splits: list[np.ndarray], classes: int) -> DataFrame:
    """Nodes of all trees as MLlib writes them, one task per tree."""
    spark = counts.sparkSession
    table = counts.toArrow()
    code, n = (table.column(c).to_numpy() for c in ("code", "n"))
    order = np.argsort(code)
    code, n = code[order], n[order]
    rest, label = code // classes, (code % classes).astype(np.min_scalar_type(classes))
    bins = []
    for cuts in reversed(splits):
        bins.insert(0, (rest % (len(cuts) + 1)).astype(np.min_scalar_type(len(cuts))))
        rest = rest // (len(cuts) + 1)
    sent = spark.sparkContext.broadcast((bins, label, n))
    trees, seed, rate, bagged = est.getNumTrees(), est.getSeed() % 2**63, est.getSubsamplingRate(), est.getBootstrap()
    strategy = est.getFeatureSubsetStrategy()
    strategy = ("sqrt" if trees > 1 else "all") if strategy == "auto" else strategy
    how = dict(
        classes=classes, sizes=[len(s) + 1 for s in splits], share=SHARES[strategy](len(splits)), depth=est.getMaxDepth(),
        impurity=est.getImpurity(), least_rows=est.getMinInstancesPerNode(), least_gain=est.getMinInfoGain(),
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in (t for batch in batches for t in batch.column("id").to_pylist()):
            bins, label, n = sent.value
            rng = np.random.default_rng([seed, tree])
            drawn = rng.poisson(rate * n) if bagged else rng.binomial(n, rate)
            nodes = grow(bins, label, drawn, rng, **how)
            threshold = np.zeros(len(nodes["feature"]))
            for k, cuts in enumerate(splits):
                mine = nodes["feature"] == k
                threshold[mine] = cuts[nodes["at"][mine]]
            whole = {c: pa.array(nodes[c], pa.int32()) for c in ("id", "left", "right", "feature")}
            whole |= {c: pa.array(nodes[c], pa.float64()) for c in ("prediction", "impurity", "gain")}
            whole |= {"tree": pa.array(np.full(len(threshold), tree), pa.int32()), "threshold": pa.array(threshold), "n": pa.array(nodes["stats"].sum(axis=1).astype(np.int64))}
            whole["stats"] = as_lists(nodes["stats"])
            yield pa.RecordBatch.from_pydict({c: whole[c] for c in names})

    names = ["tree", "id", "prediction", "impurity", "stats", "n", "gain", "left", "right", "feature", "threshold"]
    schema = ("tree int, id int, prediction double, impurity double, stats array<double>, n long, gain double, left int, right int, "
              "feature int, threshold double")
    split = F.struct(
        F.col("feature").alias("featureIndex"),
        F.when(F.col("feature") >= 0, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    return spark.range(0, trees, 1, trees).mapInArrow(build, schema).select(
        F.col("tree").alias("treeID"),
        F.struct("id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("n").alias("rawCount"), "gain",
                 F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split")).alias("nodeData"),
    )


def impurities(stats: np.ndarray, kind: str) -> np.ndarray:
    """Gini impurity or entropy of the class counts along the last axis; 0 without rows."""
    total = stats.sum(axis=-1, keepdims=True)
    share = stats / np.maximum(total, 1)
    if kind == "gini":
        return np.where(total[..., 0] > 0, 1 - (share**2).sum(axis=-1), 0.0)
    return -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=-1)


def grow(
    bins: Sequence[np.ndarray], label: np.ndarray, weight: np.ndarray, rng: np.random.Generator, classes: int, sizes: Sequence[int],
    share: int, depth: int, impurity: str = "gini", least_rows: int = 1, least_gain: float = 0.0,
) -> dict[str, np.ndarray]:
    """Nodes of one tree, level by level, by MLlib's rules; every node may split on ``share`` columns drawn for it.

    ``bins`` holds an array per column with ``sizes`` bins. A node ends if it is pure, at ``depth`` or if no split gains. Leaves of one
    parent with the same prediction are merged.
    """
    rows = np.flatnonzero(weight)
    slot = np.zeros(len(rows), dtype=np.int64)
    levels, made, nodes = [], 1, 1  # nodes of the level, and of all levels
    for level in range(depth + 1):
        stats = np.bincount(slot * classes + label[rows], weight[rows], nodes * classes).reshape(nodes, classes)
        here = {"stats": stats, "impurity": impurities(stats, impurity), "gain": np.full(nodes, -1.0)}
        here |= {c: np.full(nodes, -1) for c in ("feature", "at", "left", "right")}
        levels.append(here)
        open_ = (here["impurity"] > 1e-15) & (level < depth)
        if not open_.any():
            break
        rows, slot = rows[open_[slot]], slot[open_[slot]]
        drawn = np.zeros((nodes, len(sizes)), dtype=bool)
        ways = rng.random((int(open_.sum()), len(sizes))).argsort(axis=1)[:, :share]
        drawn[np.flatnonzero(open_)[:, None], ways] = True
        for k in (k for k, size in enumerate(sizes) if size > 1):
            _best_splits(here, k, drawn[:, k], bins[k], sizes[k], label, weight, rows, slot, classes, impurity, least_rows, least_gain)
        splits = here["feature"] >= 0
        if not splits.any():
            break
        rank = np.cumsum(splits) - 1
        here["left"][splits] = made + 2 * rank[splits]
        here["right"][splits] = made + 2 * rank[splits] + 1
        rows, slot = rows[splits[slot]], slot[splits[slot]]
        right = np.zeros(len(rows), dtype=bool)
        for k in range(len(sizes)):
            mine = here["feature"][slot] == k
            right[mine] = bins[k][rows[mine]] > here["at"][slot[mine]]
        slot = 2 * rank[slot] + right
        order = np.argsort(slot, kind="stable")
        rows, slot = rows[order], slot[order]
        nodes = 2 * int(splits.sum())
        made += nodes
    return _pruned({c: np.concatenate([h[c] for h in levels]) for c in levels[0]}, [len(h["gain"]) for h in levels])


def _best_splits(here, k, drawn, column, size, label, weight, rows, slot, classes, impurity, least_rows, least_gain) -> None:
    """Takes up splits on column ``k`` that gain more than the best so far; ``rows`` lie in the order of their nodes."""
    mine = drawn[slot]
    rows, slot = rows[mine], slot[mine]
    asked = np.flatnonzero(drawn)
    for start in range(0, len(asked), NODES_AT_ONCE):
        some = asked[start:start + NODES_AT_ONCE]
        low, high = np.searchsorted(slot, [some[0], some[-1] + 1])
        part, at = rows[low:high], np.searchsorted(some, slot[low:high])
        held = np.bincount((at * size + column[part]) * classes + label[part], weight[part], len(some) * size * classes)
        left = held.reshape(len(some), size, classes).cumsum(axis=1)
        left, whole = left[:, :-1], left[:, -1:]
        right = whole - left
        n, m, total = left.sum(axis=2), right.sum(axis=2), whole.sum(axis=2)
        gain = here["impurity"][some, None] - (n * impurities(left, impurity) + m * impurities(right, impurity)) / total
        gain[(n < least_rows) | (m < least_rows) | (gain < least_gain)] = -np.inf
        at = gain.argmax(axis=1)
        best = gain[np.arange(len(some)), at]
        better = (best > 1e-15) & (best > here["gain"][some])
        here["gain"][some[better]], here["at"][some[better]], here["feature"][some[better]] = best[better], at[better], k


def _pruned(nodes: dict[str, np.ndarray], sizes: Sequence[int]) -> dict[str, np.ndarray]:
    """The tree with leaves of the same prediction merged; a node's number is lower than its children's."""
    nodes["prediction"] = nodes["stats"].argmax(axis=1).astype(float)
    ends = np.cumsum(sizes)
    spans = [np.arange(end - size, end) for size, end in zip(sizes, ends)]
    for span in reversed(spans):
        inner = span[nodes["left"][span] >= 0]
        a, b = nodes["left"][inner], nodes["right"][inner]
        same = (nodes["left"][a] < 0) & (nodes["left"][b] < 0) & (nodes["prediction"][a] == nodes["prediction"][b])
        for c in ("left", "right", "feature"):
            nodes[c][inner[same]] = -1
        nodes["gain"][inner[same]] = -1.0
    kept = np.zeros(ends[-1], dtype=bool)
    kept[0] = True
    for span in spans:
        inner = span[kept[span] & (nodes["left"][span] >= 0)]
        kept[nodes["left"][inner]] = kept[nodes["right"][inner]] = True
    number = np.cumsum(kept) - 1
    inner = nodes["left"] >= 0
    for c in ("left", "right"):
        nodes[c][inner] = number[nodes[c][inner]]
    return {"id": number[kept], **{c: v[kept] for c, v in nodes.items()}}


def _as_model(est: RandomForestClassifier, nodes: DataFrame, columns: int, classes: int) -> Model:
    """A model as MLlib reads it: one of its own with as many trees, columns and classes is written and its nodes are replaced."""
    spark: SparkSession = nodes.sparkSession
    path = f"{shared_dir(spark)}/forest-{uuid.uuid4().hex}"
    shape = spark.createDataFrame([(float(c), Vectors.dense([0.0] * columns)) for c in range(classes)], ["label", "features"])
    est.fit(shape).save(path)
    nodes.write.mode("overwrite").parquet(f"{path}/data")
    model = RandomForestClassificationModel.load(path)
    model.__class__ = GrownForest  # a second wrapper of the same object would lose it with the first
    model.packed = spark.sparkContext.broadcast(_packed(spark.read.parquet(f"{path}/data")))
    return model


class GrownForest(RandomForestClassificationModel):
    """MLlib's model, whose rows are scored a batch at a time on nodes packed into arrays: as objects, the nodes of many deep trees
    lie all over the memory and a row takes ten times as long."""

    packed = None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.getLeafCol() or self.isSet(self.thresholds):
            return super()._transform(dataset)
        packed = self.packed

        @F.arrow_udf("array<double>")
        def raw(x: pa.Array) -> pa.Array:
            return as_lists(votes(packed.value, x.flatten().to_numpy().reshape(len(x), -1)))

        out = dataset.withColumn(self.getRawPredictionCol(), raw(vector_to_array(self.getFeaturesCol())))
        given = F.col(self.getRawPredictionCol())
        total = F.aggregate(given, F.lit(0.0), lambda a, b: a + b)
        share = F.transform(given, lambda v: F.when(total > 0, v / total).otherwise(v))
        best = (F.array_position(given, F.array_max(given)) - 1).cast("double")
        out = out.withColumn(self.getProbabilityCol(), array_to_vector(share)).withColumn(self.getPredictionCol(), best)
        return out.withColumn(self.getRawPredictionCol(), array_to_vector(given))


def as_lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))


def _packed(nodes: DataFrame) -> tuple[np.ndarray, ...]:
    """Roots of the trees; column, threshold, left child (the right one is next to it) and shares of the classes per node."""
    found = nodes.select(
        "treeID", "nodeData.id", "nodeData.leftChild", "nodeData.split.featureIndex",
        F.coalesce(F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)), F.lit(0.0)).alias("threshold"), "nodeData.impurityStats",
    ).toArrow()
    tree, number, left, feature, threshold = (found.column(c).to_numpy() for c in found.column_names[:5])
    stats = found.column("impurityStats").combine_chunks().flatten().to_numpy().reshape(len(tree), -1)
    order = np.lexsort((number, tree))
    roots = np.flatnonzero(number[order] == 0).astype(np.int32)
    left = np.where(left[order] >= 0, left[order] + roots[tree[order]], -1).astype(np.int32)
    shares = stats[order] / np.maximum(stats[order].sum(axis=1, keepdims=True), 1)
    return roots, np.maximum(feature[order], 0).astype(np.int32), threshold[order], left, shares


def votes(packed: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """Shares of the classes in the leaves that every row reaches, added up over the trees in their order."""
    roots, feature, threshold, left, shares = packed
    n, columns = x.shape
    out, flat = np.zeros((n, shares.shape[1])), x.ravel()
    several = max(1, PATHS_AT_ONCE // max(1, n))
    for start in range(0, len(roots), several):
        some = roots[start:start + several]
        leaf = np.repeat(some, n)
        path = np.flatnonzero(left[leaf] >= 0)
        node, row = leaf[path], (path % max(1, n)) * columns
        while len(path):
            node = left[node] + np.logical_not(flat[row + feature[node]] <= threshold[node])
            goes = left[node] >= 0
            leaf[path[~goes]] = node[~goes]
            path, node, row = path[goes], node[goes], row[goes]
        for k in range(len(some)):
            out += shares[leaf[k * n:(k + 1) * n]]
    return out
