"""Feed-forward networks on rows packed into blocks: one job per evaluation of loss and gradient.

The gradient, as long as the weights, is all that reaches the driver; the packed rows are cached on the cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.functions.scalars import exact_sum
from abacist.operators.models import complete, deal_more

CORRECTIONS, MEMORY = 10, 20
"""Steps that shape a direction, and values the last one is compared with."""
Loss = Callable[[np.ndarray], tuple[float, np.ndarray]]


def packed(rows: DataFrame) -> DataFrame:
    """Blocks ``(x, y)`` of the rows of an Arrow batch: features and labels as doubles."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = batch.column("x").flatten().to_numpy(), batch.column("y").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_pydict({"x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary())})

    known = rows.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"))
    return known.mapInArrow(pack, "x binary, y binary")


def loss_sums(layers: Sequence[int], weights: np.ndarray, x: np.ndarray, y: np.ndarray, chunk: int = 2_000) -> np.ndarray:
    """Rows, cross entropy and its gradient, added up; weights lie as in MLlib, a layer's matrix by inputs and then its bias."""
    parts, at = [], 0
    for a, b in zip(layers, layers[1:]):
        parts.append((np.ascontiguousarray(weights[at:at + a * b].reshape(a, b).T), weights[at + a * b:at + a * b + b, None]))
        at += a * b + b
    loss, slopes = 0.0, [(np.zeros_like(w), np.zeros(len(w))) for w, _ in parts]
    columns = np.ascontiguousarray(x.T)
    for start in range(0, len(y), chunk):
        outs, label = [columns[:, start:start + chunk]], y[start:start + chunk].astype(int)
        each = np.arange(len(label))
        for k, (w, v) in enumerate(parts):
            z = w @ outs[-1]
            z += v
            if k < len(parts) - 1:
                np.negative(z, out=z)
                with np.errstate(over="ignore"):
                    np.exp(z, out=z)
                z += 1
                np.reciprocal(z, out=z)
            outs.append(z)
        z = outs[-1] - outs[-1].max(axis=0)
        delta = np.exp(z)
        total = delta.sum(axis=0)
        loss += float(np.log(total).sum() - z[label, each].sum())
        delta /= total
        delta[label, each] -= 1
        for k in range(len(parts) - 1, -1, -1):
            slopes[k][0][...] += delta @ outs[k].T
            slopes[k][1][...] += delta.sum(axis=1)
            if k:
                delta = parts[k][0].T @ delta
                delta *= outs[k]
                delta *= 1 - outs[k]
    return np.concatenate([[len(y), loss], *[np.concatenate([w.T.ravel(), v]) for w, v in slopes]])


def mean_loss(blocks: DataFrame, layers: Sequence[int]) -> Loss:
    """Mean cross entropy over all rows and its gradient at given weights, a job per call."""
    layers = list(layers)

    def at(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(2 + len(weights))
            for batch in batches:
                for x, y in zip(batch.column("x"), batch.column("y")):
                    x, y = np.frombuffer(x.as_buffer()).reshape(-1, layers[0]), np.frombuffer(y.as_buffer())
                    sums += loss_sums(layers, weights, x, y)
            yield pa.RecordBatch.from_pydict({"slot": pa.array(np.arange(len(sums)), pa.int32()), "s": pa.array(sums)})

        found = blocks.mapInArrow(partial, "slot int, s double").groupBy("slot").agg(exact_sum("s").alias("s")).collect()
        sums = np.zeros(2 + len(weights))
        for r in found:
            sums[r["slot"]] = r["s"]
        if not sums[0]:
            raise ValueError("no rows to fit on")
        return sums[1] / sums[0], sums[2:] / sums[0]

    return at


def line_search(loss: Loss, x: np.ndarray, value: float, grad: np.ndarray, move: np.ndarray, first: float, tries: int = 10):
    """(x, value, gradient) at a step that meets the strong Wolfe conditions; None if none is found."""
    slope = grad @ move
    if slope > 0:
        return None

    def at(t: float):
        v, g = loss(x + t * move)
        return t, v, float(g @ move), g

    def between(a, b) -> float:
        (l, lv, ld, _), (r, rv, rd, _) = sorted((a, b), key=lambda p: p[0])
        d1 = ld + rd - 3 * (lv - rv) / (l - r)
        root = np.sqrt(max(d1 * d1 - ld * rd, 0.0))
        below = rd - ld + 2 * root
        t = r - (r - l) * (rd + root - d1) / below if below else (l + r) / 2
        return min(max(t, l + 0.1 * (r - l)), l + 0.9 * (r - l))

    low, high, t = (0.0, value, slope, grad), None, first
    for i in range(2 * tries):
        if high is None and i >= tries:
            return None
        c = at(t if high is None else between(low, high))
        if not np.isfinite(c[1]):
            if high is not None:
                return None
            t /= 2
            continue
        if c[1] > value + 1e-4 * c[0] * slope or (c[1] >= low[1] and (i > 0 or high is not None)):
            high = c
        elif abs(c[2]) <= 0.9 * abs(slope):
            return x + c[0] * move, c[1], c[3]
        elif high is None and c[2] < 0:
            low, t = c, 1.5 * t
        elif high is None:
            low, high = c, low
        else:
            low, high = c, (low if c[2] * (high[0] - low[0]) >= 0 else high)
    return None


def descend(loss: Loss, x: np.ndarray, rounds: int, tolerance: float) -> np.ndarray:
    """Limited-memory quasi-Newton descent with MLlib's settings: at most ``rounds`` steps, fewer once values or gradients settle."""
    value, grad = loss(x)
    start, seen, memory, failed = abs(value), [value], [], False
    done = 0
    while done < rounds and np.linalg.norm(grad) > max(tolerance * abs(value), 1e-8):
        move, shares = grad.copy(), []
        for s, d in memory:
            shares.append(s @ move / (s @ d))
            move -= shares[-1] * d
        if memory:
            s, d = memory[0]
            move *= (s @ d) / (d @ d)
        for (s, d), share in zip(reversed(memory), reversed(shares)):
            move += (share - d @ move / (s @ d)) * s
        move = -move
        found = line_search(loss, x, value, grad, move, 1.0 if done else 1 / np.linalg.norm(move))
        if found is None:
            if failed or not memory:
                break
            memory, failed = [], True
            continue
        failed, done = False, done + 1
        if (found[0] - x) @ (found[2] - grad) > 0:
            memory = [(found[0] - x, found[2] - grad), *memory][:CORRECTIONS]
        x, value, grad = found
        seen = [*seen, value][-MEMORY:]
        if abs(max(seen) - value) <= tolerance * start:
            break
    return x


def fit_network(est: MultilayerPerceptronClassifier, rows: DataFrame) -> Model:
    """The network of an MLlib estimator with its solver ``l-bfgs``, starting weights and limits; every row weighs the same."""
    if est.getSolver() != "l-bfgs":
        raise ValueError("only the solver l-bfgs")
    layers = est.getLayers()
    shape = rows.sparkSession.createDataFrame(
        [(float(k), Vectors.dense([0.0] * layers[0])) for k in range(layers[-1])], ["label", "features"])
    unmoved = est.copy({est.maxIter: 0})
    first = unmoved.fit(shape).weights.toArray()
    blocks = packed(complete(deal_more(rows.select("label", "features")))).cache()
    try:
        last = descend(mean_loss(blocks, layers), first, est.getMaxIter(), est.getTol())
    finally:
        blocks.unpersist()
    return unmoved.copy({unmoved.initialWeights: Vectors.dense(last)}).fit(shape)
