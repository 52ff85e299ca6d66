"""Quality classifier: ridge regression on random Fourier features, calibrated by isotonic regression.

Statistics of a document's text are standardised and mapped to cosines whose inner products approximate
a Gaussian kernel. Each partition adds up its part of the normal equations, the parts are summed per row
of the matrix, and the driver solves one system of ``FEATURES`` unknowns. Raw scores are then calibrated:
training scores are counted in ``BINS`` cells, and pooling adjacent violators over the cells makes
the share of good documents monotone in the score. All labelled rows outside the held-out fold are
used; labels, language, source and id are no inputs of a score.

Defined cases: null text counts as empty and is scored; a document without id is not held out and has no
label; several labels of one id all count; without any labelled row of both kinds every score is the
share of good rows, or 1 if there is none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.llm.common import SLICE, per_batch
from abacist.session import materialise

FEATURES = 192
RIDGE = 1.0
KERNEL_WIDTH = 3.0
BINS = 1000
THRESHOLD = 0.7
SEED = 7

NAMES = ["chars", "words", "word_length", "distinct", "upper", "digit", "mark", "stop", "lines", "same_lines", "pairs", "other"]
UPPER, DIGIT, MARK, STOP, LINE, SPACE = range(1, 7)
# Classes of single bytes: capital letters, digits, decoration, sentence marks, line ends, blanks.
CLASS = np.zeros(256, "u1")
for kind, members in ((UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (DIGIT, b"0123456789"), (MARK, b"!#$%&*+/<=>@[]^_`{|}~\\"),
                      (STOP, b".,;:?'\"()-"), (LINE, b"\n"), (SPACE, b" \t\r\v\f")):
    CLASS[list(members)] = kind


def statistics(text: str | None) -> list[float]:
    """What a score may depend on."""
    text = text or ""
    data = np.frombuffer(text.encode(), "u1")
    counts = np.bincount(CLASS[data], minlength=7)
    n = max(1, len(data))
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:])))
    return [
        np.log1p(len(data)), np.log1p(len(words)), np.log1p(len(data) / max(1, len(words))), distinct / max(1, len(words)),
        counts[UPPER] / n, counts[DIGIT] / n, np.sqrt(counts[MARK] / n), counts[STOP] / n, np.log1p(len(lines)),
        1 - len(set(lines)) / max(1, len(lines)), pairs / max(1, len(words) - 1), np.sqrt(counts[MARK] / max(1, len(words))),
    ]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    shares: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2 / len(self.phases)) * np.cos(scaled @ self.directions + self.phases)
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.steps, self.shares), 0, 1)


def with_statistics(documents: DataFrame) -> DataFrame:
    """The documents' columns and ``__stats``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(__stats=[statistics(t) for t in batch["text"]])

    return per_batch(documents, run, f"{fields}, __stats array<double>")


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float) if len(column) else np.zeros((0, len(NAMES)))


def normal_equations(rows: DataFrame, model: Model) -> np.ndarray:
    """Sum over all rows of z z' and z y: added up per partition, then per row of the matrix."""

    def partial(batches):
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = model.features(stacked(batch["__stats"]))
            total += z.T @ np.hstack([z, batch["y"].to_numpy(float)[:, None]])
        yield pd.DataFrame({"i": np.arange(len(total)), "sums": list(total)})

    def add(key, parts: pd.DataFrame) -> pd.DataFrame:
        sums = np.sort(np.stack(parts["sums"].to_numpy()), axis=0).sum(axis=0)  # the order of the parts is not fixed
        return pd.DataFrame({"i": [key[0]], "sums": [sums]})

    parts = rows.select("__stats", "y").mapInPandas(partial, "i int, sums array<double>")
    summed = parts.groupBy("i").applyInPandas(add, "i int, sums array<double>").orderBy("i").collect()
    return np.array([r.sums for r in summed]).reshape(-1, FEATURES + 2)


def isotonic(cells: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (score, rows, good rows), ascending: scores and shares to interpolate."""
    blocks: list[list[float]] = []
    for score, n, good in cells:
        blocks.append([score, score, n, good])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            _, end, n2, good2 = blocks.pop()
            blocks[-1] = [blocks[-1][0], end, blocks[-1][2] + n2, blocks[-1][3] + good2]
    steps = [x for low, high, _, _ in blocks for x in ([low, high] if high > low else [low])]
    shares = [good / n for low, high, n, good in blocks for _ in range(2 if high > low else 1)]
    return np.array(steps), np.array(shares)


def fit(rows: DataFrame) -> Model:
    """Fit on rows with ``__stats`` and ``y``; they are read three times."""
    stats = [F.col("__stats")[i] for i in range(len(NAMES))]
    sums = rows.agg(F.count("y").alias("n"), F.sum("y").alias("good"), *[F.avg(s).alias(f"m{i}") for i, s in enumerate(stats)],
                    *[F.stddev_pop(s).alias(f"s{i}") for i, s in enumerate(stats)]).first()
    rng = np.random.default_rng(SEED)
    directions = rng.normal(size=(len(NAMES), FEATURES)) / KERNEL_WIDTH
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    mean = np.array([sums[f"m{i}"] or 0.0 for i in range(len(NAMES))])
    scale = np.array([max(sums[f"s{i}"] or 0.0, 1e-9) for i in range(len(NAMES))])
    blank = np.zeros(FEATURES + 1)
    share = sums["good"] / sums["n"] if sums["n"] else 1.0
    model = Model(mean, scale, directions, phases, blank, np.array([0.0]), np.array([share]))
    if share in (0.0, 1.0):
        return model
    total = normal_equations(rows, model)
    weights = np.linalg.solve(total[:, :-1] + RIDGE * np.eye(FEATURES + 1), total[:, -1])
    model = Model(mean, scale, directions, phases, weights, np.array([0.0]), np.array([share]))

    def cells(batch: pd.DataFrame) -> pd.DataFrame:
        cell = np.clip(np.rint(model.raw(stacked(batch["__stats"])) * BINS), -BINS, 2 * BINS).astype(int)
        return pd.DataFrame({"cell": cell, "y": batch["y"]})

    counted = per_batch(rows.select("__stats", "y"), cells, "cell long, y long").groupBy("cell").agg(
        F.count("y").alias("n"), F.sum("y").alias("good")).orderBy("cell").collect()
    steps, shares = isotonic([(r.cell / BINS, r.n, r.good) for r in counted])
    return Model(mean, scale, directions, phases, weights, steps, shares)


def score(measured: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Replace ``__stats`` by ``score`` and ``predicted``."""
    kept = [f for f in measured.schema if f.name not in ("__stats", "score", "predicted")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        values = model.score(stacked(batch["__stats"]))
        return batch[[f.name for f in kept]].assign(score=values, predicted=(values >= threshold).astype("i4"))

    return per_batch(measured, run, f"{fields}, score double, predicted int")


def training_rows(measured: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").alias("__id"), F.col("quality").cast("long").alias("y"))
    return measured.where(~F.col("held_out")).join(known, F.col("doc_id") == F.col("__id")).select("__stats", "y")


def scored(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    measured = with_statistics(documents.select("doc_id", "text")).select("doc_id", "__stats")
    measured = materialise(measured.withColumn("held_out", held_out(F.col("doc_id"))))
    training = materialise(training_rows(measured, labels))
    return score(measured, fit(training), threshold)


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, unchanged."""
    narrow = documents.select("doc_id", "text")
    measured = with_statistics(narrow).select("doc_id", "__stats").withColumn("held_out", held_out(F.col("doc_id")))
    training = materialise(training_rows(measured, labels))
    model = fit(training)

    @F.arrow_udf("double")
    def score_of(texts: pa.Array) -> pa.Array:
        parts = [texts.slice(i, SLICE).to_pylist() for i in range(0, len(texts), SLICE)]
        scores = [model.score(np.array([statistics(t) for t in part])) for part in parts]
        return pa.array(np.concatenate([np.zeros(0), *scores]))

    return documents.where(score_of("text") >= threshold)
