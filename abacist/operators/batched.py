"""Many fits in one job: logistic candidates by shared Newton rounds, elastic nets over folds from moments of one scan.

What reaches the driver is bounded by the number of columns, folds and candidates: a gradient and a Hessian block per
candidate, a matrix of moments per fold. Rows never do.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.functions.scalars import exact_sum, safe_divide
from abacist.operators.ordered import Running, running
from abacist.operators.sampling import hash_number
from abacist.session import materialise

ROUNDS, TOLERANCE = 60, 1e-13
"""Newton rounds at most, and the gain of the mean log-likelihood at which a fit is done."""


@dataclass
class Logit:
    """One logistic regression on some of the columns; coefficients belong to the columns as they are."""

    columns: tuple[str, ...]
    beta: np.ndarray
    step: np.ndarray
    share: float = 1.0
    value: float = -np.inf
    done: bool = False
    coefficients: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0
    l1: np.ndarray | float = 0.0
    l2: np.ndarray | float = 0.0
    held_out: int | None = None

    def penalty(self, beta: np.ndarray) -> float:
        """Penalty per row: ``l1`` and ``l2`` weigh the coefficients, the intercept is free."""
        return float(np.sum(self.l1 * np.abs(beta[1:])) + np.sum(self.l2 * beta[1:] ** 2) / 2)

    def margin(self) -> Column:
        out = F.lit(self.intercept)
        for name, value in self.coefficients.items():
            out = out + F.lit(value) * F.col(name).cast("double")
        return out

    def take(self, sums: np.ndarray, n: int) -> None:
        """Go on from the sums at the tried coefficients: value, gradient and Hessian."""
        size = len(self.beta)
        value, gradient, hessian = sums[0] - n * self.penalty(self.tried()), sums[1:size + 1], sums[size + 1:].reshape(size, size)
        if value < self.value - TOLERANCE * n:  # too far: half the step
            self.share /= 2
            self.done = self.share < 1e-6
            return
        self.beta = self.tried()
        self.step, self.share, self.value = self.newton_step(gradient, hessian, n), 1.0, value
        gain = gradient @ self.step - n * (self.penalty(self.beta + self.step) - self.penalty(self.beta))
        self.done = bool(gain < TOLERANCE * n)

    def newton_step(self, gradient: np.ndarray, hessian: np.ndarray, n: int) -> np.ndarray:
        """Step to the best point of the quadratic approximation less the penalty, by coordinates where that has corners."""
        l1, l2 = (np.append(0.0, np.broadcast_to(v, len(self.beta) - 1)) * n for v in (self.l1, self.l2))
        hessian = hessian + np.diag(l2)
        gradient = gradient - l2 * self.beta
        if not l1.any():
            return np.linalg.lstsq(hessian, gradient, rcond=1e-12)[0]
        step = np.zeros(len(self.beta))
        for _ in range(10_000):
            before = step.copy()
            for j in np.flatnonzero(np.diag(hessian)):
                at = hessian[j, j] * (self.beta[j] + step[j]) + gradient[j] - hessian[j] @ step
                step[j] = np.sign(at) * max(abs(at) - l1[j], 0.0) / hessian[j, j] - self.beta[j]
            if np.abs(step - before).max() < 1e-13:
                break
        return step

    def tried(self) -> np.ndarray:
        return self.beta + self.share * self.step


def likelihood_sums(z: np.ndarray, y: np.ndarray, betas: np.ndarray, chunk: int = 2_000) -> np.ndarray:
    """Log-likelihood, gradient and Hessian of each row of ``betas``; ``z`` holds a row per column, read in chunks that stay in cache."""
    size = len(z)
    i, j = np.triu_indices(size)
    value, gradient, upper = np.zeros(len(betas)), np.zeros(betas.shape), np.zeros((len(betas), len(i)))
    for start in range(0, len(y), chunk):
        zs, ys = z[:, start:start + chunk], y[start:start + chunk]
        margin = betas @ zs
        small = np.exp(-np.abs(margin))
        p = np.where(margin >= 0, 1.0, small) / (1 + small)
        value += margin @ ys - (np.maximum(margin, 0) + np.log1p(small)).sum(axis=1)
        gradient += (ys - p) @ zs.T
        upper += (p * (1 - p)) @ (zs[i] * zs[j]).T
    hessian = np.zeros((len(betas), size, size))
    hessian[:, i, j] = hessian[:, j, i] = upper
    return np.hstack([value[:, None], gradient, hessian.reshape(len(betas), -1)])


def newton_sums(rows: DataFrame, columns: list[str], fits: list[Logit], mean: np.ndarray, scale: np.ndarray) -> dict[int, np.ndarray]:
    """Log-likelihood, gradient and Hessian of every fit at its tried coefficients, in one job.

    A fit with a fold held out leaves out its rows; the rows then name their ``fold``.
    """
    tasks = [(k, (0, *[1 + columns.index(c) for c in f.columns]), f.held_out, f.tried()) for k, f in enumerate(fits) if not f.done]
    folded = any(out is not None for _, _, out, _ in tasks)

    def partial(batches):
        totals = {k: np.zeros(1 + len(b) + len(b) ** 2) for k, _, _, b in tasks}
        for batch in batches:
            x = batch[columns].to_numpy(float)
            y = batch["label"].to_numpy(float)
            if not (np.isfinite(x).all() and np.isfinite(y).all()):
                raise ValueError("missing values in the features or the label: impute them, or only score such rows")
            z = np.vstack([np.ones(len(x)), ((x - mean) / scale).T])
            fold = batch["fold"].to_numpy() if folded else np.zeros(len(x))
            for here in np.unique(fold):
                mine = fold == here
                z_here, y_here = (z[:, mine], y[mine]) if folded else (z, y)
                same: dict[tuple, list] = {}
                for k, at, out, beta in tasks:
                    if out is None or out != here:
                        same.setdefault(at, []).append((k, beta))
                for at, group in same.items():
                    for (k, _), sums in zip(group, likelihood_sums(z_here[list(at)], y_here, np.array([b for _, b in group]))):
                        totals[k] += sums
        for k, total in totals.items():
            yield pd.DataFrame({"fit": k, "slot": np.arange(len(total)), "x": total})

    parts = rows.mapInPandas(partial, "fit int, slot int, x double").groupBy("fit", "slot").agg(exact_sum("x").alias("x"))
    out: dict[int, np.ndarray] = {k: np.zeros(1 + len(b) + len(b) ** 2) for k, _, _, b in tasks}
    for r in parts.collect():
        out[r["fit"]][r["slot"]] = r["x"]
    return out


def logistic_fits(rows: DataFrame, label: str, sets: Sequence[Sequence[str]]) -> list[Logit]:
    """A logistic regression without penalty for every set of columns, all in one job per Newton round."""
    columns = sorted({c for s in sets for c in s})
    rows = materialise(rows.select(F.col(label).cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in columns]))
    return newton_fits(rows, "label", sets)


def newton_fits(rows: DataFrame, label: str, sets: Sequence[Sequence[str]], start: Logit | None = None) -> list[Logit]:
    """``logistic_fits`` on a written table; ``start`` is a fit on the same rows whose columns lead every set."""
    columns = sorted({c for s in sets for c in s})
    rows = rows.select(F.col(label).cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in columns])
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{c}") for c in columns],
                     *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    if not sizes["n"]:
        raise ValueError("no rows to fit on")
    mean = np.array([sizes[f"m_{c}"] or 0.0 for c in columns])
    scale = np.array([sizes[f"s_{c}"] or 1.0 for c in columns])
    first = start.beta if start else np.zeros(1)
    fits = [Logit(tuple(s), np.append(first, np.zeros(len(s) + 1 - len(first))), np.zeros(len(s) + 1)) for s in sets]
    return newton_rounds(rows, columns, fits, mean, scale, [sizes["n"]] * len(fits))


def newton_rounds(rows: DataFrame, columns: list[str], fits: list[Logit], mean: np.ndarray, scale: np.ndarray, n: Sequence[int]) -> list[Logit]:
    """The fits brought to their end, one job per round for all; ``n`` holds the rows that each learns on."""
    for _ in range(ROUNDS):
        if all(f.done for f in fits):
            break
        for k, sums in newton_sums(rows, columns, fits, mean, scale).items():
            fits[k].take(sums, n[k])
    for f in fits:
        at = [columns.index(c) for c in f.columns]
        f.coefficients = dict(zip(f.columns, (f.beta[1:] / scale[at]).tolist()))
        f.intercept = float(f.beta[0] - (f.beta[1:] * mean[at] / scale[at]).sum())
    return fits


def fold_fits(rows: DataFrame, columns: Sequence[str], folds: int, grid: Sequence[tuple[float, float]]) -> list[Logit]:
    """A logistic regression per fold left out and (reg, elastic) of the grid, in that order, on a written table with ``label`` and ``fold``.

    The penalty weighs coefficients of columns that are standardised over the rows of their fit, as in MLlib. All fits share one job per round.
    """
    columns = list(columns)
    rest = [F.col("fold") != k for k in range(folds)]
    seen = rows.agg(
        *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))],
        *[F.count_if(r).alias(f"n{k}") for k, r in enumerate(rest)],
        *[F.stddev_samp(F.when(r, F.col(c))).alias(f"s{k}_{c}") for k, r in enumerate(rest) for c in columns],
    ).first()
    if not any(seen[f"n{k}"] for k in range(folds)):
        raise ValueError("no rows to fit on")
    mean = np.array([seen[f"m_{c}"] or 0.0 for c in columns])
    scale = np.array([seen[f"s_{c}"] or 1.0 for c in columns])
    fits, sizes = [], []
    for k in range(folds):
        live = [c for c in columns if seen[f"s{k}_{c}"]]
        spread = np.array([seen[f"s{k}_{c}"] / scale[columns.index(c)] for c in live])
        for reg, elastic in grid:
            fits.append(Logit(tuple(live), np.zeros(len(live) + 1), np.zeros(len(live) + 1), held_out=k,
                              l1=reg * elastic * spread, l2=reg * (1 - elastic) * spread ** 2))
            sizes.append(seen[f"n{k}"])
    return newton_rounds(rows, columns, fits, mean, scale, sizes)


def logistic_grid_folds(rows: DataFrame, features: Sequence[str], label: str, regs: Sequence[float], elastics: Sequence[float],
                        folds: int = 3, seed: int = 42) -> DataFrame:
    """(params, metric): mean area under ROC over the folds of every grid point; folds whose area is undefined are left out.

    Rows are drawn into folds as MLlib's cross validator draws them. Neither folds nor grid points add passes.
    """
    drawn = rows.select(F.col(label).cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in features], F.rand(seed).alias("draw"))
    drawn = materialise(drawn.withColumn("fold", F.least(F.floor(F.col("draw") * folds).cast("int"), F.lit(folds - 1))).drop("draw"))
    grid = [(float(reg), float(elastic)) for reg in regs for elastic in elastics]
    once = list(dict.fromkeys((reg, elastic if reg else 0.0) for reg, elastic in grid))  # without penalty all shares are one fit
    fits = fold_fits(drawn, features, folds, once)
    found = np.array(areas(drawn, "label", fits)).reshape(folds, len(once))
    out = []
    for reg, elastic in grid:
        auc = found[:, once.index((reg, elastic if reg else 0.0))]
        known = auc[~np.isnan(auc)]
        out.append((f"elasticNetParam={elastic}, regParam={reg}", float(known.mean()) if len(known) else None))
    return rows.sparkSession.createDataFrame(out, "params string, metric double")


def areas(rows: DataFrame, label: str, fits: Sequence[Logit], **how) -> list[float]:
    """Area under the ROC curve of every fit, from counts per fit and distinct margin; equal margins share their rank.

    A fit with a fold held out is judged on the rows of that fold.
    """
    held: dict[int | None, list] = {}
    for k, f in enumerate(fits):
        held.setdefault(f.held_out, []).append(F.struct(F.lit(k).alias("fit"), f.margin().alias("score")))
    margins = F.array(*held.pop(None, []))
    for fold, own in held.items():
        margins = F.when(F.col("fold") == fold, F.array(*own)).otherwise(margins) if fold is not None else margins
    scored = rows.select(F.col(label).cast("int").alias("label"), F.explode(margins).alias("m")).select("label", "m.fit", "m.score")
    counts = materialise(scored.groupBy("fit", "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")))
    ranked = running(counts, ["fit"], ["score"], [Running("below", "sum", F.col("neg"), exclusive=True)], **how)
    won = F.sum(F.col("pos") * (2 * F.coalesce("below", F.lit(0)) + F.col("neg")))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    found = {r["fit"]: r["auc"] for r in ranked.groupBy("fit").agg(safe_divide(won.cast("double") / 2, pairs).alias("auc")).collect()}
    return [found.get(k) if found.get(k) is not None else float("nan") for k in range(len(fits))]


SLOTS = 16_384
"""Intervals of the margin in which candidates are compared before any exact area is computed."""


def area_bounds(rows: DataFrame, label: str, fits: Sequence[Logit]) -> list[tuple[float, float]]:
    """Least and greatest possible area under the ROC curve of every fit, from counts in intervals of its margin.

    Only pairs inside an interval are undecided. At most ``SLOTS`` counts per fit are shuffled; rows never are.
    """
    rows = rows.select(F.col(label).cast("int").alias("label"), *[f.margin().alias(f"m{k}") for k, f in enumerate(fits)])
    ends = rows.agg(*[e(f"m{k}").alias(f"{n}{k}") for k in range(len(fits)) for n, e in (("lo", F.min), ("hi", F.max), ("n", F.count))],
                    F.count(F.lit(1)).alias("n")).first()
    slots, level = [], set()
    for k in range(len(fits)):
        low, high = ends[f"lo{k}"], ends[f"hi{k}"]
        known = ends[f"n{k}"] == ends["n"] > 0
        if known and low == high and np.isfinite(low):
            level.add(k)
        wide = known and np.isfinite([low, high, high - low]).all() and high > low
        slot = F.floor((F.col(f"m{k}") - F.lit(low)) / F.lit(high - low) * F.lit(float(SLOTS - 1))) if wide else F.lit(0)
        slots.append(F.struct(F.lit(k).alias("fit"), slot.cast("int").alias("slot")))
    counts = rows.select("label", F.explode(F.array(*slots)).alias("s")).groupBy("s.fit", "s.slot").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")).toPandas()
    out = []
    for k in range(len(fits)):
        mine = counts[counts["fit"] == k].sort_values("slot")
        pos, neg = (mine[c].astype(float).to_numpy() for c in ("pos", "neg"))
        pairs = pos.sum() * neg.sum()
        if k in level and pairs:  # all margins are equal: every pair is a tie
            out.append((0.5, 0.5))
            continue
        won, open_ = (pos * (neg.cumsum() - neg)).sum(), (pos * neg).sum()
        out.append((won / pairs, (won + open_) / pairs) if pairs else (float("nan"), float("nan")))
    return out


def best_fit(rows: DataFrame, label: str, fits: Sequence[Logit], names: Sequence[str]) -> int:
    """Fit of the greatest exact area, ties by name; areas are computed only of fits whose bounds leave that open."""
    if len(fits) == 1:
        return 0
    bounds = area_bounds(rows, label, fits)
    reached = max(low for low, _ in bounds)
    left = [k for k, (_, high) in enumerate(bounds) if not high < reached - 1e-9]  # sums of doubles; NaN stays
    if len(left) > 1:
        exact = dict(zip(left, areas(rows, label, [fits[k] for k in left])))
        return max(left, key=lambda k: (exact[k], names[k]))
    return left[0]


def forward_selection(train: DataFrame, test: DataFrame, candidates: Sequence[str], label: str, start: Sequence[str] = (),
                      max_steps: int | None = None) -> list[Logit]:
    """Forward selection by area under ROC on the test rows: per step the winner's fit on the training rows.

    All candidates of a step are fitted together and compared together, so the jobs of a step do not grow with them.
    Both parts are read as they are: written tables spare computing them again.
    """
    chosen, out = list(start), []
    for _ in range(len(candidates) if max_steps is None else max_steps):
        left = [c for c in candidates if c not in chosen]
        if not left:
            break
        fits = newton_fits(train, label, [[*chosen, c] for c in left], out[-1] if out else None)
        best = best_fit(test, label, fits, left)
        out.append(fits[best])
        chosen.append(left[best])
    return out


def stepwise_logistic(train: DataFrame, test: DataFrame, candidates: Sequence[str], label: str, max_steps: int | None = None) -> DataFrame:
    """(step, features, auc_train, auc_test) of ``forward_selection``."""
    names = list(dict.fromkeys([*candidates, label]))
    train, test = materialise(train.select(*names)), materialise(test.select(*names))
    steps = forward_selection(train, test, candidates, label, max_steps=max_steps)
    parts = [areas(p, label, steps) if steps else [] for p in (train, test)]
    rows = [(i, ", ".join(f.columns), a, b) for i, (f, a, b) in enumerate(zip(steps, *parts), 1)]
    return train.sparkSession.createDataFrame(rows, "step int, features string, auc_train double, auc_test double")


def next_best_logistic(rows: DataFrame, current: Sequence[str], candidates: Sequence[str], label: str, max_n: int = 5) -> list[str]:
    """Variables in the order that raises the area under ROC on the same rows most, up to ``max_n``."""
    rows = materialise(rows.select(*dict.fromkeys([*current, *candidates, label])))
    steps = forward_selection(rows, rows, candidates, label, current, max(0, max_n - len(current)))
    return list(steps[-1].columns) if steps else list(current)


@dataclass(frozen=True)
class Moments:
    """Sums of products of (1, features, label) over some rows."""

    sums: np.ndarray

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.sums - other.sums)

    @property
    def rows(self) -> float:
        return self.sums[0, 0]

    def elastic_net(self, reg: float, elastic: float) -> np.ndarray:
        """Intercept and coefficients that minimise the mean squared error / 2 plus the penalty on standardised columns.

        Coordinate descent on the correlations. A constant column gets 0; without penalty the least-squares
        solution of smallest norm is taken.
        """
        n, p = self.rows, len(self.sums) - 2
        mean = self.sums[0, 1:] / n
        cov = self.sums[1:, 1:] / n - np.outer(mean, mean)
        sd = np.sqrt(np.maximum(np.diag(cov), 0))
        sd[sd <= 1e-9 * np.sqrt(np.maximum(np.diag(self.sums)[1:] / n, 1e-300))] = 0
        live = np.flatnonzero(sd[:p])
        out = np.zeros(p + 1)
        if sd[p] and len(live):
            r = cov[np.ix_(live, live)] / np.outer(sd[live], sd[live])
            target = cov[live, p] / (sd[live] * sd[p])
            l1, l2 = elastic * reg / sd[p], (1 - elastic) * reg / sd[p]
            if not l1:
                b = np.linalg.lstsq(r + l2 * np.eye(len(live)), target, rcond=1e-12)[0]
            else:
                b = np.zeros(len(live))
                for _ in range(10_000):
                    before = b.copy()
                    for j in range(len(b)):
                        rest = target[j] - r[j] @ b + r[j, j] * b[j]
                        b[j] = np.sign(rest) * max(abs(rest) - l1, 0) / (r[j, j] + l2)
                    if np.abs(b - before).max() < 1e-13:
                        break
            out[1 + live] = b * sd[p] / sd[live]
        out[0] = mean[p] - out[1:] @ mean[:p]
        return out

    def squared_error(self, beta: np.ndarray) -> float:
        """Mean squared error of a fit on these rows."""
        signed = np.append(beta, -1.0)
        return float(max(signed @ self.sums @ signed, 0.0) / self.rows)


def folded_moments(df: DataFrame, features: Sequence[str], label: str, key: str, folds: int, seed: int = 42) -> list[Moments]:
    """Moments of every fold, in one scan; a row's fold depends on its key and the seed only."""
    z = [F.lit(1.0), *[F.col(c).cast("double") for c in [*features, label]]]
    known = F.lit(True)
    for c in z[1:]:
        known = known & c.isNotNull() & ~F.isnan(c)
    stop = F.raise_error(F.lit("missing values in the features or the label: impute them, or only score such rows"))
    rows = df.where(F.when(known, True).otherwise(stop.cast("boolean")))
    sums = [F.sum(z[i] * z[j]).alias(f"s{i}_{j}") for i in range(len(z)) for j in range(i, len(z))]
    fold = (hash_number(key, seed) % folds).cast("int").alias("fold")
    found = {r["fold"]: r for r in rows.groupBy(fold).agg(*sums).collect()}
    out = []
    for k in range(folds):
        m = np.zeros((len(z), len(z)))
        if k in found:
            for i in range(len(z)):
                for j in range(i, len(z)):
                    m[i, j] = m[j, i] = found[k][f"s{i}_{j}"]
        out.append(Moments(m))
    return out


def elastic_net_folds(df: DataFrame, features: Sequence[str], label: str, key: str, regs: Sequence[float], elastics: Sequence[float],
                      folds: int = 10, seed: int = 42) -> DataFrame:
    """(reg, elastic, rmse, intercept, coefficients): mean error over the folds of every grid point and its fit on all rows.

    One scan gives the moments of each fold; those of its training rows are the total less its own, so neither
    folds nor grid points add scans. Folds without rows are left out of the mean.
    """
    parts = folded_moments(df, features, label, key, folds, seed)
    total = Moments(sum(p.sums for p in parts))
    if not total.rows:
        raise ValueError("no rows to fit on")
    rows = []
    for reg in regs:
        for elastic in elastics:
            errors = [np.sqrt(p.squared_error((total - p).elastic_net(reg, elastic))) for p in parts if 0 < p.rows < total.rows]
            beta = total.elastic_net(reg, elastic)
            rows.append((float(reg), float(elastic), float(np.mean(errors)) if errors else None, float(beta[0]), beta[1:].tolist()))
    return df.sparkSession.createDataFrame(rows, "reg double, elastic double, rmse double, intercept double, coefficients array<double>")
