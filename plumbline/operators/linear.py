"""Logistic regression with an inverse-strength penalty, many fits side by side.

The objective ``|w|²/2 + C · Σ logloss`` (intercept free) is smooth and strictly convex, so every
solver ends at one point. One pass over the rows serves every strength and fold: each task sums loss,
gradient and curvature of its own rows per fit, Spark adds the sums, and the driver takes one step per
fit. With the whole curvature matrix these are Newton steps, a handful of passes. Where that matrix
would be too large for a task's result, the step comes from gradients alone (limited-memory BFGS on
features scaled by their curvature at 0), to the same accuracy.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.sums import array_sums
from plumbline.session import drop_path, scratch_path

SUMS_PER_PASS = 2_000_000  # numbers one task may send back
TOLERANCE = 1e-12  # half the squared Newton decrement, relative to the objective
MEMORY = 20  # gradients that limited-memory BFGS remembers
HELD_OUT = -1


@dataclass
class LinearSpec:
    """One fit: its strength and the fold it leaves out (None trains on all training rows)."""

    C: float = 1.0
    max_iter: int = 100
    without_fold: int | None = None


@dataclass
class LinearFit:
    features: list[str]
    coefficients: list[float]
    intercept: float
    iterations: int = 0
    converged: bool = True

    def importances(self) -> dict[str, float]:
        """Signed coefficients."""
        return dict(zip(self.features, self.coefficients))

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``: 1 where the margin is positive; a missing feature stops the job."""
        terms = F.zip_with(F.array(*[_value(f) for f in self.features]), F.array(*[F.lit(w) for w in self.coefficients]), lambda x, w: x * w)
        margin = F.aggregate(terms, F.lit(self.intercept), lambda total, term: total + term)
        known = margin.isNotNull() & ~F.isnan(margin)
        bad = F.raise_error(F.lit("missing value in a feature of the linear model")).cast("double")
        return df.withColumn("prediction", F.when(known, (margin > 0).cast("double")).otherwise(bad))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        terms = [(i, f, w) for i, (f, w) in enumerate(self.importances().items())] + [(-1, None, self.intercept)]
        table = spark.createDataFrame(terms, "position int, feature string, weight double")
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/terms")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LinearFit":
        rows = spark.read.parquet(f"{path}/terms").orderBy("position").collect()
        return LinearFit([r["feature"] for r in rows[1:]], [r["weight"] for r in rows[1:]], rows[0]["weight"])


def fit_linear(
    train: DataFrame, features: Sequence[str], label: str, fold, specs: Sequence[LinearSpec]
) -> list[LinearFit]:
    """Fit all specs on the rows of ``train``; ``fold`` is the column that ``without_fold`` refers to."""
    width = len(features) + 1
    curvature = 1 + width + width * (width + 1) // 2
    solve, sums = (_newton, curvature) if curvature <= SUMS_PER_PASS else (_gradient_steps, 1 + width)
    rows = _slim(train, features, label, fold)
    together = max(1, SUMS_PER_PASS // sums)
    fits = []
    for start in range(0, len(specs), together):
        fits += solve(rows, list(features), list(specs[start : start + together]))
    return fits


def score_linear(
    df: DataFrame, features: Sequence[str], label: str, fold, specs: Sequence[LinearSpec], fits: Sequence[LinearFit]
) -> pd.DataFrame:
    """(fit, label, prediction, n) on the fold each fit left out, all fits in one pass."""
    weights = np.array([[f.intercept, *f.coefficients] for f in fits])
    folds = [HELD_OUT if s.without_fold is None else s.without_fold for s in specs]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(folds), 2, 2), dtype=np.int64)
        for batch in batches:
            x, y, fold_of = _arrays(batch)
            for j, left_out in enumerate(folds):
                mine = fold_of == left_out
                cell = y[mine].astype(np.int64) * 2 + (x[mine] @ weights[j] > 0)
                counts[j] += np.bincount(cell, minlength=4).reshape(2, 2)
        fit, actual, vote = np.nonzero(counts >= 0)
        arrays = [pa.array(c.astype("int32")) for c in (fit, actual, vote)] + [pa.array(counts.ravel())]
        yield pa.RecordBatch.from_arrays(arrays, names=["fit", "label", "prediction", "n"])

    counted = _slim(df, features, label, fold).mapInArrow(score, "fit int, label int, prediction int, n bigint")
    return counted.groupBy("fit", "label", "prediction").agg(F.sum("n").alias("n")).toPandas()


def _newton(rows: DataFrame, features: list[str], specs: list[LinearSpec]) -> list[LinearFit]:
    width = len(features) + 1
    ridge = np.diag([0.0] + [1.0] * len(features))
    now = [np.zeros(width) for _ in specs]
    step = [np.zeros(width) for _ in specs]
    cost = [np.inf] * len(specs)
    rounds, done = [0] * len(specs), [False] * len(specs)
    while True:
        open_fits = [j for j, s in enumerate(specs) if not done[j] and rounds[j] <= s.max_iter]
        if not open_fits:
            break
        tried = {j: now[j] + step[j] for j in open_fits}
        sums = _sums(rows, {j: (tried[j], specs[j].without_fold) for j in open_fits}, width)
        for j in open_fits:
            C, w = specs[j].C, tried[j]
            loss = C * sums[j][0] + 0.5 * w @ ridge @ w
            if not loss <= cost[j] + 1e-9 * abs(cost[j]) and np.abs(step[j]).max() > 0:
                step[j] = step[j] / 2  # too far: try half the way
                rounds[j] += 1
                continue
            now[j], cost[j] = w, loss
            gradient = C * sums[j][1 : width + 1] + ridge @ w
            curvature = C * _square(sums[j][width + 1 :], width) + ridge
            step[j] = -_solve(curvature, gradient)
            rounds[j] += 1
            if -gradient @ step[j] <= TOLERANCE * (1 + loss):
                done[j], now[j] = True, w + step[j]  # the last step is already solved for
    return [
        LinearFit(features, [float(v) for v in w[1:]], float(w[0]), n - 1, ok)
        for w, n, ok in zip(now, rounds, done)
    ]


def _gradient_steps(rows: DataFrame, features: list[str], specs: list[LinearSpec]) -> list[LinearFit]:
    """Limited-memory BFGS for all fits in shared passes, in variables scaled by the curvature at 0."""
    width = len(features) + 1
    path = scratch_path(rows.sparkSession, "wide-rows")  # so that a pass does not plan thousands of columns
    rows.write.parquet(path)
    rows = rows.sparkSession.read.schema(rows.schema).parquet(path)
    ridge = np.array([0.0] + [1.0] * len(features))
    squares = _sums(rows, {j: (np.zeros(width), s.without_fold) for j, s in enumerate(specs)}, width, "diagonal")
    states = [_Descent(s, 1 / np.sqrt(np.maximum(s.C * squares[j][1 + width :] + ridge, 1e-300)), ridge) for j, s in enumerate(specs)]
    while any(not d.done for d in states):
        at = {j: (d.tried * d.scale, d.spec.without_fold) for j, d in enumerate(states) if not d.done}
        for j, sums in _sums(rows, at, width, "gradient").items():
            states[j].take(sums[0], sums[1:])
    drop_path(rows.sparkSession, path)
    return [LinearFit(features, [float(v) for v in d.now[1:] * d.scale[1:]], float(d.now[0] * d.scale[0]), d.rounds, d.converged) for d in states]


class _Descent:
    """One fit's way down: the point, the last gradients, and the point tried next."""

    def __init__(self, spec: LinearSpec, scale: np.ndarray, ridge: np.ndarray):
        self.spec, self.scale, self.ridge = spec, scale, ridge
        self.now = self.tried = np.zeros(len(scale))
        self.cost, self.gradient, self.step = np.inf, None, None
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.rounds, self.done, self.converged = 0, False, False

    def take(self, loss: float, slope: np.ndarray) -> None:
        """What a pass has found at the tried point."""
        w = self.tried * self.scale
        cost = self.spec.C * loss + 0.5 * w @ (self.ridge * w)
        gradient = self.scale * (self.spec.C * slope + self.ridge * w)
        if self.gradient is not None:
            if not cost <= self.cost + 1e-4 * self.gradient @ self.step + 1e-13 * abs(self.cost):
                self.step = self.step / 4  # too far
                if np.abs(self.step).max() <= 1e-14 * (1 + np.abs(self.now).max()):
                    self.done = self.converged = True
                self.tried = self.now + self.step
                return
            moved, bent = self.tried - self.now, gradient - self.gradient
            if moved @ bent > 1e-14 * (bent @ bent):
                self.pairs = [*self.pairs[1 - MEMORY :], (moved, bent)]
            self.rounds += 1
        self.now, self.cost, self.gradient = self.tried, cost, gradient
        self.step = self._downhill()
        if -gradient @ self.step <= TOLERANCE * (1 + cost):
            self.done = self.converged = True
        elif self.rounds >= self.spec.max_iter:
            self.done = True
        self.tried = self.now + self.step

    def _downhill(self) -> np.ndarray:
        q, parts = self.gradient.copy(), []
        for moved, bent in reversed(self.pairs):
            a = (moved @ q) / (moved @ bent)
            q -= a * bent
            parts.append(a)
        if self.pairs:
            moved, bent = self.pairs[-1]
            q *= (moved @ bent) / (bent @ bent)
        for (moved, bent), a in zip(self.pairs, reversed(parts)):
            q += (a - (bent @ q) / (moved @ bent)) * moved
        return -q


def _solve(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solve after scaling to a unit diagonal, since raw features differ by orders of magnitude."""
    scale = 1 / np.sqrt(np.maximum(np.diag(matrix), 1e-300))
    return scale * np.linalg.lstsq(matrix * np.outer(scale, scale), scale * right, rcond=1e-14)[0]


def _square(upper: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((width, width))
    out[np.triu_indices(width)] = upper
    return out + np.triu(out, 1).T


def _sums(rows: DataFrame, at: dict, width: int, what: str = "curvature") -> dict[int, np.ndarray]:
    """Loss and gradient per fit, summed over its training rows, with the upper half of the curvature,
    its diagonal, or neither."""
    upper = np.triu_indices(width)
    length = 1 + width + {"curvature": len(upper[0]), "diagonal": width, "gradient": 0}[what]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {j: np.zeros(length) for j in at}
        for batch in batches:
            x, y, fold_of = _arrays(batch)
            for j, (w, without) in at.items():
                margin = x @ w
                share = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
                error, spread, loss = share - y, share * (1 - share), np.logaddexp(0, margin) - y * margin
                if without is not None:
                    mine = fold_of != without
                    error, spread, loss = error * mine, spread * mine, loss * mine
                totals[j][0] += loss.sum()
                totals[j][1 : width + 1] += error @ x
                if what == "curvature":
                    totals[j][width + 1 :] += (x.T @ (x * spread[:, None]))[upper]
                elif what == "diagonal":
                    totals[j][width + 1 :] += spread @ (x * x)
        fits = pa.array(list(totals), pa.int32())
        lists = pa.array(list(totals.values()), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([fits, lists], names=["fit", "sums"])

    sent = rows.where(F.col("fold") > HELD_OUT).mapInArrow(add_up, "fit int, sums array<double>")
    return {j: np.zeros(length) for j in at} | array_sums(sent, "fit", length)


def _slim(df: DataFrame, features: Sequence[str], label: str, fold) -> DataFrame:
    values = F.array(*[_value(f) for f in features])
    rows = df.select(values.alias("x"), F.col(label).cast("int").alias("y"), F.coalesce(fold, F.lit(HELD_OUT)).cast("int").alias("fold"))
    bad = F.raise_error(F.lit("missing value in a feature of the linear model")).cast("array<double>")
    missing = F.exists("x", lambda v: v.isNull() | F.isnan(v))
    return rows.withColumn("x", F.when(missing, bad).otherwise(F.col("x")))


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(batch.num_rows, -1) if batch.num_rows else flat.reshape(0, 0)
    y, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold"))
    return np.column_stack([np.ones(batch.num_rows), x]), y, fold


def _value(feature: str):
    return F.col(f"`{feature}`").cast("double")
