"""Fits and models: linear calibration, optimal transport, ridge regression, accuracy.

Only bounded samples and moment matrices reach the driver; coefficients go back
as literals.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clip, finite, horner


def linear_calibration(df: DataFrame, *, by: str = "band", min_n: int = 10) -> DataFrame:
    """(by, a, b, n): y = a x + b over finite positive pairs; (1, 0) below ``min_n`` pairs."""
    ok = finite(F.col("x")) & finite(F.col("y")) & (F.col("x") > 0) & (F.col("y") > 0)
    x, y = F.when(ok, F.col("x")), F.when(ok, F.col("y"))
    fits = df.groupBy(by).agg(F.regr_slope(y, x).alias("a"), F.regr_intercept(y, x).alias("b"), F.count(x).alias("n"))
    enough = (F.col("n") >= min_n) & F.col("a").isNotNull()
    return fits.select(by, F.when(enough, F.col("a")).otherwise(1.0).alias("a"), F.when(enough, F.col("b")).otherwise(0.0).alias("b"), "n")


def affine(rgb: list[Column], a: np.ndarray, t: np.ndarray, *, clipped: bool = True) -> list[Column]:
    """``rgb . A + t`` by channel."""
    out = []
    for j in range(len(t)):
        v = F.lit(float(t[j]))
        for i, c in enumerate(rgb):
            v = v + c * F.lit(float(a[i][j]))
        out.append(clip(v, 0.0, 1.0) if clipped else v)
    return out


def polynomial(rgb: list[Column], coefficients: np.ndarray, mask: Column | None = None) -> list[Column]:
    """A polynomial for each channel (highest power first) where ``mask``; clipped everywhere."""
    return [clip(horner(c, k) if mask is None else F.when(mask, horner(c, k)).otherwise(c), 0.0, 1.0) for c, k in zip(rgb, coefficients, strict=True)]


def sample_rows(df: DataFrame, columns: list[str], n: int, seed: int = 0) -> np.ndarray:
    """About ``n`` rows at most, by a hash of their position (row, col): bounded and reproducible."""
    total = df.count()
    part = df if total <= n else df.orderBy(F.xxhash64("row", "col", F.lit(seed)), "row", "col").limit(n)
    rows = part.select("row", "col", *columns).collect()
    rows.sort(key=lambda r: (r[0], r[1]))
    return np.array([[float(v) for v in r[2:]] for r in rows]).reshape(-1, len(columns))


def sinkhorn(x: np.ndarray, y: np.ndarray, reg: float = 0.05, steps: int = 300, stop: float = 1e-6) -> np.ndarray:
    """Barycentric targets of ``x`` under entropic optimal transport to ``y``."""
    cost = ((x[:, None, :] - y[None, :, :]) ** 2).sum(-1)
    k = np.exp(-cost / reg)
    a, b = np.full(len(x), 1 / len(x)), np.full(len(y), 1 / len(y))
    u, v = np.ones(len(x)), np.ones(len(y))
    for i in range(steps):
        v = b / np.maximum(k.T @ u, 1e-300)
        u = a / np.maximum(k @ v, 1e-300)
        if i % 10 == 0 and np.abs(v * (k.T @ u) - b).sum() < stop:
            break
    plan = u[:, None] * k * v
    return plan @ y / np.maximum(plan.sum(1, keepdims=True), 1e-300)


def fit_ot_affine(source: DataFrame, target: DataFrame, *, columns=("r", "g", "b"), n: int = 5000, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(A, t) that carries source colours towards the target's distribution; identity below two samples."""
    c = list(columns)
    x, y = sample_rows(source, c, n, seed), sample_rows(target, c, n, seed)
    if len(x) < 2 or len(y) < 2:
        return np.eye(len(c)), np.zeros(len(c))
    solved = np.linalg.lstsq(np.column_stack([x, np.ones(len(x))]), sinkhorn(x, y), rcond=None)[0]
    return solved[:-1], solved[-1]


def fit_ot_polynomial(source: DataFrame, target: DataFrame, *, degree: int = 4, columns=("r", "g", "b"), n: int = 5000, seed: int = 0, min_n: int = 200) -> np.ndarray:
    """A row of coefficients for each channel, highest power first; identity below ``min_n`` samples."""
    c = list(columns)
    x, y = sample_rows(source, c, n, seed), sample_rows(target, c, n, seed)
    if min(len(x), len(y)) < min_n or degree < 1:
        return np.array([[0.0] * (max(degree, 1) - 1) + [1.0, 0.0]] * len(c))
    t = sinkhorn(x, y)
    return np.array([np.polyfit(x[:, j], t[:, j], degree) for j in range(len(c))])


class SpectralRidge:
    """Standardised polynomial ridge regression from few bands to many, on logits.

    One pass sums the moment matrices of each partition; the normal equations
    are solved on the driver (features squared, whatever the number of pixels).
    """

    def __init__(self, degree: int = 3, alpha: float = 1.0, eps: float = 1e-4):
        self.degree, self.alpha, self.eps = degree, alpha, eps

    def _expand(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return np.column_stack([z[:, list(c)].prod(1) for d in range(1, self.degree + 1) for c in combinations_with_replacement(range(z.shape[1]), d)])

    def _logit(self, y: np.ndarray) -> np.ndarray:
        p = np.clip(y, self.eps, 1 - self.eps)
        return np.log(p / (1 - p))

    def fit(self, df: DataFrame) -> SpectralRidge:
        """Fit on (x array, y array) rows without nulls."""
        k = len(df.select("x").first().x)
        stats = df.agg(*[f(F.get("x", F.lit(i))).alias(f"{n}{i}") for i in range(k) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        self.mean = np.array([stats[f"m{i}"] for i in range(k)])
        self.scale = np.array([stats[f"s{i}"] or 1.0 for i in range(k)])

        def sums(batches):
            import pandas as pd

            total = None
            for frame in batches:
                if len(frame):
                    z = np.column_stack([np.ones(len(frame)), self._expand(np.stack(frame["x"].to_numpy()))])
                    own = z.T @ np.column_stack([z, self._logit(np.stack(frame["y"].to_numpy()))])
                    total = own if total is None else total + own
            if total is not None:
                yield pd.DataFrame({"i": range(len(total)), "v": list(total)})

        parts = df.select("x", "y").mapInPandas(sums, "i int, v array<double>")
        width = len(df.select("y").first().y)
        rows = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
        n = max(r["i"] for r in rows) + 1
        m = np.zeros((n, n + width))
        for r in rows:
            m[r["i"], r["j"]] = r["v"]
        hold = np.eye(n) * self.alpha
        hold[0, 0] = 0
        self.weights = np.linalg.solve(m[:, :n] + hold, m[:, n:])
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with y_hat; NULL where x is NULL or not finite."""
        schema = df.schema.jsonValue()
        from pyspark.sql.types import ArrayType, DoubleType, StructType

        out = StructType.fromJson(schema).add("y_hat", ArrayType(DoubleType()))

        def run(batches):
            for frame in batches:
                made = [None] * len(frame)
                ok = [i for i, x in enumerate(frame["x"]) if x is not None and np.isfinite(np.asarray(x, float)).all()]
                if ok:
                    z = self._expand(np.stack([np.asarray(frame["x"].iloc[i], float) for i in ok]))
                    y = 1 / (1 + np.exp(-np.clip(np.column_stack([np.ones(len(z)), z]) @ self.weights, -50, 50)))
                    for i, v in zip(ok, y, strict=True):
                        made[i] = v
                yield frame.assign(y_hat=made)

        return df.mapInPandas(run, out)


def accuracy(df: DataFrame, *, by: str = "band") -> DataFrame:
    """(by, r2, rmse) of (y, y_hat) rows."""
    res = F.sum(F.pow(F.col("y") - F.col("y_hat"), 2))
    return df.groupBy(by).agg((1 - res / (F.count("y") * F.var_pop("y") + 1e-8)).alias("r2"), F.sqrt(F.avg(F.pow(F.col("y") - F.col("y_hat"), 2))).alias("rmse"))
