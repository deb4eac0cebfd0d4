"""Replay of optimisation over a candidate table: the simplex grid, model-guided and random search, and their metrics."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def simplex_grid(spark: SparkSession, tenths: int = 20, most: int = 10) -> DataFrame:
    """Three shares in tenths, each at most ``most``, that sum to ``tenths``, numbered in order."""
    a, b = spark.range(most + 1).withColumnRenamed("id", "a"), spark.range(most + 1).withColumnRenamed("id", "b")
    grid = a.crossJoin(b).withColumn("c", F.lit(tenths) - F.col("a") - F.col("b")).where(F.col("c").between(0, most))
    number = F.row_number().over(Window.orderBy("a", "b")) - 1
    return grid.select(number.alias("idx"), *[(F.col(x) / 10).alias(x) for x in "abc"])


def running_best(df: DataFrame, groups: list[str], order: str, value: str) -> DataFrame:
    """``df`` with ``best``: the largest value of the group so far."""
    return df.withColumn("best", F.max(value).over(Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def rounds_to(df: DataFrame, groups: list[str], order: str, best: str, level: Column) -> DataFrame:
    """Of every group the first place in order at which ``best`` reaches the level, or the number of its rows."""
    return df.groupBy(*groups).agg(F.coalesce(F.min(F.when(F.col(best) >= level, F.col(order))), F.count("*")).cast("bigint").alias("rounds"))


def violations(selected: Column, k: int, pool: int) -> Column:
    """What is wrong with a selection: values out of range, another count than k, repeated values."""
    return F.struct(
        F.size(F.filter(selected, lambda x: (x < 0) | (x >= pool))).alias("out_of_range"),
        (F.size(selected) != k).cast("int").alias("wrong_count"),
        (F.size(selected) - F.size(F.array_distinct(selected))).alias("repeated"),
    )


def mixture_fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Coefficients of the quadratic mixture model: three shares and their three products, by ridge regression."""
    m = mixture_features(x)
    return np.linalg.solve(m.T @ m + ridge * np.eye(m.shape[1]), m.T @ y)


def mixture_features(x: np.ndarray) -> np.ndarray:
    """Shares and their products."""
    return np.column_stack([x, x[:, 0] * x[:, 1], x[:, 0] * x[:, 2], x[:, 1] * x[:, 2]])


def _log_improvement(mean: np.ndarray, sd: np.ndarray, best: float) -> np.ndarray:
    """Logarithm of the expected improvement of a normal law over the best value."""
    z = (mean - best) / sd
    density = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
    below = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z])
    with np.errstate(divide="ignore"):
        exact = np.log(np.maximum(density + z * below, 0)) + np.log(sd)
    return np.where(z > -6, exact, -0.5 * z * z - 2 * np.log(np.maximum(-z, 1)) + np.log(sd) - 0.5 * math.log(2 * math.pi))


def posterior(x: np.ndarray, y: np.ndarray, at: np.ndarray, noise: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of a Gaussian process with a squared-exponential kernel, its length chosen by likelihood."""
    shift, scale = y.mean(), y.std() or 1.0
    t = (y - shift) / scale
    square = lambda a, b: ((a[:, None] - b[None]) ** 2).sum(-1)
    best = (-math.inf, 1.0)
    for length in (0.1, 0.2, 0.4, 0.8, 1.6):
        k = np.exp(-square(x, x) / (2 * length**2)) + noise * np.eye(len(x))
        sign, det = np.linalg.slogdet(k)
        best = max(best, (-0.5 * t @ np.linalg.solve(k, t) - 0.5 * det, length))
    length = best[1]
    k = np.exp(-square(x, x) / (2 * length**2)) + noise * np.eye(len(x))
    s = np.exp(-square(at, x) / (2 * length**2))
    mean = s @ np.linalg.solve(k, t)
    variance = np.maximum(1 + noise - np.einsum("ij,ji->i", s, np.linalg.solve(k, s.T)), 1e-12)
    return mean * scale + shift, np.sqrt(variance) * scale


def trajectory(x: np.ndarray, y: np.ndarray, start: list[int], rounds: int, method: str, rng: np.random.Generator) -> list[float]:
    """The best value after the start and after each round of picking one more candidate."""
    seen = list(start)
    best = [float(y[seen].max())]
    for _ in range(rounds):
        left = np.setdiff1d(np.arange(len(y)), seen)
        if not len(left):
            best.append(best[-1])
            continue
        if method == "random":
            pick = int(rng.choice(left))
        else:
            mean, sd = posterior(x[seen], y[seen], x[left])
            pick = int(left[np.argmax(_log_improvement(mean, sd, y[seen].max()))])
        seen.append(pick)
        best.append(float(y[seen].max()))
    return best


def replay(runs: DataFrame, x: np.ndarray, y: np.ndarray, k: int = 3, rounds: int = 15, seed: int = 42) -> DataFrame:
    """The trajectories of ``runs`` (``method`` 'model' or 'random', ``repeat``): ``round`` from 0 and ``best``. Both methods of
    a repeat begin with the same k candidates."""

    def one(key: tuple, _: pd.DataFrame) -> pd.DataFrame:
        method, repeat = key
        start = np.random.default_rng(seed + repeat).permutation(len(y))[:k].tolist()
        best = trajectory(x, y, start, rounds, method, np.random.default_rng((seed, repeat)))
        return pd.DataFrame({"method": method, "repeat": repeat, "round": np.arange(len(best)), "best": best})

    return runs.groupBy("method", "repeat").applyInPandas(one, "method string, repeat bigint, round bigint, best double")
