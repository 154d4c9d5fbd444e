"""Outlier flags: z-score, modified z-score, IQR and isolation forest."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.scalar import HASH_RANGE, dbl, hash32, ident
from tabspark.operators.quantiles import exact_quantiles


def z_score(df: DataFrame, column: str, threshold: float = 3.0) -> Column:
    mean, std = df.agg(F.avg(dbl(column)), F.stddev_pop(dbl(column))).first()
    if not std:
        return F.lit(False)
    return F.abs((dbl(column) - F.lit(mean)) / F.lit(std)) > threshold


def modified_z_score(df: DataFrame, column: str, constant: float = 1.486) -> Column:
    """constant * (x - median) / MAD, with a zero MAD read as 1."""
    n = df.select(F.count(dbl(column))).first()[0]
    med = exact_quantiles(df, {"x": dbl(column)}, [0.5], counts={"x": n})["x"][0]
    mad = exact_quantiles(df, {"x": F.abs(dbl(column) - F.lit(med))}, [0.5], counts={"x": n})["x"][0]
    return F.lit(constant) * (dbl(column) - F.lit(med)) / F.lit(mad or 1.0)


def iqr_outliers(df: DataFrame, column: str, factor: float = 1.5, lower_percentile: float = 25,
                 upper_percentile: float = 75) -> Column:
    lo, hi = exact_quantiles(df, {"x": dbl(column)},
                             [lower_percentile / 100, upper_percentile / 100])["x"]
    span = factor * (hi - lo)
    return (dbl(column) < F.lit(lo - span)) | (dbl(column) > F.lit(hi + span))


def outlier_mask(df: DataFrame, column: str, method: str = "z-score", z_score_threshold: float = 3.0,
                 z_score_constant: float = 1.486, iqr_lower_percentile: float = 1,
                 iqr_upper_percentile: float = 99, iqr_threshold: float = 1.5) -> Column:
    """A boolean column for the chosen one-column method."""
    if method == "z-score":
        return z_score(df, column, z_score_threshold)
    if method == "modified-z-score":
        return F.abs(modified_z_score(df, column, z_score_constant)) > z_score_threshold
    if method == "iqr":
        return iqr_outliers(df, column, iqr_threshold, iqr_lower_percentile, iqr_upper_percentile)
    raise ValueError(f"unknown outlier method {method!r}")


def outlier_flags(df: DataFrame, column: str, keep: list[str], **options) -> DataFrame:
    if options.get("method") == "isolation-forest":
        raise ValueError("isolation-forest works on all columns: use isolation_forest")
    mask = outlier_mask(df, column, **options)
    return df.select(*map(ident, keep), F.when(mask, 1).otherwise(0).cast("bigint").alias("flag"))


# --- isolation forest ---------------------------------------------------------------

def _path_norm(n):
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    full = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, full))


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int):
    """One tree as flat arrays (feature, cut, left, right, leaf path length)."""
    feature, cut, left, right, path = [], [], [], [], []

    def node(rows: np.ndarray, depth: int) -> int:
        at = len(feature)
        for col, v in ((feature, -1), (cut, 0.0), (left, at), (right, at), (path, 0.0)):
            col.append(v)
        sub = x[rows]
        lo, hi = sub.min(0), sub.max(0)
        usable = np.flatnonzero(hi > lo)
        if depth >= limit or len(rows) <= 1 or not len(usable):
            path[at] = depth + float(_path_norm(len(rows)))
            return at
        f = int(rng.choice(usable))
        c = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] <= c
        feature[at], cut[at] = f, c
        left[at] = node(rows[go_left], depth + 1)
        right[at] = node(rows[~go_left], depth + 1)
        return at

    node(np.arange(len(x)), 0)
    return tuple(np.array(a) for a in (feature, cut, left, right, path))


def isolation_forest(df: DataFrame, columns: list[str], key: str = "row_id", trees: int = 100,
                     sample_size: int = 256, threshold: float = 0.5, seed: int = 42) -> DataFrame:
    """Anomaly score per row over all columns; flag 1 where it exceeds 0.5.

    Each tree sees at most ``sample_size`` rows, so training needs a bounded pool
    (trees * sample_size rows) drawn by a seeded hash; scoring is one pass.
    """
    x = df.select(ident(key), *[dbl(c).alias(f"x{i}") for i, c in enumerate(columns)])
    names = [f"x{i}" for i in range(len(columns))]
    n = x.count()
    want = trees * sample_size
    drawn = x.withColumn("__h", hash32(F.col(ident(key)), f"forest{seed}"))
    if n > want:
        drawn = drawn.filter(F.col("__h") < F.lit(int(min(1.0, 3.0 * want / n) * HASH_RANGE)))
    pool = drawn.orderBy("__h").limit(want).select(*names).toPandas().to_numpy(dtype=float)
    rng = np.random.default_rng(seed)
    m = min(sample_size, len(pool))
    limit = max(1, math.ceil(math.log2(max(2, m))))
    forest = [_grow(pool[rng.choice(len(pool), m, replace=False)], rng, limit) for _ in range(trees)]
    shared = df.sparkSession.sparkContext.broadcast((forest, limit, float(_path_norm(m)) or 1.0))

    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        grown, depth, norm = shared.value
        mat = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        total = np.zeros(len(mat))
        for feature, cut, left, right, path in grown:
            at = np.zeros(len(mat), dtype=int)
            for _ in range(depth):
                f = feature[at]
                inner = f >= 0
                v = mat[np.arange(len(mat)), np.maximum(f, 0)]
                at = np.where(inner, np.where(v <= cut[at], left[at], right[at]), at)
            total += path[at]
        return pd.Series(2.0 ** (-total / len(grown) / norm))

    out = x.select(ident(key), score(*names).alias("score"))
    return out.withColumn("flag", F.when(F.col("score") > threshold, 1).otherwise(0).cast("bigint"))
