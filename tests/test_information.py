"""Mutual information by nearest neighbours against a plain version over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.functions.scalar import digamma
from tabspark.operators.information import _points, _rows_inside, _with_reach, neighbour_information


def psi(n):
    return sum(1 / j for j in range(1, n)) - 0.5772156649015329


def plain(x, y, k):
    """One feature, all pairs."""
    ok = [i for i in range(len(x)) if x[i] is not None and not math.isnan(x[i]) and y[i] is not None]
    x, y = np.array([x[i] for i in ok]), np.array([y[i] for i in ok])
    ok = np.array([(y == c).sum() > 1 for c in y], bool)
    x, y = x[ok], y[ok]
    if not len(x):
        return 0.0
    total = 0.0
    for i in range(len(x)):
        far = np.abs(x - x[i])
        other = np.sort(np.delete(far, i)[np.delete(y, i) == y[i]])
        kk = min(k, len(other))
        r = other[kk - 1]
        inside = far == 0 if r == 0 else far < r
        total += psi(int(inside[y == y[i]].sum())) - psi(len(other) + 1) - psi(int(inside.sum()))
    return max(0.0, psi(len(x)) + total / len(x))


def rows(n, seed):
    """Whole numbers (many ties), reals, a third zeros, one hot value; nulls, NaN, a class of one row and one of two."""
    rng = np.random.default_rng(seed)
    y = rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1]).tolist()
    y[0], y[1], y[2], y[3] = "single", "pair", "pair", None
    shift = np.array([{"a": 0.0, "b": 1.5}.get(c, 3.0) for c in y])
    whole = np.floor(rng.normal(size=n) * 8 + shift * 5)
    real = rng.normal(size=n) + shift
    zeros = np.where(rng.random(n) < 0.34, 0.0, np.floor(rng.exponential(40, n)))
    out = [[float(a), float(b), float(c), 7.0, y[i]] for i, (a, b, c) in enumerate(zip(whole, real, zeros))]
    out[5][0], out[6][0], out[7][1] = None, math.nan, None
    return out


@pytest.mark.parametrize("k,per_block", [(3, None), (3, 40), (1, 7), (5, 3)])
def test_all_pairs(spark, k, per_block):
    data = rows(600, k)
    names = ["whole", "real", "zeros", "same"]
    df = spark.createDataFrame(data, "whole double, real double, zeros double, same double, y string").repartition(7)
    got = {r["feature"]: r["score"] for r in neighbour_information(df, names, "y", k, per_block).collect()}
    want = {c: plain([r[j] for r in data], [r[4] for r in data], k) for j, c in enumerate(names)}
    assert got.keys() == want.keys()
    for c in names:
        assert got[c] == pytest.approx(want[c], abs=1e-9), c
    assert got["whole"] > 0.1 and got["real"] > 0.2


def test_empty_and_repeated_names(spark):
    df = spark.createDataFrame([], "x double, `a.b` double, y int")
    assert sorted(map(tuple, neighbour_information(df, ["x", "a.b", "x"], "y").collect())) == [("a.b", 0.0), ("x", 0.0)]
    one = spark.createDataFrame([(1.0, 1), (2.0, 2)], "x double, y int")
    assert neighbour_information(one, ["x"], "y").first()["score"] == 0.0
    with pytest.raises(ValueError):
        neighbour_information(one, ["x"], "y", k=0)


def test_no_window_over_a_class_or_feature(spark):
    df = spark.range(500).select(F.rand(1).alias("x"), (F.col("id") % 2).alias("y"))
    reached = _with_reach(_points(df, ["x"], "y"), 3, 50)
    for step, order in ((reached, "lag(x"), (_rows_inside(reached, 50), "sum(__v0")):
        windows = [line for line in step._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line and order in line]
        assert windows and all("block" in line.rsplit("], [", 2)[-2] for line in windows)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_digamma(spark):
    got = spark.range(1, 400).select("id", digamma(F.col("id")).alias("v")).collect()
    assert all(abs(r["v"] - psi(r["id"])) < 1e-11 for r in got)
