"""Cases that once gave a wrong answer or crashed."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import dist, encode, gram as G, models, neighbours, ordered, split


@pytest.mark.parametrize("p", [16, 17])
def test_nan_rows_take_no_part_at_any_width(spark, p):
    rows = [tuple(float((i * 7 + j * j) % 11) for j in range(p)) for i in range(50)]
    rows[3] = (math.nan, *rows[3][1:])
    names = [f"c{j}" for j in range(p)]
    g = G.gram(spark.createDataFrame(rows, names), names)
    assert g.n == 49 and np.isfinite(g.s1).all()


def test_wide_leverage_has_the_trace_of_its_rank(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 40))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["row_id", *[f"c{j}" for j in range(40)]])
    h = G.hat_diag(df, [f"c{j}" for j in range(40)], ["row_id"]).toPandas().sort_values("row_id")["h"].to_numpy()
    want = np.einsum("ij,jk,ik->i", x, np.linalg.inv(x.T @ x), x)
    assert np.allclose(h, want) and abs(h.sum() - 40) < 1e-8


def test_density_is_smooth_with_an_outlier(spark):
    x = [*np.random.default_rng(1).normal(size=2000), 500.0]
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = dist.kde_grid(df, "x", points=2001).toPandas()
    bw = np.std(x, ddof=1) * len(x) ** -0.2
    want = np.exp(-0.5 * ((got["x"].to_numpy()[:, None] - np.array(x)[None, :]) / bw) ** 2).sum(1) / (len(x) * bw * math.sqrt(2 * math.pi))
    assert np.allclose(got["density"], want, rtol=2e-3, atol=1e-9)
    assert dist.kde_grid(df.filter("x > 1e9"), "x").count() == 0
    assert dist.kde_grid(df.filter("x = 500"), "x").count() == 1


@pytest.mark.parametrize("name,power", [("PoissonRegressor", 1.0), ("TweedieRegressor", 1.5)])
def test_penalised_glm_is_at_its_minimum(spark, name, power):
    rng = np.random.default_rng(2)
    x = rng.normal(size=400)
    y = rng.poisson(np.exp(1.0 + 0.5 * x)).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    params = {"alpha": 0.1, "max_iter": 50, **({"power": power, "link": "log"} if "Tweedie" in name else {})}
    fitted = models.estimator(name, ["x"], "y", params).fit(df).transform(df).toPandas()
    mu, a = fitted["prediction"].to_numpy(), fitted["x"].to_numpy()
    slope = np.polyfit(a, np.log(mu), 1)[0]
    gradient = (-(fitted["y"].to_numpy() - mu) * mu ** (1.0 - power) * a).mean() + 0.1 * slope
    assert abs(gradient) < 1e-4


def test_automatic_shrinkage_follows_the_data(spark):
    rng = np.random.default_rng(3)
    rows = [(float(c), *map(float, rng.normal(size=3) + c)) for c in (0, 1) for _ in range(60)]
    df = spark.createDataFrame(rows, ["y", "a", "b", "c"])
    part = G.grams_by(df, ["a", "b", "c"], "y")[1.0]
    x = np.array([r[1:] for r in rows if r[0] == 1.0])
    z = (x - x.mean(0)) / x.std(0)
    s = z.T @ z / len(z)
    mu, p, n = np.trace(s) / 3, 3, len(z)
    delta = ((s - mu * np.eye(3)) ** 2).sum() / p
    beta = min((((z ** 2).sum(1) ** 2).sum() / n - (s ** 2).sum()) / (n * p), delta)
    want = ((1 - beta / delta) * s + beta / delta * mu * np.eye(3)) * np.outer(x.std(0), x.std(0))
    assert np.allclose(models._ledoit_wolf(df, ["a", "b", "c"], "y", 1.0, part), want)


def test_haversine_takes_two_columns():
    embed, _ = neighbours._embed("haversine")
    with pytest.raises(ValueError):
        embed(np.zeros((2, 3)))


def test_no_column_to_encode(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert encode.OneHot([]).fit(df).transform(df).columns == ["a", "b"]


def test_many_blocks_over_a_timestamp(spark):
    start = dt.datetime(2024, 1, 1)
    bounds = [start + dt.timedelta(hours=i) for i in range(1, 301)]
    df = spark.createDataFrame([(start + dt.timedelta(minutes=37 * i),) for i in range(400)], "ts timestamp_ntz")
    got = df.select("ts", ordered.block_column(F.col("ts"), bounds).alias("b")).collect()
    assert all(r["b"] == sum(b <= r["ts"] for b in bounds) for r in got)


def test_stratified_folds_with_a_missing_label(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2) for i in range(50)], "row_id bigint, y int")
    got = split.stratified_kfold(df, "y").groupBy("y", "fold").count().collect()
    assert sum(r["count"] for r in got) == 50 and {r["count"] for r in got if r["y"] is None} == {2}
