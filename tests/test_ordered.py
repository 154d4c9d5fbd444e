"""The blocked window and quantile paths against plain windows and NumPy."""

import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from tabspark.operators import curves, dist, encode, quantiles, split
from tabspark.operators.ordered import block_bounds, block_column, blocks_of, filled, ranked, running_sum
from tabspark.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; a third of the values are missing."""
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}",
             None if rng.random() < 0.35 else round(rng.random(), 3)) for i in range(3000)]
    return spark.createDataFrame(rows, "id long, k string, v double").persist()


def test_blocks_bound_the_rows(spark, skewed):
    bounds = block_bounds(skewed, F.col("id"), 100)
    sizes = [r["count"] for r in skewed.groupBy(block_column(F.col("id"), bounds).alias("b")).count().collect()]
    assert len(sizes) >= 25 and max(sizes) <= 200


def test_many_bounds_use_binary_search(spark):
    df = spark.range(5000)
    bounds = list(range(0, 5000, 5))
    got = df.select("id", block_column(F.col("id"), bounds).alias("b")).collect()
    assert all(r["b"] == r["id"] // 5 + 1 for r in got)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_sum(skewed, keys, descending):
    v = F.coalesce("v", F.lit(0.0))
    got = running_sum(skewed, {"s": v}, "id", keys, descending, rows_per_block=150)
    order = F.col("id").desc() if descending else F.col("id").asc()
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("s", F.sum(v).over(w))
    a = {r["id"]: r["s"] for r in got.collect()}
    b = {r["id"]: r["s"] for r in want.collect()}
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-9 for i in a)


@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_fill(skewed, keys, backward):
    got = filled(skewed, "v", "id", keys, backward, rows_per_block=120)
    order = F.col("id").desc() if backward else F.col("id").asc()
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("v", F.last("v", True).over(w))
    assert sorted(map(tuple, got.select("id", "v").collect()), key=str) == sorted(
        map(tuple, want.select("id", "v").collect()), key=str)


def test_ranked_with_ties(skewed):
    got = ranked(skewed.withColumn("t", F.col("id") % 7), "r", "t", tie_break=["id"], rows_per_block=200)
    rows = sorted((r["t"], r["id"], r["r"]) for r in got.collect())
    assert [r[2] for r in rows] == list(range(1, 3001))


@pytest.mark.parametrize("tie", ["id", "name", "day"])
@pytest.mark.parametrize("descending", [False, True])
def test_a_hot_value_is_cut_by_the_tie_break(spark, tie, descending):
    """A third nulls, half zeros, a text of one long prefix, a tie that is null now and then."""
    rng = random.Random(8)
    rows = []
    for i in range(1800):
        u = rng.random()
        rows.append((i, None if u < 0.33 else 0.0 if u < 0.8 else rng.randrange(-50, 50) / 10))
    df = spark.createDataFrame(rows, "id long, v double").withColumns({
        "name": F.concat(F.lit("a long common beginning é "), F.lpad(F.col("id").cast("string"), 6, "0")),
        "day": F.expr("date_add(DATE '2020-01-01', cast(id as int))")})
    block = blocks_of(df, F.col("v"), F.col(tie), 50)
    sizes = [r["count"] for r in df.groupBy(block.alias("b")).count().collect()]
    assert max(sizes) <= 200, sorted(sizes)[-5:]
    got = ranked(df, "r", "v", descending=descending, tie_break=[tie], rows_per_block=50)
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0.0, r[0]), reverse=descending)
    assert {r["id"]: r["r"] for r in got.collect()} == {r[0]: i + 1 for i, r in enumerate(order)}


@pytest.mark.parametrize("tie", ["id", "name"])
def test_hot_value_with_many_cuts_and_null_ties(spark, tie):
    df = spark.range(3000).select("id", F.lit(1).alias("v"), F.format_string("n%06d", "id").alias("name"))
    df = df.withColumn(tie, F.when(F.col("id") > 0, F.col(tie)))
    got = ranked(df.withColumn("was", F.coalesce("id", F.lit(0))), "r", "v", tie_break=[tie], rows_per_block=5)
    assert all(r["r"] == r["was"] + 1 for r in got.collect())


@pytest.mark.parametrize("probs", [[0.5], [0.25, 0.5, 0.75], [0.0, 0.01, 0.99, 1.0], list(np.linspace(0, 1, 50))])
def test_exact_quantiles_large_path(spark, probs):
    rng = np.random.default_rng(0)
    x = np.concatenate([np.round(rng.exponential(size=5000), 2), np.full(3000, 1.5)])
    y = rng.normal(size=8000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    got = exact_quantiles(df, {"x": F.col("x"), "y": F.col("y")}, probs, limit=100, rows_per_block=500)
    assert np.allclose(got["x"], np.quantile(x, probs)) and np.allclose(got["y"], np.quantile(y, probs))
    small = exact_quantiles(df, {"x": F.col("x")}, probs)
    assert np.allclose(small["x"], np.quantile(x, probs))


def test_curve_blocks_agree(spark):
    rng = random.Random(1)
    rows = [(i, int(rng.random() < 0.4), round(rng.random(), 3)) for i in range(4000)]
    df = spark.createDataFrame(rows, "row_id long, y int, score double")
    a = sorted(map(tuple, curves.roc_points(df, "y", "score").collect()))
    b = sorted(map(tuple, curves.roc_points(df, "y", "score", rows_per_block=50).collect()))
    assert a == b
    auc = curves.auc_roc(df.withColumn("score", F.col("y").cast("double")), "y", "score").first()[0]
    assert auc == 1.0


def test_qq_and_category_blocks_agree(spark, skewed):
    a = sorted(map(tuple, dist.qq_points(skewed, "v", "id").collect()))
    b = sorted(map(tuple, dist.qq_points(skewed, "v", "id", rows_per_block=100).collect()))
    assert np.allclose(a, b)
    c = sorted(map(tuple, encode.category_table(skewed, ["k"], rows_per_block=2).collect()))
    assert c == [("k", v, i) for i, v in enumerate(sorted(["hot", *[f"k{j}" for j in range(5)]]))]


def test_folds_with_blocks(spark):
    rows = [(i, "a" if i % 3 else "b") for i in range(1003)]
    df = spark.createDataFrame(rows, "row_id long, y string")
    plain = {r["row_id"]: r["fold"] for r in split.kfold(df).collect()}
    blocked = {r["row_id"]: r["fold"] for r in split.kfold(df, rows_per_block=100).collect()}
    assert plain == blocked
    sizes = [list(plain.values()).count(f) for f in range(5)]
    assert sizes == [201, 201, 201, 200, 200]
    s1 = {r["row_id"]: r["fold"] for r in split.stratified_kfold(df, "y").collect()}
    s2 = {r["row_id"]: r["fold"] for r in split.stratified_kfold(df, "y", rows_per_block=90).collect()}
    assert s1 == s2
    t1 = {r["row_id"]: r["split"] for r in split.stratified_split(df, "y").collect()}
    t2 = {r["row_id"]: r["split"] for r in split.stratified_split(df, "y", rows_per_block=90).collect()}
    assert t1 == t2
    for v in ("a", "b"):
        ids = [i for i, y in rows if y == v]
        assert sum(t1[i] == "test" for i in ids) == -(-len(ids) // 5)


def test_missing_keys_survive_the_block_join(spark):
    df = spark.range(400).select("id", F.when(F.col("id") % 2 == 0, "a").alias("k"), (F.col("id") * 1.0).alias("v"))
    got = running_sum(df, {"s": F.lit(1)}, "id", ["k"], rows_per_block=50)
    assert got.count() == 400 and got.agg(F.max("s")).first()[0] == 200


@pytest.mark.parametrize("limit,rows_per_block", [(None, None), (5, 40)])
def test_medians_by_group(spark, limit, rows_per_block):
    rng = np.random.default_rng(5)
    rows = [(g, float(v)) for g, n in (("a", 301), ("b", 400), (None, 7), ("c", 1)) for v in rng.integers(0, 50, n)]
    df = spark.createDataFrame([*rows, ("a", None), ("d", None)], "g string, v double")
    counts = {"a": 301, "b": 400, None: 7, "c": 1, "d": 0}
    got = quantiles.medians_by(df, F.col("g"), F.col("v"), counts, limit, rows_per_block)
    want = {}
    for g, n in counts.items():
        own = sorted(v for h, v in rows if h == g)
        if own:
            want[g] = (own[(n - 1) // 2], own[n // 2])
    assert got == want


def test_error_medians_read_a_row_once_at_any_number_of_groups(spark, monkeypatch):
    """The plan of the medians has no cell per row and group."""
    from tabspark.operators import metrics

    df = spark.range(600).select((F.col("id") % 20).alias("g"), F.col("id").cast("double").alias("y"), F.lit(3.5).alias("p"))
    want = {tuple(r) for r in metrics.regression_by(df, "y", "p", "g").collect()}
    monkeypatch.setattr(metrics, "LIMIT", 10)
    monkeypatch.setattr(quantiles, "LIMIT", 10)
    monkeypatch.setattr(F, "explode", lambda *a: pytest.fail("a row is repeated"))
    assert {tuple(r) for r in metrics.regression_by(df, "y", "p", "g").collect()} == want


def test_area_with_counts_whose_product_passes_32_bits(spark):
    """100,000 positive and 50,000 negative rows: the product of the counts is 5e9."""
    df = spark.range(150_000).select((F.col("id") % 3 > 0).cast("int").alias("y"), (F.col("id") % 3 / 2.0).alias("score"))
    # the scores 0.5 and 1.0 are positive, 0.0 is negative
    assert curves.auc_roc(df, "y", "score").first()[0] == 1.0
    assert curves.average_precision(df, "y", "score").first()[0] == 1.0
