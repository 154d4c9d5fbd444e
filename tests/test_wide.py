"""Sparse encoding at any cardinality and the neighbour index for wide vectors."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabspark.operators import dist, fitted, models, neighbours, preprocess
from tabspark.operators.sparse import SparseOneHot, correlated_places, sparse_moments

ROWS = [(1, "a", 1, 2.0, 1.0), (2, "b", 2, 0.0, 2.0), (3, None, 2, None, 3.0), (4, "c", 1, 1.0, 4.0), (4, "c", 1, 1.0, 4.0), (5, "", 3, -1.0, None)]
SCHEMA = "row_id long, g string, h int, x double, y double"


def test_sparse_one_hot_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumns({"encoded": F.lit("clash"), "category": F.lit(1), "place": F.lit(2)})
    model = SparseOneHot(["g", "h"], numerical=["x"]).fit(df)
    assert model.size == 6  # x, a, b, c (the empty text is the first), 2, 3
    assert sorted(map(tuple, model.names(spark).collect())) == [(0, "x"), (1, "g_a"), (2, "g_b"), (3, "g_c"), (4, "h_2"), (5, "h_3")]
    out = model.transform(df)
    assert out.columns == ["row_id", "y", "category", "place", "encoded"]
    got = sorted((r["row_id"], sorted(zip(r["encoded"].indices.tolist(), r["encoded"].values.tolist()))) for r in out.collect())
    assert got == [(1, [(0, 2.0), (1, 1.0)]), (2, [(2, 1.0), (4, 1.0)]), (3, [(4, 1.0)]), (4, [(0, 1.0), (3, 1.0)]),
                   (4, [(0, 1.0), (3, 1.0)]), (5, [(0, -1.0), (5, 1.0)])]
    unknown = spark.createDataFrame([(9, "zz", 7, 1.0, 0.0)], SCHEMA)
    assert model.transform(unknown).first()["encoded"].indices.tolist() == [0]


def test_sparse_one_hot_without_rows_or_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    none = df.limit(0)
    assert SparseOneHot(["g", "h"]).fit(none).transform(none).count() == 0
    assert SparseOneHot(["g"]).fit(none).transform(df).first()["encoded"].size == 0
    assert SparseOneHot([]).fit(df).transform(df).first()["encoded"].size == 0
    assert sparse_moments(SparseOneHot(["g"]).fit(none).transform(none), "encoded").count() == 0


def test_sparse_one_hot_is_saved(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    model = SparseOneHot(["g", "h"], numerical=["x"]).fit(df)
    model.write().save(f"file://{tmp_path}/model")
    again = fitted.load(f"file://{tmp_path}/model")
    view = lambda m: sorted(map(str, m.transform(df).collect()))
    assert view(again) == view(model)


def wide(spark, n, categories, seed=0):
    rng = np.random.default_rng(seed)
    g, h, x = rng.integers(0, categories, n), rng.integers(0, 3, n), rng.normal(size=n)
    return spark.createDataFrame([(i, f"g{a:03d}", f"h{b}", float(c), float(c + b - a / categories))
                                  for i, (a, b, c) in enumerate(zip(g, h, x))], "row_id long, g string, h string, x double, y double")


def test_sparse_moments_are_cross_products(spark):
    df = wide(spark, 300, 20)
    model = SparseOneHot(["g", "h"], numerical=["x"]).fit(df)
    out = model.transform(df).collect()
    z = np.array([[1.0, r["y"], *r["encoded"].toArray()] for r in out])
    want = z.T @ z
    got = np.zeros_like(want)
    for r in sparse_moments(model.transform(df), "encoded", "y").collect():
        i, j = (k + 2 for k in (r["i"], r["j"]))
        assert i <= j and r["n"] == np.count_nonzero(z[:, i] * z[:, j])
        got[i, j] = got[j, i] = r["v"]
    assert np.allclose(got, want)


@pytest.mark.parametrize("threshold", [0.2, 0.6])
def test_correlated_places_match_dense(spark, threshold):
    """All pairs: those that occur together and two large places that never do."""
    rng = np.random.default_rng(3)
    g = rng.choice(4, 400, p=[0.02, 0.5, 0.46, 0.02])
    df = spark.createDataFrame([(i, f"g{a}", f"h{min(a, 2)}", float(a == 1) + float(b)) for i, (a, b) in enumerate(zip(g, rng.normal(size=400) * 0.3))],
                               "row_id long, g string, h string, x double")
    out = SparseOneHot(["g", "h"], numerical=["x"]).fit(df).transform(df)
    z = np.array([r["encoded"].toArray() for r in out.collect()])
    r = np.corrcoef(z.T)
    want = {(i, j): r[i, j] for i in range(len(r)) for j in range(i + 1, len(r)) if abs(r[i, j]) >= threshold}
    got = {(p["i"], p["j"]): p["r"] for p in correlated_places(sparse_moments(out, "encoded"), threshold).collect()}
    assert got.keys() == want.keys() and any(v < 0 for v in got.values())
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_linear_model_reads_the_vector(spark):
    df = wide(spark, 400, 30)
    out = SparseOneHot(["g", "h"], numerical=["x"]).fit(df).transform(df)
    fit = LinearRegression(featuresCol="encoded", labelCol="y", solver="normal").fit(out)
    rows = out.collect()
    a = np.array([[1.0, *r["encoded"].toArray()] for r in rows])
    want = np.linalg.lstsq(a, np.array([r["y"] for r in rows]), rcond=None)[0]
    assert np.allclose([fit.intercept, *fit.coefficients], want, atol=1e-6)


@pytest.mark.parametrize("categories", [3, 1_001, 20_000])
def test_prepare_train_at_any_cardinality(spark, categories):
    """The same form of result; a third of the rows have one category."""
    df = spark.range(60_000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit("c0000000")).otherwise(F.format_string("c%07d", F.col("id") % categories)).alias("g"),
        F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("twice"),
        F.when(F.col("id") % 2 == 0, "yes").otherwise("no").alias("target"))
    out, encoder, flagged = preprocess.prepare_train(df, "target", sparse=True, target_mapping={"yes": 1, "no": 0})
    assert encoder.size == categories - 1 + 2 and set(out.columns) == {"row_id", "target", "encoded", "split"}
    assert [r["name"] for r in flagged.filter("name IN ('x', 'twice')").collect()] == ["twice"]
    assert out.count() == 60_000 and out.filter("target NOT IN (0, 1)").count() == 0
    ones = out.select(F.from_json(F.get_json_object(F.to_json(F.struct("encoded")), "$.encoded"), "indices array<int>").alias("e"))
    hot = ones.filter(F.exists("e.indices", lambda i: i >= 2)).count()
    assert hot == df.filter("g <> 'c0000000'").count()
    less, small, _ = preprocess.prepare_train(df, "target", sparse=True, encode_first=False)
    assert small.size == encoder.size - 1 and less.count() == 60_000


def clusters(spark, n, width, groups, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, width)) * 4
    x = centre[rng.integers(0, groups, n)] + rng.normal(size=(n, width)) * spread
    return x, spark.createDataFrame([(i, [float(v) for v in r], i % 3) for i, r in enumerate(x)], "row_id long, x array<double>, label int")


@pytest.mark.parametrize("metric", ["minkowski", "cosine"])
def test_index_of_wide_vectors(spark, metric):
    """64 columns: recall on rows that did not set the index, few rows visited, every row findable."""
    x, train = clusters(spark, 3_000, 64, 40, 5)
    query = train.filter("row_id % 100 = 0")
    index = neighbours.fit_index(train, 5, metric, recall=0.95, measured_rows=300)
    r = neighbours.index_report(train, query, 5, index).first()
    assert r["queries"] == 30 and r["neighbours"] == 150 and r["recall"] >= 0.9 and r["visited"] < 0.3
    self_found = neighbours.nearest_neighbours(train, train, 1, metric, index=index)
    assert self_found.filter("row_id = neighbour").count() == 3_000


def test_index_of_shapeless_vectors_visits_more(spark):
    """Without clusters the recall holds and the visited share rises."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(rng.normal(size=(600, 32)))]
    train = spark.createDataFrame(rows, "row_id long, x array<double>, label int")
    index = neighbours.fit_index(train, 5, cells=20)
    r = neighbours.index_report(train, train, 5, index).first()
    assert r["recall"] >= 0.9 and index.probes > 3


def test_index_blocks_and_small_tables(spark):
    x, train = clusters(spark, 200, 3, 2, 7, spread=0.01)
    index = neighbours.fit_index(train, 4, cells=4, recall=1.0)
    one = neighbours.CellIndex(index.centres, 1)
    got = neighbours.nearest_neighbours(train, train.limit(20), 150, index=one, block_rows=16)
    assert got.groupBy("row_id").count().filter("count = 150").count() == 20  # further cells until they hold k rows
    empty = train.limit(0)
    assert neighbours.nearest_neighbours(empty, train, 3).count() == 0
    assert neighbours.nearest_neighbours(empty, train, 3, index=neighbours.fit_index(empty, 3)).count() == 0
    assert neighbours.nearest_neighbours(train, empty, 3, index=index).count() == 0
    same = train.withColumn("x", F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    assert neighbours.index_report(same, same.limit(5), 3, neighbours.fit_index(same, 3)).first()["neighbours"] == 15
    with pytest.raises(ValueError):
        neighbours.nearest_neighbours(train, train, 3, "cosine", index=index)


def test_neighbour_model_with_an_index_is_saved(spark, tmp_path):
    x, train = clusters(spark, 300, 4, 3, 8)
    df = train.select("row_id", *[F.col("x")[i].alias(f"f{i}") for i in range(4)], (F.col("x")[0] > 0).cast("double").alias("y"))
    features = [f"f{i}" for i in range(4)]
    model = models.estimator("KNeighborsClassifier", features, "y", {"n_neighbors": 3, "recall": 1.0}).fit(df)
    plain = models.estimator("KNeighborsClassifier", features, "y", {"n_neighbors": 3}).fit(df)
    view = lambda m: {r["row_id"]: r["prediction"] for r in m.transform(df).collect()}
    model.write().save(f"file://{tmp_path}/knn")
    assert view(fitted.load(f"file://{tmp_path}/knn")) == view(model)
    both = view(plain)
    assert sum(v == both[k] for k, v in view(model).items()) >= 297


def test_histogram_with_empty_bins(spark):
    df = spark.createDataFrame([("a", 0.0, None), ("a", 1.0, None), ("b", 10.0, None), (None, 5.0, None), ("c", None, None)], "g string, x double, e double")
    rows = {(r["feature"], r["class"], r["bin"]): r["n"] for r in dist.histogram_by_class(df, ["x", "e"], "g", bins=5, empty=True).collect()}
    assert len(rows) == 2 * 4 * 5 and sum(rows.values()) == 4
    assert rows["x", "a", 0] == 2 and rows["x", "b", 4] == 1 and rows["x", None, 2] == 1
    assert dist.histogram_by_class(df.limit(0), ["x"], "g", empty=True).count() == 0


def test_copies_of_wide_vectors_have_no_distance(spark):
    """Equal vectors: distance 0 and the lower ids first, across tiles and units (F6)."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 48)) * 30 + 100
    x[300:] = x[:300]
    x[500:] = x[0]
    train = spark.createDataFrame([(i, r.tolist(), i % 3) for i, r in enumerate(x)], "row_id long, x array<double>, label int")
    got = neighbours.nearest_neighbours(train, train, 7, block_rows=16).collect()
    by_row = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by_row.setdefault(r["row_id"], []).append((r["neighbour"], r["distance"]))
    gap = np.round(np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2)), 9)
    for i in range(600):
        want = np.argsort(gap[i], kind="stable")[:7]
        assert [n for n, _ in by_row[i]] == want.tolist()
        assert np.allclose([d for _, d in by_row[i]], gap[i][want], rtol=0, atol=1e-9)


def test_neighbours_of_a_unit_in_bounded_tiles(monkeypatch):
    """Tiles smaller than k, ties over tiles, and no product over more than a tile (F6, F13)."""
    monkeypatch.setattr(neighbours, "TILE", 8), monkeypatch.setattr(neighbours, "TILE_ROWS", 5), monkeypatch.setattr(neighbours, "TILE_PAIRS", 3)
    rng = np.random.default_rng(4)
    t, q = rng.integers(0, 3, size=(83, 3)).astype(float), rng.integers(0, 3, size=(21, 3)).astype(float)
    for k in (1, 6, 100):
        rows, cols, d = neighbours._best_of_unit(q, t, k)
        for i in range(len(q)):
            gap = np.round(np.linalg.norm(t - q[i], axis=1), 9)
            want = np.argsort(gap, kind="stable")[:k]
            assert cols[rows == i].tolist() == want.tolist() and np.array_equal(d[rows == i], gap[want])
    seen = []
    import pandas as pd
    neighbours._sliced(lambda a: seen.append(len(a)), pd.Series(list(q)), 3)
    assert max(seen) <= 8 and sum(seen) == 21


def test_euclidean_rows_pass_one_python_worker(spark, monkeypatch):
    """Euclidean coordinates are the column itself; the search over them is that of any other metric's form (F13)."""
    column = F.col("x")
    assert neighbours._coords("minkowski")(column) is column
    with pytest.raises(ValueError):
        neighbours._coords("other")
    rng = np.random.default_rng(13)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(400, 6)))]
    df = spark.createDataFrame(rows, "row_id long, x array<double>, label int").persist()
    plan = df.select("row_id", neighbours._assign(rng.normal(size=(5, 6)))(neighbours._coords("euclidean")(F.col("x"))).alias("a"))
    assert plan._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    index = neighbours.fit_index(df, 5, recall=1.0)
    got = {(r["row_id"], r["rank"]): r["neighbour"] for r in neighbours.nearest_neighbours(df, df, 5).collect()}
    unit = {(r["row_id"], r["rank"]): r["neighbour"] for r in neighbours.nearest_neighbours(df, df, 5, index=index).collect()}
    x = np.array([r[1] for r in rows])
    want = np.argsort(np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), 9), axis=1, kind="stable")[:, :5]
    assert all(got[i, r + 1] == want[i, r] for i in range(400) for r in range(5))
    assert sum(unit[k] == got[k] for k in got) >= 0.95 * len(got)


def test_a_unit_is_held_once(monkeypatch):
    """Beside the training rows a task holds tiles, not further copies of the rows (F13)."""
    import tracemalloc

    monkeypatch.setattr(neighbours, "TILE", 64), monkeypatch.setattr(neighbours, "TILE_ROWS", 512)
    rng = np.random.default_rng(5)
    q, t = rng.normal(size=(128, 64)), rng.normal(size=(60_000, 64))
    tracemalloc.start()
    neighbours._best_of_unit(q, t, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < t.nbytes / 2
