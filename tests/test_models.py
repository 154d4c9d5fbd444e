"""Model quality, closed forms and invariants of the randomised operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import (encode, gram, metrics, models, neighbours, outliers, preprocess, reduce,
                                search, select, split, transforms, twopart)
from tabspark.operators.roles import TabularDataset
from tabspark.sources import runs as rs


def frame(spark, x, y=None, names=None):
    names = names or [f"f{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, r), *([float(y[i])] if y is not None else [])) for i, r in enumerate(x)]
    cols = ["row_id long", *[f"{n} double" for n in names], *(["y double"] if y is not None else [])]
    return spark.createDataFrame(rows, ", ".join(cols)).persist()


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(100, 5))
    y = x @ np.array([30.0, 60.0, 5.0, 80.0, 12.0]) + rng.normal(scale=0.1, size=100)
    return x, y, frame(spark, x, y)


FIVE = [f"f{i}" for i in range(5)]


def r2(df, y="y"):
    return metrics.regression_metrics(df, y, "prediction").first()["R2"]


@pytest.mark.parametrize("name,params", [
    ("LinearRegression", {}), ("Ridge", {}), ("Lasso", {"alpha": 0.1}), ("KernelRidge", {"kernel": "linear"}),
    ("LinearSVR", {"iterations": 80}), ("SGDRegressor", {}), ("GradientBoostingRegressor", {"n_estimators": 10})])
def test_regression_quality(linear, name, params):
    _, _, df = linear
    assert r2(models.estimator(name, FIVE, "y", params).fit(df).transform(df)) >= 0.5


def test_ols_matches_numpy(linear):
    x, y, df = linear
    a = np.column_stack([np.ones(100), x])
    beta, *_ = np.linalg.lstsq(a, y, rcond=None)
    fit = gram.least_squares(gram.gram(df, [*FIVE, "y"]), FIVE, "y")
    assert np.allclose([fit.intercept, *fit.coef], beta)
    resid = y - a @ beta
    err = np.sqrt(np.diag(np.linalg.inv(a.T @ a)) * (resid @ resid) / 94)
    assert np.allclose([fit.intercept_err, *fit.std_err], err)
    xc, yc = x - x.mean(0), y - y.mean()
    ridge = gram.least_squares(gram.gram(df, [*FIVE, "y"]), FIVE, "y", alpha=3.0)
    assert np.allclose(ridge.coef, np.linalg.solve(xc.T @ xc + 3 * np.eye(5), xc.T @ yc))


def test_wide_moments_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 20)) + 100
    df = frame(spark, x).withColumn("g", F.col("row_id") % 3)
    names = [f"f{i}" for i in range(20)]
    parts = gram.grams_by(df, names, "g")
    total = gram.sum_grams(parts.values())
    assert total.n == 300 and np.allclose(total.scatter, (x - x.mean(0)).T @ (x - x.mean(0)))
    assert np.allclose(parts[1].mean, x[1::3].mean(0)) and np.allclose(total.raw, x.T @ x)


def test_hat_trace_is_rank(linear):
    x, _, df = linear
    h = np.array([r["h"] for r in gram.hat_diag(df, FIVE, ["row_id"]).orderBy("row_id").collect()])
    assert abs(h.sum() - 5) < 1e-8 and np.allclose(h, np.diag(x @ np.linalg.pinv(x)))


def test_polynomial_degree_two(spark):
    rng = np.random.default_rng(1)
    x = np.linspace(-5, 5, 100).reshape(-1, 1)
    y = x[:, 0] ** 2 + rng.normal(size=100)
    df = frame(spark, x, y, ["x"])
    poly = encode.polynomial_features(df, ["x"], degree=2, include_bias=False, keep=["row_id", "y"])
    out = models.estimator("LinearRegression", ["x", "x^2"], "y").fit(poly).transform(poly)
    assert round(metrics.regression_metrics(out, "y", "prediction").first()["RMSE"], 1) <= 1.5


def test_correlation_with_nulls_and_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 5.0, 5.0), (4.0, 9.0, 5.0)], "a double, b double, c double")
    got = {(r["col_i"], r["col_j"]): r["r"] for r in gram.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert abs(got["a", "b"] - np.corrcoef([1, 3, 4], [2, 5, 9])[0, 1]) < 1e-12
    assert got["a", "c"] is None and got["b", "c"] is None


def test_backward_elimination(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 6))
    x[:, 5] = x[:, 0] + rng.normal(scale=0.01, size=400)
    y = 3 * x[:, 0] - 2 * x[:, 1] + rng.normal(size=400)
    df = frame(spark, x, y)
    names = [f"f{i}" for i in range(6)]
    a = [r[0] for r in gram.backward_elimination(df, names, "y", "t") if r[1]]
    b = [r[0] for r in gram.backward_elimination(df, names, "y", "f", vif_threshold=5.0) if r[1]]
    assert "f1" in a and len({"f0", "f5"} & set(b)) == 1 and "f1" in b
    assert gram.non_significant_columns(df, names, "y") == sorted(set(names) - set(a))


def test_pca_variance_fraction(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(100, 50)) @ np.diag(np.r_[np.full(20, 5.0), np.full(30, 0.05)])
    df = frame(spark, x)
    names = [f"f{i}" for i in range(50)]
    rows = reduce.pca_variance(df, names, standardize=False).orderBy("component").collect()
    ratio = np.array([r["ratio"] for r in rows])
    assert (np.diff(ratio) <= 1e-12).all() and abs(rows[-1]["cumulative"] - 1) < 1e-9
    k = reduce.components_for(ratio, 0.99)
    assert ratio[:k].sum() >= 0.99 > ratio[:k - 1].sum()
    assert len(reduce.pca_project(df, names, ["row_id"], 0.99, standardize=False).columns) == k + 1


def test_ica_recovers_sources(spark):
    rng = np.random.default_rng(0)
    s = np.column_stack([rng.uniform(-1, 1, 2000), rng.laplace(size=2000)])
    x = s @ np.array([[1.0, 0.6], [0.4, 1.0]])
    out = reduce.ica_project(frame(spark, x, names=["a", "b"]), ["a", "b"], ["row_id"], 2).orderBy("row_id").collect()
    got = np.array([[r["c1"], r["c2"]] for r in out])
    c = np.abs(np.corrcoef(s.T, got.T)[:2, 2:])
    assert (c.max(axis=1) > 0.97).all()


def test_lda_separates(spark):
    rng = np.random.default_rng(0)
    lab = rng.integers(0, 3, 300)
    x = rng.normal(size=(300, 4)) + np.array([[0, 0, 0, 0], [4, 0, 0, 0], [0, 4, 0, 0]])[lab]
    df = frame(spark, x, lab, ["a", "b", "c", "d"])
    out = reduce.lda_project(df, ["a", "b", "c", "d"], "y", ["row_id", "y"], 5)
    assert out.columns == ["row_id", "y", "c1", "c2"]
    for name in ("LinearDiscriminantAnalysis", "QuadraticDiscriminantAnalysis", "GaussianNB"):
        pred = models.estimator(name, ["a", "b", "c", "d"], "y").fit(df).transform(df)
        assert metrics.classification_metrics(pred, "y", "prediction")["accuracy"] > 0.9


@pytest.mark.parametrize("name,params", [
    ("LogisticRegression", {"class_weight": "balanced"}), ("RidgeClassifier", {"class_weight": "balanced"}),
    ("LinearSVC", {"iterations": 40}), ("SGDClassifier", {"loss": "log_loss", "penalty": "l1", "iterations": 40}),
    ("PassiveAggressiveClassifier", {"iterations": 40}), ("SGDClassifier", {"loss": "perceptron", "iterations": 40})])
def test_classifier_quality(spark, name, params):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4))
    y = (x @ np.array([2.0, -1.0, 0.5, 0.0]) + rng.normal(scale=0.3, size=400) > 0.5).astype(float)
    df = frame(spark, x, y, ["a", "b", "c", "d"])
    pred = models.estimator(name, ["a", "b", "c", "d"], "y", params).fit(df).transform(df)
    assert metrics.classification_metrics(pred, "y", "prediction")["accuracy"] > 0.85


@pytest.mark.parametrize("metric", ["minkowski", "cosine"])
@pytest.mark.parametrize("block_rows", [7, 60])
def test_neighbours_match_brute_force(spark, metric, block_rows):
    """Clusters of very different size: one holds most rows, so its cell is split."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(150, 3)) * 0.1, rng.normal(size=(40, 3)) + 8, rng.normal(size=(10, 3)) - 9])
    q = rng.normal(size=(60, 3)) * 6
    mk = lambda m: spark.createDataFrame([(i, [float(v) for v in r], i % 3) for i, r in enumerate(m)],
                                         "row_id long, x array<double>, label int")
    got = neighbours.nearest_neighbours(mk(x), mk(q), 4, metric, block_rows=block_rows).collect()
    if metric == "cosine":
        u = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
        dist = 1 - u(q) @ u(x).T
    else:
        dist = np.linalg.norm(q[:, None] - x[None], axis=2)
    for i in range(len(q)):
        mine = sorted((r["rank"], r["neighbour"], r["distance"]) for r in got if r["row_id"] == i)
        want = np.argsort(dist[i], kind="stable")[:4]
        assert np.allclose([m[2] for m in mine], dist[i][want], atol=1e-6) and len(mine) == 4


def test_haversine_distance(spark):
    pts = spark.createDataFrame([(0, [0.0, 0.0], 0), (1, [0.0, 1.0], 1)], "row_id long, x array<double>, label int")
    rows = neighbours.nearest_neighbours(pts, pts, 2, "haversine").filter("rank = 2").collect()
    assert all(abs(r["distance"] - 1.0) < 1e-6 for r in rows)


def test_isolation_forest_finds_planted(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(500, 3)), np.full((5, 3), 12.0) + rng.normal(size=(5, 3))])
    out = outliers.isolation_forest(frame(spark, x), ["f0", "f1", "f2"]).orderBy(F.desc("score")).collect()
    assert {r["row_id"] for r in out[:5]} == set(range(500, 505)) and all(r["flag"] == 1 for r in out[:5])


def test_yeo_johnson_unskews_and_inverts(spark):
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.lognormal(size=2000), rng.normal(size=2000) - 3])
    df = frame(spark, x, names=["a", "b"])
    model = transforms.Scaler("yeo-johnson", ["a", "b"], standardize=True).fit(df)
    out = model.transform(df)
    s = out.agg(F.skewness("a"), F.skewness("b"), F.avg("a"), F.stddev_pop("a")).first()
    assert abs(s[0]) < 0.2 and abs(s[1]) < 0.2 and abs(s[2]) < 1e-9 and abs(s[3] - 1) < 1e-9
    back = model.inverse(out).orderBy("row_id").collect()
    assert np.allclose([[r["a"], r["b"]] for r in back], x)
    lam = transforms.power_lambdas(df, ["a"], "box-cox")[0]["lambda"]
    assert abs(lam) < 0.1


def test_quantile_transform_range(spark):
    rng = np.random.default_rng(0)
    df = frame(spark, rng.exponential(size=(3000, 1)), names=["a"])
    u = transforms.quantile_transform(df, "a", "u").agg(F.min("u"), F.max("u"), F.avg("u"), F.stddev_pop("u")).first()
    assert u[0] == 0 and u[1] == 1 and abs(u[2] - 0.5) < 0.01 and abs(u[3] - 12 ** -0.5) < 0.01
    z = transforms.quantile_transform(df, "a", "z", "normal").agg(F.avg("z"), F.stddev_pop("z")).first()
    assert abs(z[0]) < 0.02 and abs(z[1] - 1) < 0.05


def test_nystroem_approximates_kernel(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 3))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id long, x array<double>")
    out = reduce.nystroem(df, "x", ["row_id"], "row_id", n_components=40).orderBy("row_id").collect()
    z = np.array([[r[f"k_{i}"] for i in range(40)] for r in out])
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    assert np.allclose(z @ z.T, np.exp(-d / 3), atol=1e-6)


@pytest.fixture(scope="module")
def zero_inflated(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(400, 5))
    raw = x @ np.array([30.0, 60.0, 5.0, 80.0, 12.0])
    return frame(spark, x, np.where(raw > 0, raw, 0.0))


def test_hurdle(zero_inflated):
    df = zero_inflated
    model = twopart.HurdleRegression(FIVE, "y").fit(df)
    assert r2(model.transform(df)) > 0.95
    e = model.expected_value(df).select("prediction").count()
    assert e == 400
    with pytest.raises(ValueError):
        twopart.HurdleRegression(["f0"], "y")
    with pytest.raises(ValueError):
        twopart.HurdleRegression(FIVE, "y", clf_name="GaussianNB")


def test_zero_inflated_with_perfect_classifier(zero_inflated):
    df = zero_inflated
    reg = models.estimator("LinearRegression", FIVE, "y").fit(df.filter("y > 0"))
    perfect = models.Fitted(lambda d: d.withColumn("prediction", F.when(F.col("y") == 0, 1.0).otherwise(0.0)))
    both = twopart.ZeroInflatedModel(perfect, reg).transform(df)
    alone = reg.transform(df).select("row_id", F.col("prediction").alias("alone"))
    bad = both.join(alone, "row_id").filter(
        ((F.col("y") > 0) & (F.col("prediction") != F.col("alone"))) | ((F.col("y") == 0) & (F.col("prediction") != 0)))
    assert bad.count() == 0


def test_preprocess_is_saveable(spark, tmp_path):
    from pyspark.ml import PipelineModel

    rng = np.random.default_rng(0)
    df = frame(spark, np.column_stack([rng.lognormal(size=300), rng.normal(size=300), np.zeros(300)]), names=["s", "n", "z"])
    df = df.withColumn("cat", F.col("row_id") % 3)
    pipe = preprocess.preprocess_v1(df, ["row_id"])
    out = pipe.transform(df)
    assert out.columns == ["row_id", "categorical__cat", "numerical__non_skewed__n", "numerical__non_skewed__z",
                           "numerical__skewed__s"]
    pipe.write().overwrite().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p")).transform(df)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))
    v2 = preprocess.preprocess_v2(df, ["row_id"]).transform(df)
    assert "numerical__non_skewed__z" not in v2.columns and "categorical__cat" in v2.columns
    plain = preprocess.preprocess_v2(df, ["row_id"], skew_transformer=None).transform(df)
    assert plain.columns == ["row_id", "s", "n", "cat"]
    rs.save_run(pipe, spark.createDataFrame([("r", 1.0)], "run_id string, value double"), str(tmp_path / "run"), {"data": df})
    assert rs.load_run_model(str(tmp_path / "run")).transform(df).count() == 300
    assert rs.load_from_run(spark, str(tmp_path / "run"), "data").count() == 300


def test_prepare_train_orders(spark):
    rows = [(i, f"c{i % 3}", float(i), float(2 * i + (i % 5) * 0.01), ["LOW", "HIGH"][i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, c string, a double, b double, t string")
    first, enc, flagged = preprocess.prepare_train(df, "t", target_mapping={"LOW": 0, "HIGH": 1})
    assert flagged == ["b"] and "b" in first.columns and enc.output_columns == ["c_c1", "c_c2"]
    second, _, _ = preprocess.prepare_train(df, "t", encode_first=False)
    assert "b" not in second.columns
    with pytest.raises(ValueError):
        preprocess.prepare_train(df.withColumn("a", F.when(F.col("a") > 3, F.col("a"))), "t")


def test_dataset_wrapper(spark):
    rows = [(i, f"c{i % 3}", float(i * i), i / 3, float(i)) for i in range(60)]
    ds = TabularDataset.of(spark.createDataFrame(rows, "row_id long, c string, a double, b double, y double"), target="y")
    assert ds.roles.categorical == ("c",) and ds.roles.numerical == ("a", "b")
    enc = ds.encode_categorical()
    assert enc.roles.categorical == ("c_c1", "c_c2") and enc.encode_categorical() is enc
    moved = enc.transform_numerical("standard", omit=("b",)).apply_transform("b", "symlog")
    with pytest.raises(ValueError):
        moved.apply_transform("a", "robust")
    with pytest.raises(ValueError):
        moved.apply_transform("y", "robust")
    back = moved.inverse_transform().orderBy("row_id").collect()
    assert np.allclose([[r["a"], r["b"]] for r in back], [[r[2], r[3]] for r in rows])
    assert ds.drop("a").roles.numerical == ("b",) and "y" not in ds.without_target().columns
    assert ds.describe().count() == 2 + 3 and "TabularDataset" in str(ds)


def test_search_handles_failures(spark, linear):
    _, _, df = linear
    folded = split.kfold(df)
    s = search.grid_search(folded, FIVE, "y", "SGDRegressor", {"loss": ["squared_error", "nonsense"], "iterations": [5]})
    bad = s.filter((F.col("params").contains("nonsense")) & (F.col("metric") == "RMSE") & (F.col("set") == "val")).first()
    assert math.isnan(bad["value"]) and bad["rank"] == 2
    assert search.best_trial(s, "RMSE") == 0
    with pytest.raises(ValueError):
        search.model_search(df, df, FIVE, "y", {"Ridge": None}, "ranking")
    with pytest.raises(ValueError):
        search.model_search(df, df, FIVE, "y", {"Ridge": None}, "regression", refit="accuracy")


def test_ridge_cv_agrees_with_search(linear):
    _, _, df = linear
    folded = split.kfold(df)
    fast = {r["alpha"]: r["rmse"] for r in gram.ridge_grid_cv(folded, FIVE, "y", [0.1, 10.0]).collect()}
    slow = search.grid_search(folded, FIVE, "y", "Ridge", {"alpha": [0.1, 10.0]})
    rows = slow.filter("set = 'val' AND metric = 'RMSE'").orderBy("trial").collect()
    assert np.allclose([r["value"] for r in rows], [fast[0.1], fast[10.0]])


def test_transformed_target(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 2))
    y = np.exp(x @ np.array([0.8, -0.5]) + 1)
    df = frame(spark, x, y, ["a", "b"])
    plain = r2(models.estimator("LinearRegression", ["a", "b"], "y").fit(df).transform(df))
    moved = r2(models.transformed_target(df, "LinearRegression", ["a", "b"], "y").transform(df))
    assert moved > plain


def test_feature_scores(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3))
    y = (x[:, 1] > 0).astype(float)
    df = frame(spark, x, y, ["a", "b", "c"])
    assert select.anova_scores(df, ["a", "b", "c"], "y", k=1).first()["feature"] == "b"
    assert select.regression_f_scores(df, ["a", "b", "c"], "y", k=1).first()["feature"] == "b"
    mi = {r["feature"]: r["score"] for r in select.mutual_information(df, ["a", "b", "c"], "y").collect()}
    assert max(mi, key=mi.get) == "b"


@pytest.mark.parametrize("kind", ["Regressor", "Classifier"])
def test_boosted_trees_on_cells_are_those_on_rows(spark, kind):
    """Trees fitted on weighted cells predict what Spark's trees on the rows predict (F8, F11)."""
    from pyspark.ml import classification as mlc, regression as mlr

    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 4, 3000), rng.integers(0, 90, 3000) ** 2, rng.integers(0, 2, 3000)])
    y = np.round(x[:, 0] * 3.0 + np.sqrt(x[:, 1]) + rng.normal(size=3000) * 4, 3)
    df = frame(spark, x.astype(float), (y > 45).astype(float) if kind == "Classifier" else y)
    mine = models.estimator(f"GradientBoosting{kind}", ["f0", "f1", "f2"], "y", {"n_estimators": 8}).fit(df)
    cls = mlc.GBTClassifier if kind == "Classifier" else mlr.GBTRegressor
    plain = models._spark_fit(df, ["f0", "f1", "f2"], "y", cls(maxIter=8, stepSize=0.1, maxDepth=3, seed=42))
    a, b = (np.array([r[0] for r in m.transform(df).orderBy("row_id").select("prediction").collect()]) for m in (mine, plain))
    assert np.allclose(a, b, atol=1e-6)
    assert mine.info["cells"] < 1000 and set(mine.transform(df).columns) >= {*df.columns, "prediction"}
    assert not [c for c in mine.transform(df).columns if c.startswith("__") or c in ("rawPrediction", "probability")]


def test_bins_of_boosted_trees(spark, monkeypatch):
    """Thresholds from all rows; a rare value and a constant have their bins, many values quantiles."""
    df = spark.range(60_000).select((F.col("id") == 17).cast("double").alias("rare"), F.lit(2.0).alias("one"), F.col("id").cast("double").alias("many"))
    rare, one, many = models._bin_edges(df, ["rare", "one", "many"])
    assert rare == [0.5] and one == [0.0] and len(many) == 31 and abs(many[15] - 30_000) < 60
    with pytest.raises(Exception):
        bad = spark.createDataFrame([(1.0, 1.0), (2.0, None), (3.0, 2.0)], "a double, y double")
        models.estimator("GradientBoostingRegressor", ["a"], "y", {"n_estimators": 2}).fit(bad)


def test_tweedie_fits_read_a_kept_table(spark, monkeypatch):
    """The passes of all fits read kept columns, and the secant needs few fits (F12)."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2))
    y = np.where(rng.random(400) < 0.4, 0.0, np.exp(0.5 * x[:, 0] + 1.0) * rng.gamma(2.0, 0.5, 400))
    df, seen, plain = frame(spark, x, y).withColumn("z", F.lit(1)), [], models._spark_fit
    monkeypatch.setattr(models, "_spark_fit", lambda d, *a, **k: seen.append(d.storageLevel.useMemory) or plain(d, *a, **k))
    m = models.estimator("TweedieRegressor", ["f0", "f1"], "y", {"power": 1.5, "alpha": 0.5, "tol": 1e-10}).fit(df)
    assert all(seen) and len(seen) <= 5
    coef = np.array(m.info["model"].stages[-1].coefficients)
    mu = np.array([r[0] for r in m.transform(df).orderBy("row_id").select("prediction").collect()])
    slope = (mu - y) * mu ** -0.5
    assert abs(slope.mean()) < 1e-6 and np.abs((slope[:, None] * x).mean(0) + 0.5 * coef).max() < 1e-6


def test_boosted_trees_read_no_more_for_copies(spark):
    """What the trees read stays the same when every row comes six times, and so do they (F11)."""
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.integers(0, 5, 800), rng.integers(0, 60, 800), rng.integers(0, 3, 800)]).astype(float)
    df = frame(spark, x, (x[:, 0] + rng.normal(size=800) > 2).astype(float))
    more = df.crossJoin(spark.range(6).select(F.col("id").alias("copy")))
    fits = [models.estimator("GradientBoostingClassifier", ["f0", "f1", "f2"], "y", {"n_estimators": 4}).fit(d) for d in (df, more)]
    assert fits[0].info["cells"] == fits[1].info["cells"] <= 800
    a, b = ([r[0] for r in m.transform(df).orderBy("row_id").select("score").collect()] for m in fits)
    assert np.allclose(a, b, atol=1e-9)


def test_boosted_trees_split_off_a_bin_of_one_cell(spark):
    """Over 10,000 cells, of which Spark's trees draw a sample for their thresholds, lose no rare bin (F11)."""
    i = F.col("id")
    rare = [(i == 4000 * k + 7).cast("double").alias(f"r{k}") for k in range(6)]
    df = spark.range(29_760).select((i % 30).alias("a"), (F.floor(i / 30) % 31).alias("b"), F.floor(i / 930).alias("c"),
                                    *rare, (i % 4000 == 7).cast("double").alias("y")).filter("y = 0 OR r0 + r1 + r2 + r3 + r4 + r5 = 1")
    names = ["a", "b", "c", *[f"r{k}" for k in range(6)]]
    m = models.estimator("GradientBoostingClassifier", names, "y", {"n_estimators": 6}).fit(df)
    assert m.info["cells"] > 20_000
    assert (m.info["model"].stages[-1].featureImportances.toArray()[3:] > 0).all()
