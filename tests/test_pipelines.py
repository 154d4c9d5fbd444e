"""Pipeline search, saved models, margin machines and scorers against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import fitted, grids, margins, models, pipelines, scorers, search, transforms, twopart
from tabspark.operators.encode import OneHotModel
from tabspark.operators.select import FeatureSetModel


def frame(spark, x, y, names):
    rows = [(i, int(i % 3), *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id bigint, fold bigint, " + ", ".join(f"{n} double" for n in names) + ", y double").persist()


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(240, 3)) * [1.0, 5.0, 0.2] + [0.0, 3.0, -1.0]
    y = 9 + 2 * x[:, 0] - x[:, 1] ** 2 / 5 + 3 * x[:, 2] + rng.normal(size=240) * 0.1
    return frame(spark, x, y, "abc"), x, y


def rmse(x, y, fold, k, fit):
    tr, va = fold != k, fold == k
    p = fit(x[tr], y[tr], x[va])
    return math.sqrt(np.mean((y[va] - p) ** 2))


def ridge(alpha):
    def fit(x, y, v):
        mx, my = x.mean(0), y.mean()
        b = np.linalg.solve((x - mx).T @ (x - mx) + alpha * np.eye(x.shape[1]), (x - mx).T @ (y - my))
        return (v - mx) @ b + my
    return fit


def scaled(inner, then=lambda z: z):
    def fit(x, y, v):
        m, s = x.mean(0), x.std(0)
        a, b = then((x - m) / s), then((v - m) / s)
        return inner(a, y, b)
    return fit


def pca(k, inner):
    def fit(x, y, v):
        m = x.mean(0)
        _, vec = np.linalg.eigh(np.cov((x - m).T))
        w = vec[:, ::-1][:, :k]
        return inner((x - m) @ w, y, (v - m) @ w)
    return fit


def squares(z):
    i, j = np.triu_indices(z.shape[1])
    return np.column_stack([z, z[:, i] * z[:, j]])


def means(results, metric="RMSE", side="val"):
    rows = results.filter((F.col("metric") == metric) & (F.col("set") == side)).groupBy("trial").agg(F.avg("value").alias("v")).collect()
    return {r["trial"]: r["v"] for r in rows}


def test_steps_are_refitted_per_fold(data):
    df, x, y = data
    fold = np.arange(240) % 3
    pipeline = [("scaler", "standard"), ("poly", "identity"), ("pca", "identity"), ("regressor", "Ridge")]
    trials = [{"regressor__alpha": 0.1}, {"regressor__alpha": 10.0}, {"poly": "poly", "poly__degree": 2, "regressor__alpha": 0.1},
              {"pca": "pca", "pca__n_components": 1, "regressor__alpha": 0.1}, {"pca": "pca", "pca__n_components": 2, "regressor__alpha": 0.1},
              {"scaler": "identity", "regressor__alpha": 10.0}]
    got = means(pipelines.search(df, list("abc"), "y", pipeline, trials))
    plain = [scaled(ridge(0.1)), scaled(ridge(10.0)), scaled(ridge(0.1), squares), scaled(pca(1, ridge(0.1))), scaled(pca(2, ridge(0.1))), ridge(10.0)]
    for t, fit in enumerate(plain):
        assert abs(got[t] - np.mean([rmse(x, y, fold, k, fit) for k in range(3)])) < 1e-6, trials[t]


def test_k_best_and_landmarks_take_effect(data):
    df, x, y = data
    fold = np.arange(240) % 3
    pipeline = [("select_k_best", "select_k_best"), ("regressor", "LinearRegression")]
    got = means(pipelines.search(df, list("abc"), "y", pipeline, [{"select_k_best__k": k} for k in (1, 2, "all")]))

    def best(k):
        def fit(a, t, v):
            r = [abs(np.corrcoef(a[:, i], t)[0, 1]) for i in range(3)]
            keep = sorted(np.argsort(r)[::-1][:k])
            return ridge(0.0)(a[:, keep], t, v[:, keep])
        return fit
    for t, k in enumerate((1, 2, 3)):
        assert abs(got[t] - np.mean([rmse(x, y, fold, f, best(k)) for f in range(3)])) < 1e-6
    mapped = means(pipelines.search(df, list("abc"), "y", [("scaler", "standard"), ("nystroem", "nystroem"), ("regressor", "Ridge")],
                                    [{"nystroem__n_components": 5, "regressor__alpha": 0.01}, {"nystroem__n_components": 60, "regressor__alpha": 0.01}]))
    assert mapped[1] < 0.7 * mapped[0]


def test_k_best_by_neighbours(data):
    """The class depends on |b - 3| only, which an F score does not see."""
    df = data[0].withColumn("y", (F.abs(F.col("b") - 3) > 4).cast("double"))
    steps = [("k", "select_k_best"), ("m", "GaussianNB")]
    chosen = pipelines.fit_pipeline(df, list("abc"), "y", steps, {"k__k": 1, "k__score_func": "mutual_info_neighbours"})
    alone = pipelines.fit_pipeline(df, ["b"], "y", steps[1:], {})
    assert rows(chosen.transform(df), "prediction") == rows(alone.transform(df), "prediction")
    with pytest.raises(ValueError, match="needs a class"):
        pipelines.fit_pipeline(df, list("abc"), "a", [steps[0], ("m", "Ridge")], {"k__k": 1, "k__score_func": "mutual_info_neighbours"})


def test_unknown_keys_raise(data):
    df = data[0]
    pipeline = [("pca", "pca"), ("regressor", "Ridge")]
    for bad in ({"nonsense": 1}, {"pca__n": 2}, {"regressor__beta": 1.0}, {"pca": "lle"}, {"regressor": "Nothing"}):
        with pytest.raises(ValueError):
            pipelines.search(df, list("abc"), "y", pipeline, [bad])
    with pytest.raises(ValueError):
        search.cross_validate(df, list("abc"), "y", "Ridge", [{"pca__n_components": 1}])


def test_equal_trials_are_one_fit(data):
    a = pipelines.resolve([("m", "LogisticRegression")], {"m__C": 1, "m__dual": True, "m__solver": "lbfgs"})
    assert a == pipelines.resolve([("m", "LogisticRegression")], {"m__C": 1, "m__dual": False})


def test_hurdle_grid_runs_in_the_search(spark, data):
    df, x, y = data
    y = np.where(y > 0, y, 0.0)
    df = frame(spark, x, y, "abc")
    trials = [{"model__clf_params__C": c, "model__reg_params__alpha": a} for c in (0.1, 10.0) for a in (0.01, 100.0)]
    trials = [{**t, "model__reg_name": "Ridge"} for t in trials]
    got = means(pipelines.search(df, list("abc"), "y", [("scaler", "standard"), ("model", "HurdleRegression")], trials))
    for t, trial in enumerate(trials):
        errs = []
        for k in range(3):
            model = pipelines.fit_pipeline(df.filter(F.col("fold") != k), list("abc"), "y", [("scaler", "standard"), ("model", "HurdleRegression")], trial)
            out = np.array(model.transform(df.filter(F.col("fold") == k)).select("y", "prediction").collect())
            errs.append(math.sqrt(np.mean((out[:, 0] - out[:, 1]) ** 2)))
        assert abs(got[t] - np.mean(errs)) < 1e-6
    assert search.task_of("HurdleRegression") == "regression"
    assert search.cross_validate(df, list("abc"), "y", "HurdleRegression", [{"clf_params": {"C": 1.0}}]).count() == 2 * 3 * 5


def test_scorers_refit_the_search(spark, data):
    df = data[0].withColumn("y", F.when(F.col("y") > 0, 1.0).otherwise(0.0))
    trials = [{"m__C": c} for c in (0.001, 1.0)]
    own = [scorers.cost_gain(tp=5, fp=-1, fn=-3), scorers.FALSE_POSITIVE_RATE]
    res = pipelines.search(df, list("abc"), "y", [("m", "LogisticRegression")], trials, scorers=own)
    got = {(r["trial"], r["fold"], r["metric"]): r["value"] for r in res.filter("set = 'val'").collect()}
    fit = pipelines.fit_pipeline(df.filter("fold != 1"), list("abc"), "y", [("m", "LogisticRegression")], trials[1])
    cm = {(r["y"], r["prediction"]): r["count"] for r in fit.transform(df.filter("fold = 1")).groupBy("y", "prediction").count().collect()}
    gain = 5 * cm.get((1.0, 1.0), 0) - cm.get((0.0, 1.0), 0) - 3 * cm.get((1.0, 0.0), 0)
    assert got[1, 1, "cost_gain"] == gain
    assert abs(got[1, 1, "fpr"] - cm.get((0.0, 1.0), 0) / (cm.get((0.0, 1.0), 0) + cm.get((0.0, 0.0), 0))) < 1e-12
    best, _ = pipelines.best_pipeline(df, res, list("abc"), "y", [("m", "LogisticRegression")], trials, "fpr", own)
    by = means(res, "fpr")
    assert by[best] == min(by.values())


def rows(df, *cols):
    return sorted(map(tuple, df.select("row_id", *cols).collect()))


@pytest.mark.parametrize("name,params", [
    ("LinearRegression", {}), ("Ridge", {"alpha": 2.0}), ("Lasso", {"alpha": 0.1}), ("PoissonRegressor", {"alpha": 0.1}), ("GradientBoostingRegressor", {"n_estimators": 3}),
    ("SGDRegressor", {"loss": "huber"}), ("LinearSVR", {"C": 1.0}), ("KernelRidge", {"kernel": "rbf", "n_components": 10}),
    ("NuSVR", {"nu": 0.5, "n_components": 10}), ("LogisticRegression", {}), ("RidgeClassifier", {}), ("KNeighborsClassifier", {}),
    ("LinearDiscriminantAnalysis", {}), ("QuadraticDiscriminantAnalysis", {}), ("GaussianNB", {}), ("SVC", {"n_components": 10}),
    ("NuSVC", {"nu": 0.5, "n_components": 10})])
def test_models_score_alike_after_reload(data, tmp_path, name, params):
    df = data[0].withColumn("y", F.abs("y") if name in models.REGRESSORS else F.when(F.col("y") > 0, 1.0).otherwise(0.0))
    model = models.estimator(name, list("abc"), "y", params).fit(df)
    model.write().save(str(tmp_path / "m"))
    assert rows(fitted.load(str(tmp_path / "m")).transform(df), "prediction") == rows(model.transform(df), "prediction")


def test_compositions_score_alike_after_reload(spark, data, tmp_path):
    df = data[0].withColumn("y", F.greatest("y", F.lit(0.0)))
    hurdle = twopart.HurdleRegression(list("abc"), "y").fit(df)
    hurdle.write().save(str(tmp_path / "h"))
    again = fitted.load(str(tmp_path / "h"))
    assert isinstance(again, twopart.HurdleModel)
    assert rows(again.transform(df), "prediction") == rows(hurdle.transform(df), "prediction")
    assert rows(again.expected_value(df), "prediction") == rows(hurdle.expected_value(df), "prediction")
    target = models.transformed_target(df, "Ridge", list("abc"), "y")
    target.write().save(str(tmp_path / "t"))
    assert rows(fitted.load(str(tmp_path / "t")).transform(df), "prediction") == rows(target.transform(df), "prediction")
    whole = pipelines.fit_pipeline(df, list("abc"), "y", [("s", "robust"), ("p", "poly"), ("k", "select_k_best"), ("n", "nystroem"), ("m", "Ridge")],
                                   {"k__k": 4, "n__n_components": 8})
    whole.write().overwrite().save(str(tmp_path / "w"))
    assert rows(fitted.load(str(tmp_path / "w")).transform(df), "prediction") == rows(whole.transform(df), "prediction")


def test_transformers_survive_a_pipeline_model(spark, data, tmp_path):
    from pyspark.ml import PipelineModel

    df = data[0].withColumn("g", F.when(F.col("a") > 0, "x").otherwise("y"))
    stages = [transforms.Scaler("yeo-johnson", ["a"], standardize=True).fit(df), OneHotModel({"g": ["x", "y"]}), FeatureSetModel(["a", "g_y"], ("row_id",)),
              transforms.Scaler(("sqrt(abs({x}))", "{x} * {x}"), ["a"]).fit(df)]
    PipelineModel(stages).write().save(str(tmp_path / "p"))
    assert rows(PipelineModel.load(str(tmp_path / "p")).transform(df), "a", "g_y") == rows(PipelineModel(stages).transform(df), "a", "g_y")


def test_own_functions_cannot_be_saved(data, tmp_path):
    with pytest.raises(ValueError):
        models.Fitted(lambda d: d).write().save(str(tmp_path / "f"))


def test_own_transform_pair_inverts(data):
    own = transforms.Scaler(("exp({x} / 10D)", "10D * ln({x})"), ["b"]).fit(data[0])
    back = own.inverse(own.transform(data[0]))
    assert np.allclose([r[1] for r in rows(back, "b")], [r[1] for r in rows(data[0], "b")])


def test_nu_bounds_the_margin_errors(data):
    df, x, y = data
    df = df.withColumn("y", F.when(F.col("y") > 0, 1.0).otherwise(0.0))
    label = np.where(y > 0, 1.0, -1.0)
    seen = []
    for nu in (0.6, 0.8):  # below, the classes overlap too much for a margin
        m = margins.fit(df, list("abc"), "y", "nu_hinge", 1.0, nu)
        value = label * (x @ m.coef + m.intercept)
        assert np.mean(value < m.margin - 1e-9) <= nu <= np.mean(value <= m.margin + 1e-6 * abs(m.margin)) + 1e-9
        seen.append(m.margin)
    assert seen[0] < seen[1]
    with pytest.raises(ValueError):
        margins.fit(df, list("abc"), "y", "nu_hinge", 1.0, 0.999)
    for nu in (0.1, 0.6):
        m = margins.fit(data[0], list("abc"), "y", "nu_insensitive", 1e-3, nu)
        r = np.abs(y - x @ m.coef - m.intercept)
        assert np.mean(r > m.margin + 1e-9) <= nu <= np.mean(r >= m.margin - 1e-9) + 1e-9


def test_hinge_reaches_its_dual(data):
    df, x, y = data
    df = df.withColumn("y", F.when(F.col("y") > 0, 1.0).otherwise(0.0))
    label = np.where(y > 0, 1.0, -1.0)
    for alpha in (1.0 / 240, 0.1):
        m = margins.fit(df, list("abc"), "y", "hinge", alpha)
        value = np.maximum(0, 1 - label * (x @ m.coef + m.intercept)).mean() + alpha / 2 * m.coef @ m.coef
        assert abs(value - m.objective) < 1e-9 and -1e-6 <= m.gap <= 0.01 * m.objective
    m = margins.fit(data[0], list("abc"), "y", "epsilon_insensitive", 0.01, epsilon=0.5)
    assert -1e-6 <= m.gap <= 0.01 * m.objective


def test_positive_least_squares(data):
    df, x, y = data
    model = models.estimator("LinearRegression", list("abc"), "y", {"positive": True}).fit(df)
    coef = model.info["fit"].coef
    assert (coef >= 0).all() and coef[1] == 0.0
    mx = x[:, [0, 2]] - x[:, [0, 2]].mean(0)
    assert np.allclose(coef[[0, 2]], np.linalg.lstsq(mx, y - y.mean(), rcond=None)[0])


def test_thresholds_are_tuned_on_rows_not_seen(data):
    df = data[0].withColumn("y", F.when(F.col("y") > 9, 1.0).otherwise(0.0))
    model, curve = pipelines.tune_threshold(df, list("abc"), "y", [("s", "standard"), ("m", "LogisticRegression")], {"m__C": 0.1})
    rows_ = {r["threshold"]: r["score"] for r in curve.collect()}
    best = max(rows_.values())
    assert model.state["threshold"] == min(t for t, v in rows_.items() if abs(v - best) < 1e-12)
    out = model.transform(df).collect()
    assert all((r["score"] >= model.state["threshold"]) == (r["prediction"] == 1.0) for r in out)


def test_quantiles_with_nan_are_alike_at_every_size(spark):
    from tabspark.operators.quantiles import exact_quantiles

    df = spark.createDataFrame([(float(i % 37),) for i in range(400)] + [(float("nan"),)] * 5 + [(None,)] * 3, "x double")
    for probs in ([0.0, 0.5, 0.999, 1.0], [i / 60 for i in range(61)]):
        small, large = (exact_quantiles(df, {"x": F.col("x")}, probs, limit=n)["x"] for n in (10_000, 10))
        assert np.array_equal(small, large, equal_nan=True) and math.isnan(large[-1]) and large[0] == 0.0


def test_every_grid_and_space_fits_its_model():
    for name, grid in grids.GRIDS.items():
        for trial in grids.expand(grid) + grids.sample(grids.available_grid(name, "bayes"), 5):
            assert set(models.effective(name, trial)) <= set(trial)
