"""Expected values of the documented behaviour on small literal inputs."""

import math

import pytest
from pyspark.sql import functions as F

from tabspark.functions import special
from tabspark.functions.scalar import format_number, norm_ppf
from tabspark.operators import encode, fill, grids, project, roles, select, split
from tabspark.operators.transforms import Scaler
from tabspark.sources import io, runs as rs


@pytest.fixture(scope="module")
def abc(spark):
    return spark.createDataFrame([(1, 2, 3), (4, 5, 6), (7, 8, 9)], "a long, b long, c long")


@pytest.mark.parametrize("n,bias,width", [(1, True, 5), (1, False, 4), (2, True, 7), (None, True, 10), (5, True, 10)])
def test_polynomial_width(abc, n, bias, width):
    out = encode.polynomial_features(abc, ["a", "b", "c"], n, include_bias=bias)
    assert len(out.columns) == width
    if bias:
        used = 3 if n is None else min(n, 3)
        assert encode.expected_polynomial_columns(used, 2, 3) == width


def test_polynomial_names_and_values(abc):
    cols = ["a", "b", "c"]
    assert encode.polynomial_features(abc, cols, 2).columns == ["1", "a", "b", "a^2", "a b", "b^2", "c"]
    assert encode.polynomial_features(abc, cols, 2, include_bias=False).columns == ["a", "b", "a^2", "a b", "b^2", "c"]
    assert encode.polynomial_features(abc, cols, 2, interaction_only=True).columns == ["1", "a", "b", "a b", "c"]
    same = encode.polynomial_features(abc, cols, degree=1, include_bias=False)
    assert [tuple(r) for r in same.collect()] == [(1, 2, 3), (4, 5, 6), (7, 8, 9)]
    assert encode.polynomial_features(abc, cols, 2).first()[:] == (1, 1, 2, 1, 2, 4, 3)


def test_polynomial_errors(abc):
    with pytest.raises(ValueError):
        encode.polynomial_features(abc, ["a"], 0)
    with pytest.raises(ValueError):
        encode.polynomial_features(abc, [])


def test_filter_values():
    assert project.filter_values([1, 2, 3, 4, 5], [2, 4]) == [1, 3, 5]
    assert project.filter_values([1, 2, 3, 4], [2, 4, 5], "in") == [2, 4]
    with pytest.raises(NotImplementedError):
        project.filter_values([1], [1], "like")


def test_grids():
    assert grids.truncate(grids.available_grid("Ridge")) == {"alpha": [0.0005, 0.1], "fit_intercept": [True, False]}
    with pytest.raises(ValueError):
        grids.available_grid("Nothing")
    with pytest.raises(ValueError):
        grids.available_grid("Ridge", "random")
    assert set(grids.choose_grid("Lasso", prefix="step")) == {"step__alpha", "step__fit_intercept"}
    assert grids.combine([{"a": 1}, {"a": 2}], [{"b": 3}, {"b": 4}]) == [{"a": 1, "b": 3}, {"a": 2, "b": 4}]
    assert grids.combine({"a": 1}, [{"b": 3}, {"b": 4}]) == [{"a": 1, "b": 3}, {"a": 1, "b": 4}]
    ext = grids.extended_grid("Ridge", pca={"n_components": [2]}, poly={"degree": [1, 2]})
    assert ext["pca__n_components"] == [2] and ext["poly__degree"] == [1, 2]
    lists = grids.grids_per_model({"m": ["Lasso", "LinearSVR"], "nystroem": ["map"], "nystroem__n_components": [10],
                                   "dimensionality_reduction": ["pca"], "dimensionality_reduction__n_components": [2]}, "m")
    assert "nystroem" not in lists[0][0] and "nystroem" in lists[1][0]
    assert lists[0][1]["dimensionality_reduction"] == ["identity"]
    draws = grids.sample(grids.available_grid("Ridge", "bayes"), 20, seed=1)
    assert draws == grids.sample(grids.available_grid("Ridge", "bayes"), 20, seed=1)
    assert all(1e-4 <= t["alpha"] <= 100 for t in draws)
    combos = grids.hurdle_grid("LogisticRegression", "Ridge", scalers=["standard", "robust"])
    assert all(len(v) == 1 for c in combos for v in c.values())
    n = sum(len(grids.expand(g)) for g in grids.available_grid("LogisticRegression")) * 8 * 2
    assert len(combos) == n


def test_every_model_has_a_grid_and_a_space():
    from tabspark.operators.models import CLASSIFIERS, REGRESSORS

    for name in {**REGRESSORS, **CLASSIFIERS}:
        if name != "MBSGDRegressor":
            assert grids.expand(grids.available_grid(name)) and grids.sample(grids.available_grid(name, "bayes"), 2)


def test_roles_rules(spark):
    df = spark.createDataFrame(
        [(i, f"s{i % 3}", i % 2, float(i % 2), i % 4, i * 10, i % 2 == 0, i / 7) for i in range(40)],
        "id long, s string, bin int, fbin double, seq int, gap long, flag boolean, x double")
    got = {r[0]: (r[1], r[2]) for r in roles.role_rows(df)}
    assert got["s"] == ("categorical", "string") and got["bin"] == ("categorical", "binary")
    assert got["fbin"] == ("categorical", "binary") and got["flag"] == ("categorical", "binary")
    assert got["seq"] == ("categorical", "consecutive") and got["id"] == ("categorical", "consecutive")
    assert got["gap"] == ("numerical", "numeric") and got["x"] == ("numerical", "numeric")
    off = {r[0]: r[1] for r in roles.role_rows(df, dummy_is_categorical=False, consecutive_is_categorical=False,
                                              low_unique_is_categorical=False)}
    assert [c for c, r in off.items() if r == "categorical"] == ["s"]
    assert {r[0]: r[1] for r in roles.role_rows(df, exact=False)} == {c: r[0] for c, r in got.items()}


def test_feature_set_decider(spark):
    rows = [(f"t{i % 3}", float(i), math.exp(i / 8)) for i in range(60)]
    df = spark.createDataFrame(rows, "target string, even double, skewed double")
    pick = lambda mode: select.FeatureSetDecider(mode).fit(df).feature_names_out()
    assert pick("categorical") == ["target"] and pick("numerical") == ["even", "skewed"]
    assert pick("skewed") == ["skewed"] and pick("non_skewed") == ["even"]
    with pytest.raises(ValueError):
        select.FeatureSetDecider("other")


def test_onehot_limits(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(30)], "row_id long, c string")
    with pytest.raises(ValueError):
        encode.OneHot(["c"], max_categories=10).fit(df)
    table = encode.category_table(df, ["c"])
    long = encode.encode_long(df, "row_id", ["c"], table)
    assert long.count() == 29


def test_format_number(spark):
    df = spark.createDataFrame([(0.0,), (1e-5,), (0.0005,), (1234.5678,), (-2.0,)], "x double")
    assert [r[0] for r in df.select(format_number(F.col("x"))).collect()] == ["0.000", "0.000", "0.000", "1234.568", "-2.000"]
    assert [r[0] for r in df.select(format_number(F.col("x"), precision=0)).collect()][1:3] == ["1.000e-05", "5.000e-04"]


def test_fill_errors_and_axis(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, 4.0), (3, None, None)], "id long, a double, b double")
    assert fill.fill_missing(df, ["a", "b"], "drop", axis=1).columns == ["id"]
    rows = fill.fill_missing(df, ["a", "b"], "bfill", axis=1).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 1.0, None), (2, 4.0, 4.0), (3, None, None)]
    with pytest.raises(ValueError):
        fill.fill_missing(df, ["a"], "other")
    with pytest.raises(ValueError):
        fill.fill_missing(df, ["a"], "ffill")


def test_renames_and_maps(spark, abc):
    with pytest.raises(KeyError):
        project.rename_columns(abc, {"zz": "y"})
    assert project.rename_keys({"val": {"r2": 1}}, {"r2": "R2"}) == {"val": {"R2": 1}}
    df = project.map_values(spark.createDataFrame([("LOW",), ("HIGH",), ("?",)], "t string"), "t", {0: "LOW", 1: "HIGH"})
    assert [r[0] for r in df.collect()] == [0, 1, None]


def test_special_functions(spark):
    assert abs(special.t_two_sided(2.0, 10) - 0.07338803477074037) < 1e-10
    assert abs(special.f_upper(4.0, 1, 10) - special.t_two_sided(2.0, 10)) < 1e-12
    from statistics import NormalDist

    ps = [1e-9, 1e-4, 0.02, 0.3, 0.5, 0.9, 0.999999]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in ps], "p double").select(norm_ppf(F.col("p"))).collect()]
    assert all(abs(a - NormalDist().inv_cdf(p)) < 1e-9 for a, p in zip(got, ps))


def test_masked_folds(spark):
    df = split.kfold(spark.range(20).withColumnRenamed("id", "row_id"))
    mask = F.col("row_id") % 2 == 0
    train, val = split.fold_part(df, 0, mask=mask)
    assert train.count() == 8 and val.count() == 4
    _, val = split.fold_part(df, 0, mask=mask, only_train=False)
    assert val.count() == 2


def test_box_cox_needs_positive(spark):
    with pytest.raises(ValueError):
        Scaler("box-cox", ["x"]).fit(spark.createDataFrame([(0.0,), (1.0,)], "x double"))


def test_custom_order_and_pivot_errors(spark):
    df = spark.createDataFrame([("train", "A", 1.0), ("odd", "B", 2.0)], "set string, name string, value double")
    with pytest.raises(Exception):
        rs.sort_custom_order(df, "set", ["train"]).collect()
    with pytest.raises(ValueError):
        rs.pivot_outer(df, "name", "set", sort_by="zz")
    with pytest.raises(ValueError):
        rs.pivot_outer(df, "name", "set", sort_by="value", sort_row="zz")
    with pytest.raises(ValueError):
        rs.union_with_origin([df], ["a", "b"])
    wide = rs.pivot_outer(df.filter("set = 'train'").unionByName(spark.createDataFrame([("train", "B", 0.5)], df.schema)),
                          "name", "set", sort_by="value")
    assert wide.columns == ["set", "B", "A"]


def test_nth_best_direction(spark):
    rows = [("r1", "a", "val", "R2", 0.7, 0), ("r2", "b", "val", "R2", -0.2, 0), ("r3", "c", "val", "R2", 0.9, 0),
            ("r1", "a", "val", "RMSE", 3.0, 0), ("r2", "b", "val", "RMSE", 1.0, 0), ("r3", "c", "val", "RMSE", 2.0, 0)]
    df = spark.createDataFrame(rows, "run_id string, name string, set string, metric string, value double, trial long")
    assert rs.nth_best_run(df, "R2").first()["run_id"] == "r3"
    assert rs.nth_best_run(df, "R2", 3).first()["run_id"] == "r2"
    assert rs.nth_best_run(df, "RMSE", 2).first()["run_id"] == "r3"
    neg = rs.parse_cv_results(df.withColumn("value", F.when(F.col("metric") == "RMSE", -F.col("value")).otherwise(F.col("value"))), "R2")
    assert {r["metric"]: r["value"] for r in neg.collect()} == {"R2": 0.9, "RMSE": 2.0}


def test_io_store(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.range(3)
    assert io.load_table(spark, p) is None
    with pytest.raises(FileNotFoundError):
        io.load_table(spark, p, missing="error")
    io.save_object(df, p)
    io.save_object(spark.range(5), p, overwrite=False)
    assert io.load_table(spark, p).count() == 3
    inferred = str(tmp_path / "c")
    io.write_csv(df, inferred)
    assert io.read_csv(spark, inferred).dtypes == [("id", "int")]
    assert io.prediction_path("/x/", "team", "test", "regression") == "/x/team__test__reg_pred"


def test_box_cox_of_zero_at_a_given_lambda(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 1.0), (2, 4.0), (3, None)], "row_id long, v double")
    models = [Scaler("box-cox", ["v"], lambdas={"v": lam}).fit(df) for lam in (0.0, 0.5, 2.0, -1.0)]
    got = {r[0]: tuple(r)[1:] for r in df.select("row_id", *[F.expr(m.forward_sql("v")) for m in models]).collect()}
    assert got == {0: (-math.inf, -2.0, -0.5, -math.inf), 1: (0.0, 0.0, 0.0, 0.0), 2: (math.log(4.0), 2.0, 7.5, 0.75), 3: (None,) * 4}
    with pytest.raises(ValueError):
        Scaler("box-cox", ["v"]).fit(df)
    with pytest.raises(ValueError):
        Scaler("box-cox", ["v"], lambdas={"v": 0.5}).fit(df.withColumn("v", F.col("v") - 1))
