"""Searches over pipelines, refits by scorers of one's own, and saved models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabspark.operators import fitted, grids, metrics, models, pipelines, scorers, twopart
from tabspark.plans.fitting import hashed_folds
from tabspark.plans.registry import query, tidy
from tabspark.sources import fixtures as fx, io, runs

_FOLD = "('0x' || substr(md5('42:' || row_id), 1, 8))::BIGINT % 5 AS fold"


def _val_means(results, *trials):
    """Mean held-out value of each trial with its settings."""
    rows = results.filter("set = 'val'").groupBy("trial", "metric").agg(F.avg("value").alias("value"))
    cells = F.create_map(*[F.lit(x) for i, t in enumerate(trials) for x in (i, str(t))])
    return rows.withColumn("setting", cells[F.col("trial").cast("int")])


# --- steps refitted per fold --------------------------------------------------------------------

_POLY = f"""f AS (SELECT n_chars AS y, n_words AS x, n_words * n_words AS z, {_FOLD} FROM doc_feat),
    m AS (SELECT k, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) AS xx, var_pop(z) AS zz, covar_pop(x, z) AS xz,
      covar_pop(y, x) AS xy, covar_pop(y, z) AS zy FROM f, (SELECT unnest(range(5)) AS k) WHERE fold <> k GROUP BY k),
    b AS (SELECT *, 1 AS degree, xy / xx AS b1, 0.0::DOUBLE AS b2 FROM m
      UNION ALL SELECT *, 2, (xy * zz - zy * xz) / (xx * zz - xz * xz), (zy * xx - xy * xz) / (xx * zz - xz * xz) FROM m),
    e AS (SELECT degree, k, sqrt(avg(power(y - my - b1 * (x - mx) - b2 * (z - mz), 2))) AS e FROM f JOIN b ON f.fold = b.k GROUP BY degree, k)"""


@query("pipeline_poly_search", "SELECT degree::BIGINT AS degree, round(avg(e), 3) AS rmse FROM e GROUP BY degree", using=("doc_feat",), extra=_POLY)
def pipeline_poly_search(spark, d):
    """Polynomial degrees 1 and 2 under a scaler: each fold fits its own scaler and terms."""
    df = hashed_folds(fx.doc_feat(spark, d))
    trials = [{"poly__degree": k} for k in (1, 2)]
    res = pipelines.search(df, ["n_words"], "n_chars", [("scaler", "standard"), ("poly", "poly"), ("regressor", "LinearRegression")], trials)
    means = _val_means(res, *trials).filter("metric = 'RMSE'")
    return tidy(means.select((F.col("trial") + 1).alias("degree"), F.col("value").alias("rmse")), digits=3)


_SCALED = f"""f AS (SELECT n_chars AS y, n_words AS x, {_FOLD} FROM doc_feat),
    t AS (SELECT * FROM (VALUES (0, 'standard'), (1, 'identity')) s(i, scaler), (VALUES (0, 10.0::DOUBLE), (1, 1000.0::DOUBLE)) a(j, alpha)),
    m AS (SELECT k, count(*)::DOUBLE AS n, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sd, covar_pop(y, x) AS c
      FROM f, (SELECT unnest(range(5)) AS k) WHERE fold <> k GROUP BY k),
    e AS (SELECT 2 * i + j AS trial, scaler, alpha, k, sqrt(avg(power(y - my - (x - mx) / w * (n * c / w) / (n * sd * sd / (w * w) + alpha), 2))) AS e
      FROM f JOIN (SELECT *, CASE WHEN scaler = 'standard' THEN sd ELSE 1.0 END AS w FROM m, t) b ON f.fold = b.k GROUP BY ALL)"""


@query("pipeline_scaler_search", """SELECT trial::BIGINT AS trial, scaler, alpha, round(avg(e), 4) AS rmse, rank() OVER (ORDER BY avg(e))::BIGINT AS rank
       FROM e GROUP BY trial, scaler, alpha""", using=("doc_feat",), extra=_SCALED)
def pipeline_scaler_search(spark, d):
    """A penalty means something else behind a scaler: both settings, two penalties."""
    df = hashed_folds(fx.doc_feat(spark, d))
    trials = grids.expand({"scaler": ["standard", "identity"], "regressor__alpha": [10.0, 1000.0]})
    res = pipelines.search(df, ["n_words"], "n_chars", [("scaler", "standard"), ("regressor", "Ridge")], trials)
    means = _val_means(res, *trials).filter("metric = 'RMSE'").orderBy("value").select("trial", "value").collect()
    rank = {r["trial"]: 1 + sum(o["value"] < r["value"] for o in means) for r in means}
    rows = [(r["trial"], trials[r["trial"]]["scaler"], trials[r["trial"]]["regressor__alpha"], r["value"], rank[r["trial"]]) for r in means]
    return tidy(spark.createDataFrame(rows, "trial bigint, scaler string, alpha double, rmse double, rank bigint"), digits=4, exact=("alpha",))


_BAYES = f"""u AS (SELECT row_id, n_events AS x, CASE WHEN y > 0 THEN 1 ELSE 0 END AS label, {_FOLD} FROM user_day),
    tot AS (SELECT k, 1e-9 * var_pop(x) AS eps, count(*)::DOUBLE AS n FROM u, (SELECT unnest(range(5)) AS k) WHERE fold <> k GROUP BY k),
    c AS (SELECT k, label, avg(x) AS m, var_pop(x) + any_value(eps) AS v, ln(count(*) / any_value(n)) AS prior FROM u JOIN tot ON u.fold <> tot.k GROUP BY k, label),
    p AS (SELECT row_id, any_value(u.label) AS y, any_value(k) AS k, max_by(c.label, c.prior - 0.5 * ln(2 * pi() * c.v) - power(x - c.m, 2) / (2 * c.v)) AS p
      FROM u JOIN c ON u.fold = c.k GROUP BY row_id),
    cells AS (SELECT k, count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 1) AS fp, count(*) FILTER (y = 1 AND p = 0) AS fn,
      count(*) FILTER (y = 0 AND p = 0) AS tn FROM p GROUP BY k)"""


@query("scorer_search", """SELECT k::BIGINT AS fold, metric, CASE metric WHEN 'cost_gain' THEN 5.0 * tp - fp - 3.0 * fn ELSE round(fp / (fp + tn), 9) END::DOUBLE AS value
       FROM cells, (SELECT unnest(['cost_gain', 'fpr']) AS metric)""", using=("user_day",), extra=_BAYES)
def scorer_search(spark, d):
    """Gain by the cells of the confusion matrix and false-positive rate, as scorers of a search."""
    df = hashed_folds(fx.user_day(spark, d).withColumn("label", F.when(F.col("y") > 0, 1.0).otherwise(0.0)))
    own = [scorers.cost_gain(tp=5.0, fp=-1.0, fn=-3.0), scorers.FALSE_POSITIVE_RATE]
    res = pipelines.search(df, ["n_events"], "label", [("m", "GaussianNB")], [{}], scorers=own)
    return tidy(res.filter("set = 'val' AND metric IN ('cost_gain', 'fpr')").select("fold", "metric", "value"), digits=9)


# --- two-part models ----------------------------------------------------------------------------

@query("hurdle_grid_search")
def hurdle_grid_search(spark, d):
    """A hurdle grid in a pipeline: each part is fitted once per fold and setting, not once per trial."""
    df = hashed_folds(fx.user_day(spark, d))
    clf = {f"hurdle__clf_params__{k}": v for k, v in grids.truncate(grids.choose_grid("LogisticRegression")[0]).items() if k in ("penalty", "C")}
    reg = {f"hurdle__reg_params__{k}": v for k, v in grids.choose_grid("Ridge").items() if k == "alpha"}
    trials = grids.expand({**clf, **reg, "hurdle__reg_name": ["Ridge"]})
    res = pipelines.search(df, fx.USER_DAY_FEATURES, "y", [("scaler", "standard"), ("hurdle", pipelines.HURDLE)], trials)
    return tidy(_val_means(res, *trials).select("trial", "setting", "metric", "value"))


_PARTS = """u AS (SELECT row_id, n_events AS x, y, CASE WHEN y = 0 THEN 1 ELSE 0 END AS zero FROM user_day),
    c AS (SELECT zero, avg(x) AS m, var_pop(x) + 1e-9 * (SELECT var_pop(x) FROM u) AS v, ln(count(*)::DOUBLE / (SELECT count(*) FROM u)) AS prior FROM u GROUP BY zero),
    r AS (SELECT covar_pop(y, x) / var_pop(x) AS b, avg(y) - avg(x) * covar_pop(y, x) / var_pop(x) AS q FROM u WHERE y > 0)"""


@query("two_part_reload", """SELECT row_id::BIGINT AS row_id, round(CASE WHEN zero = 0 THEN x * b + q ELSE 0 END, 6) + 0.0 AS prediction FROM (
       SELECT row_id, any_value(x) AS x, max_by(c.zero, c.prior - 0.5 * ln(2 * pi() * c.v) - power(x - c.m, 2) / (2 * c.v)) AS zero FROM u, c GROUP BY row_id), r""",
       using=("user_day",), extra=_PARTS)
def two_part_reload(spark, d):
    """A zero classifier and a regressor in one model, saved, read again and scored."""
    df = fx.user_day(spark, d).withColumn("zero", F.when(F.col("y") == 0, 1.0).otherwise(0.0))
    model = twopart.ZeroInflatedModel(models.estimator("GaussianNB", ["n_events"], "zero").fit(df),
                                      models.estimator("LinearRegression", ["n_events"], "y").fit(df.filter("y > 0")))
    path = io.scratch_dir(spark, "model")
    model.write().save(path)
    return tidy(fitted.load(path).transform(df).select("row_id", "prediction"))


@query("run_record", f"""SELECT 'best' AS what, 'LinearRegression' AS name, round(avg(e), 3) AS value FROM e WHERE degree = (SELECT degree FROM e GROUP BY degree ORDER BY avg(e) LIMIT 1)
       UNION ALL SELECT 'trials', 'LinearRegression', 2.0::DOUBLE""", using=("doc_feat",), extra=_POLY)
def run_record(spark, d):
    """A search saved as a run with its grid, results, best parameters, time and model, and read back."""
    df = hashed_folds(fx.doc_feat(spark, d))
    grid = {"poly__degree": [1, 2]}
    folder = runs.save_search(df, ["n_words"], "n_chars", [("scaler", "standard"), ("poly", "poly"), ("regressor", "LinearRegression")], grid,
                              io.scratch_dir(spark, "runs"), metric="RMSE")
    record, results, model = runs.load_search(spark, folder)
    score = metrics.regression_metrics(model.transform(df), "n_chars", "prediction").first()["RMSE"]
    if not score > 0 or record["grid"] != [grid]:
        raise ValueError("the saved run is not what was searched")
    value = results.filter(f"trial = {record['best_trial']} AND set = 'val' AND metric = 'RMSE'").agg(F.avg("value")).first()[0]
    return tidy(spark.createDataFrame([("best", record["model"], value), ("trials", record["model"], float(record["n_trials"]))],
                                      "what string, name string, value double"), digits=3)


# --- thresholds on rows the fit has not seen ----------------------------------------------------

_OUT_OF_FOLD = _BAYES + """, sc AS (SELECT row_id, u.label AS y, k AS fold, c.label AS cl, c.prior - 0.5 * ln(2 * pi() * c.v) - power(x - c.m, 2) / (2 * c.v) AS s
      FROM u JOIN c ON u.fold = c.k),
    o AS (SELECT row_id, any_value(y) AS y, any_value(fold) AS fold, 1.0 / (1.0 + exp(max(s) FILTER (cl = 0) - max(s) FILTER (cl = 1))) AS score FROM sc GROUP BY row_id),
    cv AS (SELECT t, avg((CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END
      + CASE WHEN 2 * tn + fp + fn > 0 THEN 2 * tn / (2 * tn + fp + fn) ELSE 0 END) / 2) AS score FROM (
      SELECT t, fold, count(*) FILTER (y = 1 AND score >= t)::DOUBLE AS tp, count(*) FILTER (y = 0 AND score >= t)::DOUBLE AS fp,
        count(*) FILTER (y = 1 AND score < t)::DOUBLE AS fn, count(*) FILTER (y = 0 AND score < t)::DOUBLE AS tn
      FROM o, (SELECT unnest(range(100)) / 99.0::DOUBLE AS t) GROUP BY t, fold) GROUP BY t)"""


@query("cross_fitted_threshold", "SELECT round(t, 9) AS threshold, round(score, 6) AS score FROM cv", using=("user_day",), extra=_OUT_OF_FOLD)
def cross_fitted_threshold(spark, d):
    """The objective at every threshold, each row scored by a fit on the other folds."""
    df = hashed_folds(fx.user_day(spark, d).withColumn("label", F.when(F.col("y") > 0, 1.0).otherwise(0.0)))
    _, curve = pipelines.tune_threshold(df, ["n_events"], "label", [("m", "GaussianNB")], {})
    return tidy(curve, threshold=9)
