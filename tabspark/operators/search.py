"""Cross-validated search over parameter trials, and the model-search driver."""

from __future__ import annotations

import logging
import math
from multiprocessing.pool import ThreadPool

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabspark.functions.scalar import dbl, ident
from tabspark.operators import gram as G, grids
from tabspark.operators.metrics import CLASSIFICATION, REGRESSION, minimised, regression_by
from tabspark.operators.models import CLASSIFIERS, REGRESSORS, effective, estimator, from_moments
from tabspark.operators.small import small_table

log = logging.getLogger(__name__)
# Models whose fits follow from moments, with their default parameters.
MOMENT_MODELS = {"LinearRegression": {}, "Ridge": {"alpha": 1.0}}
RESULT_SCHEMA = "trial bigint, params string, fold bigint, set string, metric string, value double"


def task_of(model: str) -> str:
    if model in CLASSIFIERS:
        return "classification"
    if model in REGRESSORS or model == "HurdleRegression":
        return "regression"
    raise ValueError(f"unknown model {model!r}")


def metrics_by_set(scored: DataFrame, label: str, by: str, task: str) -> list[tuple[str, str, float]]:
    """(set, metric, value) of a scored table from one or two aggregates."""
    if task == "regression":
        rows = regression_by(scored, label, "prediction", by).collect()
        return [(r[by], m, float(r[m]) if r[m] is not None else math.nan) for r in rows for m in REGRESSION]
    counts = scored.groupBy(ident(by), dbl(label).alias("y"), dbl("prediction").alias("p")).count().collect()
    out = []
    for s in sorted({r[by] for r in counts}):
        cm = {(r["y"], r["p"]): r["count"] for r in counts if r[by] == s}
        classes = sorted({k for pair in cm for k in pair})
        tp = {c: cm.get((c, c), 0) for c in classes}
        sup = {c: sum(v for (y, _), v in cm.items() if y == c) for c in classes}
        pred = {c: sum(v for (_, p), v in cm.items() if p == c) for c in classes}
        k, n = len(classes), sum(cm.values())
        values = (sum(tp[c] / pred[c] for c in classes if pred[c]) / k,
                  sum(tp[c] / sup[c] for c in classes if sup[c]) / k,
                  sum(2 * tp[c] / (pred[c] + sup[c]) for c in classes if pred[c] + sup[c]) / k,
                  sum(tp.values()) / n)
        out += [(s, m, v) for m, v in zip(CLASSIFICATION, values)]
    return out


def cross_validate(df: DataFrame, features: list[str], label: str, model: str, trials: list[dict],
                   fold: str = "fold", mask: Column | None = None, parallelism: int = 4) -> DataFrame:
    """Long results, one row per (trial, fold, set, metric); a failed fit scores NaN.

    The folded table is cached once and shared by every fit; trials are Spark
    jobs submitted from a few driver threads.  Moment models take every fold's fit
    from one pass of per-fold moments.
    """
    task = task_of(model)
    if model == "HurdleRegression":
        from tabspark.operators import pipelines

        return pipelines.search(df, features, label, [("model", model)], [{f"model__{k}": v for k, v in t.items()} for t in trials],
                                fold, mask=mask, parallelism=parallelism)
    for t in trials:
        effective(model, t)  # an unknown parameter is an error, not a trial like another
    folds = sorted(r[0] for r in df.select(ident(fold)).distinct().collect())
    data = df.persist()

    def run(job):
        t, params, k = job
        try:
            if model in MOMENT_MODELS:
                rest = total - moments[k] if k in moments else total
                fitted = from_moments(rest, features, label, {**MOMENT_MODELS[model], **params})
            else:
                train = data.filter(F.col(ident(fold)) != k)
                fitted = estimator(model, features, label, params).fit(train.filter(mask) if mask is not None else train)
            tagged = data.withColumn("__set", F.when(F.col(ident(fold)) == k, "val").otherwise("train"))
            if mask is not None:
                tagged = tagged.filter((F.col("__set") == "val") | mask)
            scores = metrics_by_set(fitted.transform(tagged), label, "__set", task)
        except (ArithmeticError, ValueError, IllegalArgumentException) as err:  # a combination that cannot be fitted
            log.warning("trial %s fold %s failed: %s", t, k, str(err)[:200])
            names = CLASSIFICATION if task == "classification" else REGRESSION
            scores = [(s, m, math.nan) for s in ("train", "val") for m in names]
        return [(t, str(params), int(k), s, m, float(v)) for s, m, v in scores]

    if model in MOMENT_MODELS:
        moments = G.grams_by(data.filter(mask) if mask is not None else data, [*features, label], fold)
        total = G.sum_grams(moments.values())
    jobs = [(t, p, k) for t, p in enumerate(trials) for k in folds]
    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
        rows = [r for part in pool.imap(run, jobs) for r in part]
    data.unpersist()
    if rows and all(math.isnan(r[-1]) for r in rows):
        raise ValueError(f"no trial of {model} could be fitted; the log has the reasons")
    return small_table(df.sparkSession, rows, RESULT_SCHEMA)


def summarize(results: DataFrame) -> DataFrame:
    """Mean over folds with the rank per (set, metric); ties share the lowest rank, NaN is last."""
    mean = results.groupBy("trial", "params", "set", "metric").agg(F.avg("value").alias("value"))
    key = F.when(F.isnan("value"), F.lit(math.inf)).when(
        F.col("metric").isin(*[m for m in REGRESSION if minimised(m)]), F.col("value")).otherwise(-F.col("value"))
    w = Window.partitionBy("set", "metric").orderBy("__key")
    return mean.withColumn("__key", key).withColumn("rank", F.rank().over(w).cast("bigint")).drop("__key")


def best_trial(summary: DataFrame, metric: str) -> int:
    row = (summary.filter((F.col("set") == "val") & (F.col("metric") == metric))
           .orderBy("rank", "trial").select("trial").first())
    if row is None:
        raise ValueError(f"no results for metric {metric!r}")
    return row[0]


def grid_search(df, features, label, model, grid=None, subset: int | None = None, **options) -> DataFrame:
    """Every combination of a grid (by default the model's own, optionally truncated)."""
    grid = grids.available_grid(model) if grid is None else grid
    if subset:
        grid = grids.truncate(grid, subset)
    return summarize(cross_validate(df, features, label, model, grids.expand(grid), **options))


def random_search(df, features, label, model, n_trials: int = 10, space=None, seed: int = 42, **options) -> DataFrame:
    """Seeded draws from the model's space."""
    space = grids.available_grid(model, "bayes") if space is None else space
    return summarize(cross_validate(df, features, label, model, grids.sample(space, n_trials, seed), **options))


DEFAULT_REFIT = {"regression": "RMSE", "classification": "precision"}


def model_search(train: DataFrame, test: DataFrame, features: list[str], label: str, candidates: dict,
                 task: str, refit: str | None = None, root: str | None = None, subset: int | None = None,
                 **options) -> DataFrame:
    """Search per model, refit the best trial, score train, val and test; optionally save the runs.

    ``candidates`` maps a model name to its grid (None: the built-in one).
    """
    from tabspark.sources.runs import append_runs

    refit = refit or DEFAULT_REFIT.get(task)
    names = {"regression": REGRESSION, "classification": CLASSIFICATION}.get(task)
    if names is None:
        raise ValueError(f"unknown task {task!r}")
    if refit not in names:
        raise ValueError(f"refit metric {refit!r} is not one of {names}")
    rows = []
    for model, grid in candidates.items():
        if task_of(model) != task:
            raise ValueError(f"{model} is not a {task} model")
        grid = grids.available_grid(model) if grid is None else grid
        trials = grids.expand(grids.truncate(grid, subset) if subset else grid)
        summary = summarize(cross_validate(train, features, label, model, trials, **options)).persist()
        best = best_trial(summary, refit)
        fitted = estimator(model, features, label, trials[best]).fit(train)
        scores = {("val", r["metric"]): r["value"] for r in
                  summary.filter((F.col("trial") == best) & (F.col("set") == "val")).collect()}
        tagged = train.withColumn("__set", F.lit("train")).unionByName(
            test.withColumn("__set", F.lit("test")), allowMissingColumns=True)
        for s, m, v in metrics_by_set(fitted.transform(tagged), label, "__set", task):
            scores[s, m] = v
        rows += [(model, best, str(trials[best]), s, m, float(v)) for (s, m), v in scores.items()]
    out = small_table(train.sparkSession, 
        rows, "name string, trial bigint, params string, set string, metric string, value double")
    if root:
        append_runs(out.withColumns({"run_id": F.concat_ws("_", F.lit("run"), "name"), "task": F.lit(task)}), root)
    return out
