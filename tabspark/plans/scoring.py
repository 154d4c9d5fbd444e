"""Metric and curve queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabspark.operators import curves, metrics, split
from tabspark.plans.fitting import _SKF, _h
from tabspark.plans.registry import query, tidy
from tabspark.sources import fixtures as fx

# One prediction rule stands in for a model, so that SQL can repeat it.
_PRED = "pr AS (SELECT row_id, y, 20 * n_events AS prediction, y - 20 * n_events AS e FROM user_day)"


def _scored_days(spark, d):
    return fx.user_day(spark, d).withColumn("prediction", F.col("n_events") * 20.0)


_FIVE = """round(sqrt(avg(e * e)), 6) AS RMSE, round(avg(abs(e)), 6) AS MAE, round(sqrt(median(e * e)), 6) AS RMedSE,
    round(median(abs(e)), 6) AS MedAE, round(1 - avg(e * e) / var_pop(y), 6) AS R2"""


@query("regression_metrics", f"SELECT {_FIVE} FROM pr", using=("user_day",), extra=_PRED)
def regression_metrics(spark, d):
    return tidy(metrics.regression_metrics(_scored_days(spark, d), "y", "prediction"))


@query("regression_metrics_by_split", f"SELECT CASE WHEN {_h(42)} < 858993459 THEN 'test' ELSE 'train' END AS split, {_FIVE} FROM pr GROUP BY 1",
       using=("user_day",), extra=_PRED)
def regression_metrics_by_split(spark, d):
    return tidy(metrics.regression_by(split.hash_split(_scored_days(spark, d)), "y", "prediction", "split"))


@query("residual_frame", "SELECT row_id::BIGINT AS row_id, round(y, 6) + 0.0 AS y, prediction, round(e, 6) + 0.0 AS residual FROM pr",
       using=("user_day",), extra=_PRED)
def residual_frame(spark, d):
    return tidy(metrics.residual_frame(_scored_days(spark, d), "y", "prediction", ["row_id"]), exact=("prediction",))


# --- classification -----------------------------------------------------------------------

def decided(spark, d):
    return fx.scored(spark, d).withColumn("yhat", F.when(F.col("score") >= 0.5, 1).otherwise(0))


_DEC = "dec AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS yhat FROM scored)"
_BIN = _DEC + """, b AS (SELECT count(*) FILTER (y = 1 AND yhat = 1)::DOUBLE AS tp, count(*) FILTER (y = 0 AND yhat = 1)::DOUBLE AS fp,
    count(*) FILTER (y = 1 AND yhat = 0)::DOUBLE AS fn, count(*) FILTER (y = 0 AND yhat = 0)::DOUBLE AS tn FROM dec)"""


@query("confusion_matrix", "SELECT y::BIGINT AS y, yhat::BIGINT AS yhat, count(*)::BIGINT AS n FROM dec GROUP BY ALL", using=("scored",), extra=_DEC)
def confusion_matrix(spark, d):
    return tidy(metrics.confusion_matrix(decided(spark, d), "y", "yhat"))


@query("binary_scores", """SELECT round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       round((2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fp + fn)) / 2, 6) AS f1_macro, round(fp / (fp + tn), 6) AS fpr,
       round(tp / (tp + fn), 6) AS tpr FROM b""", using=("scored",), extra=_BIN)
def binary_scores(spark, d):
    return tidy(metrics.binary_scores(decided(spark, d), "y", "yhat"))


@query("cost_gain", "SELECT round(-3.67 * fp - fn, 4) AS gain FROM b", using=("scored",), extra=_BIN)
def cost_gain(spark, d):
    return tidy(metrics.cost_gain(decided(spark, d), "y", "yhat"), digits=4)


def _report_sql(view: str) -> str:
    return f"""pc AS (SELECT label::VARCHAR AS label, sum(tp)::DOUBLE AS tp, sum(s)::DOUBLE AS s, sum(p)::DOUBLE AS p FROM (
      SELECT y AS label, count(*) FILTER (y = yhat) AS tp, count(*) AS s, 0 AS p FROM {view} GROUP BY y
      UNION ALL SELECT yhat, 0, 0, count(*) FROM {view} GROUP BY yhat) GROUP BY label),
    rep AS (SELECT label, tp, s, CASE WHEN p > 0 THEN tp / p ELSE 0 END AS pre, CASE WHEN s > 0 THEN tp / s ELSE 0 END AS rec,
      CASE WHEN p + s > 0 THEN 2 * tp / (p + s) ELSE 0 END AS f FROM pc)"""


_REPORT = """SELECT label, round(pre, 6) AS precision, round(rec, 6) AS recall, round(f, 6) AS f1, s::BIGINT AS support FROM rep
    UNION ALL SELECT 'accuracy', round(sum(tp) / sum(s), 6), round(sum(tp) / sum(s), 6), round(sum(tp) / sum(s), 6), sum(s)::BIGINT FROM rep
    UNION ALL SELECT 'macro avg', round(avg(pre), 6), round(avg(rec), 6), round(avg(f), 6), sum(s)::BIGINT FROM rep
    UNION ALL SELECT 'weighted avg', round(sum(pre * s) / sum(s), 6), round(sum(rec * s) / sum(s), 6), round(sum(f * s) / sum(s), 6), sum(s)::BIGINT FROM rep"""


@query("classification_report", _REPORT, using=("scored",), extra=_DEC + ", " + _report_sql("dec"))
def classification_report(spark, d):
    return tidy(metrics.classification_report(decided(spark, d), "y", "yhat"))


@query("classification_report_multi", _REPORT, extra=
       "em AS (SELECT label AS y, vec_id % 10 AS yhat FROM embeddings), " + _report_sql("em"))
def classification_report_multi(spark, d):
    df = fx.embeddings(spark, d).select(F.col("label").alias("y"), (F.col("row_id") % 10).cast("int").alias("yhat"))
    return tidy(metrics.classification_report(df, "y", "yhat"))


# --- curves ------------------------------------------------------------------------------------

_CUM = """cu AS (SELECT score AS threshold, sum(dp) OVER w AS tp, sum(dn) OVER w AS fp, dp, dn, p, n FROM (
      SELECT score, count(*) FILTER (y = 1)::DOUBLE AS dp, count(*) FILTER (y = 0)::DOUBLE AS dn FROM scored GROUP BY score),
      (SELECT count(*) FILTER (y = 1)::DOUBLE AS p, count(*) FILTER (y = 0)::DOUBLE AS n FROM scored)
      WINDOW w AS (ORDER BY score DESC))"""


@query("roc_points", "SELECT threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM cu", using=("scored",), extra=_CUM)
def roc_points(spark, d):
    return tidy(curves.roc_points(fx.scored(spark, d), "y", "score"), exact=("threshold",))


@query("pr_points", "SELECT threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM cu", using=("scored",), extra=_CUM)
def pr_points(spark, d):
    return tidy(curves.pr_points(fx.scored(spark, d), "y", "score"), exact=("threshold",))


@query("auc_roc", "SELECT round(sum(dn * (tp - dp / 2)) / any_value(p * n), 6) AS value FROM cu", using=("scored",), extra=_CUM)
def auc_roc(spark, d):
    return tidy(curves.auc_roc(fx.scored(spark, d), "y", "score"))


@query("average_precision", "SELECT round(sum(dp * tp / (tp + fp)) / any_value(p), 6) AS value FROM cu", using=("scored",), extra=_CUM)
def average_precision(spark, d):
    return tidy(curves.average_precision(fx.scored(spark, d), "y", "score"))


@query("curve_cutoff", """SELECT round(fp / (fp + tn), 6) AS fpr, round(tp / (tp + fn), 6) AS tpr, round(tp / (tp + fp), 6) AS precision,
       round(tp / (tp + fn), 6) AS recall FROM b""", using=("scored",), extra=_BIN)
def curve_cutoff(spark, d):
    return tidy(curves.cutoff_point(fx.scored(spark, d), "y", "score", 0.5))


@query("chance_level", "SELECT round(avg(y), 6) AS value FROM scored", using=("scored",))
def chance_level(spark, d):
    return tidy(curves.chance_level(fx.scored(spark, d), "y"))


@query("closest_roc_point", """SELECT round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM (
       SELECT threshold, fp / n AS fpr, tp / p AS tpr FROM cu UNION ALL SELECT 9e9, 0, 0)
       ORDER BY round(power(fpr - (1 - 0.6), 2) + power(tpr - 0.6, 2), 12), threshold DESC LIMIT 1""", using=("scored",), extra=_CUM)
def closest_roc_point(spark, d):
    return tidy(curves.closest_roc_point(fx.scored(spark, d), "y", "score", 0.6))


_CURVE = _SKF + """, cv AS (SELECT t, avg((CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END
      + CASE WHEN 2 * tn + fp + fn > 0 THEN 2 * tn / (2 * tn + fp + fn) ELSE 0 END) / 2) AS score FROM (
      SELECT t, fold, count(*) FILTER (s.y = 1 AND s.score >= t)::DOUBLE AS tp, count(*) FILTER (s.y = 0 AND s.score >= t)::DOUBLE AS fp,
        count(*) FILTER (s.y = 1 AND s.score < t)::DOUBLE AS fn, count(*) FILTER (s.y = 0 AND s.score < t)::DOUBLE AS tn
      FROM scored s JOIN folded USING (row_id), (SELECT unnest(range(100)) / 99.0::DOUBLE AS t) GROUP BY t, fold) GROUP BY t)"""


@query("threshold_curve", "SELECT round(t, 9) AS threshold, round(score, 6) AS score FROM cv", using=("scored",), extra=_CURVE)
def threshold_curve(spark, d):
    df = split.stratified_kfold(fx.scored(spark, d), "y")
    return tidy(curves.threshold_curve(df, "y", "score", "fold", curves.threshold_grid()), threshold=9)


@query("best_threshold", "SELECT round(t, 9) AS threshold, round(score, 6) AS score FROM cv ORDER BY round(cv.score, 12) DESC, t LIMIT 1",
       using=("scored",), extra=_CURVE)
def best_threshold(spark, d):
    df = split.stratified_kfold(fx.scored(spark, d), "y")
    return tidy(curves.best_threshold(curves.threshold_curve(df, "y", "score", "fold", curves.threshold_grid())), threshold=9)
