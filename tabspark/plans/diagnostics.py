"""Outliers, influence, least squares and elimination."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabspark.operators import gram, influence, outliers
from tabspark.plans.registry import query, tidy
from tabspark.sources import fixtures as fx

FEATS = ["n_words", "n_lines"]


def _flag(spark, d, **options):
    return tidy(outliers.outlier_flags(fx.events_value(spark, d), "value", ["row_id"], **options))


_OUT = "SELECT row_id::BIGINT AS row_id, CASE WHEN {} THEN 1 ELSE 0 END::BIGINT AS flag FROM events_value, ({})"


@query("outliers_zscore", _OUT.format("abs((value - m) / s) > 3", "SELECT avg(value) AS m, stddev_pop(value) AS s FROM events_value"),
       using=("events_value",))
def outliers_zscore(spark, d):
    return _flag(spark, d, method="z-score")


@query("outliers_modified_z", _OUT.format("abs(1.486 * (value - med) / CASE WHEN mad = 0 THEN 1 ELSE mad END) > 3",
       "SELECT any_value(med) AS med, median(abs(value - med)) AS mad FROM events_value, (SELECT median(value) AS med FROM events_value)"),
       using=("events_value",))
def outliers_modified_z(spark, d):
    return _flag(spark, d, method="modified-z-score")


_IQR = "SELECT quantile_cont(value, {0}) AS a, quantile_cont(value, {1}) AS b FROM {2}"


@query("outliers_iqr_25_75", _OUT.format("value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)", _IQR.format(0.25, 0.75, "events_value")),
       using=("events_value",))
def outliers_iqr_25_75(spark, d):
    return _flag(spark, d, method="iqr", iqr_lower_percentile=25, iqr_upper_percentile=75)


# Rows of every thousandth event are planted far outside, as copies.
_PLANTED = """planted AS (SELECT row_id, value FROM events_value
    UNION ALL SELECT row_id + 10000000000, value * 50 + 5000 FROM events_value WHERE row_id % 1000 = 0)"""


@query("outliers_iqr_1_99", f"""SELECT row_id::BIGINT AS row_id, CASE WHEN value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)
       THEN 1 ELSE 0 END::BIGINT AS flag FROM planted, ({_IQR.format(0.01, 0.99, 'planted')})""",
       using=("events_value",), extra=_PLANTED)
def outliers_iqr_1_99(spark, d):
    e = fx.events_value(spark, d).select("row_id", "value")
    far = e.filter("row_id % 1000 = 0").select((F.col("row_id") + 10000000000).alias("row_id"),
                                               (F.col("value") * 50 + 5000).alias("value"))
    return tidy(outliers.outlier_flags(e.unionByName(far), "value", ["row_id"], method="iqr"))


def planted_docs(spark, d):
    """doc_feat with an extreme copy of every hundredth document."""
    df = fx.doc_feat(spark, d).select("row_id", "n_chars", "n_words", "n_lines")
    far = df.filter("row_id % 100 = 0").select(
        (F.col("row_id") + 10_000_000).alias("row_id"), (F.col("n_chars") * 50).alias("n_chars"),
        (F.col("n_words") * 50).alias("n_words"), "n_lines")
    return df.unionByName(far)


@query("outliers_isolation_forest")
def outliers_isolation_forest(spark, d):
    return tidy(outliers.isolation_forest(planted_docs(spark, d), ["n_chars", "n_words", "n_lines"]))


# --- least squares -------------------------------------------------------------------------

@query("ols_fit", """SELECT 'const' AS term, round(regr_intercept(n_chars, n_words), 6) AS coef FROM doc_feat
       UNION ALL SELECT 'n_words', round(regr_slope(n_chars, n_words), 6) FROM doc_feat
       UNION ALL SELECT 'r2', round(regr_r2(n_chars, n_words), 6) FROM doc_feat""", using=("doc_feat",))
def ols_fit(spark, d):
    return tidy(gram.ols_table(fx.doc_feat(spark, d), ["n_words"], "n_chars").select("term", "coef"))


@query("ols_p_values")
def ols_p_values(spark, d):
    return tidy(gram.ols_table(fx.doc_feat(spark, d), FEATS, "n_chars"))


@query("vif", """SELECT unnest(['n_words', 'n_lines']) AS feature, round(a * c / (a * c - b * b), 6) AS vif FROM (
       SELECT sum(n_words * n_words) AS a, sum(n_words * n_lines) AS b, sum(n_lines * n_lines) AS c FROM doc_feat)""",
       using=("doc_feat",))
def vif(spark, d):
    return tidy(gram.vif_table(fx.doc_feat(spark, d), FEATS))


_HAT = """gm AS (SELECT sum(n_words * n_words) AS a, sum(n_words * n_lines) AS b, sum(n_lines * n_lines) AS c, count(*) AS n,
    regr_slope(n_chars, n_words) AS k, regr_intercept(n_chars, n_words) AS q FROM doc_feat),
    hat AS (SELECT row_id, (c * n_words * n_words - 2 * b * n_words * n_lines + a * n_lines * n_lines) / (a * c - b * b) AS h,
    n_chars - (k * n_words + q) AS r, n FROM doc_feat, gm)"""
_LEV = _HAT + """, lev AS (SELECT row_id, CASE WHEN h > 6.0 / n THEN 1 ELSE 0 END AS hl,
    CASE WHEN abs(r / (SELECT stddev_pop(r) FROM hat)) > 2 THEN 1 ELSE 0 END AS hr FROM hat)"""


@query("hat_diag", "SELECT row_id::BIGINT AS row_id, round(h, 6) + 0.0 AS h FROM hat", using=("doc_feat",), extra=_HAT)
def hat_diag(spark, d):
    return tidy(gram.hat_diag(fx.doc_feat(spark, d), FEATS, ["row_id"]))


def _predicted(spark, d):
    """doc_feat with the one-feature least-squares prediction of n_chars."""
    df = fx.doc_feat(spark, d)
    fit = gram.least_squares(gram.gram(df, ["n_words", "n_chars"]), ["n_words"], "n_chars")
    return df.withColumn("prediction", fit.predict())


@query("leverage_flags", """SELECT row_id::BIGINT AS row_id, hl::BIGINT AS high_leverage, hr::BIGINT AS high_residual,
       CASE WHEN hl = 1 AND hr = 1 THEN 'high leverage and residual' WHEN hl = 1 THEN 'high leverage'
       WHEN hr = 1 THEN 'high residual' ELSE 'normal' END AS category FROM lev""", using=("doc_feat",), extra=_LEV)
def leverage_flags(spark, d):
    return influence.leverage_flags(_predicted(spark, d), FEATS, "n_chars", "prediction", ["row_id"])


@query("leverage_summary", """SELECT 'High leverage points' AS description, sum(hl)::BIGINT AS n FROM lev
       UNION ALL SELECT 'High studentized residuals', sum(hr)::BIGINT FROM lev
       UNION ALL SELECT 'High leverage & ~high residuals', sum(hl * (1 - hr))::BIGINT FROM lev
       UNION ALL SELECT 'High residuals & ~high leverage', sum(hr * (1 - hl))::BIGINT FROM lev
       UNION ALL SELECT 'Total', sum(greatest(hl, hr))::BIGINT FROM lev""", using=("doc_feat",), extra=_LEV)
def leverage_summary(spark, d):
    return influence.leverage_summary(leverage_flags(spark, d))


@query("influence_cook", """SELECT row_id::BIGINT AS row_id, CASE WHEN ck > 3 * avg(ck) OVER () THEN 1 ELSE 0 END::BIGINT AS flag FROM (
       SELECT row_id, r * r / (SELECT avg(r * r) FROM hat) / 2 * h / ((1 - h) * (1 - h)) AS ck FROM hat)""",
       using=("doc_feat",), extra=_HAT)
def influence_cook(spark, d):
    return influence.influence_flags(_predicted(spark, d), FEATS, "n_chars", "prediction", ["row_id"], "cook")


@query("influence_dfits", """SELECT row_id::BIGINT AS row_id, CASE WHEN r / (sqrt((SELECT avg(r * r) FROM hat)) * sqrt(1 - h)) * sqrt(h / (1 - h))
       > 2 * sqrt(2.0 / n) THEN 1 ELSE 0 END::BIGINT AS flag FROM hat""", using=("doc_feat",), extra=_HAT)
def influence_dfits(spark, d):
    return influence.influence_flags(_predicted(spark, d), FEATS, "n_chars", "prediction", ["row_id"], "dfits")


BACKWARD = ["n_events", "n_click", "n_view", "n_error", "k_mean", "last_hour"]


@query("backward_t")
def backward_t(spark, d):
    return gram.backward_table(fx.user_day(spark, d), BACKWARD, "y", test="t")


@query("backward_f")
def backward_f(spark, d):
    return gram.backward_table(fx.user_day(spark, d), BACKWARD, "y", test="f", vif_threshold=5.0)
