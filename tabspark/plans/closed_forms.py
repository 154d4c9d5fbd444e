"""Fits small enough to have a closed form in SQL, optimality of the iterative ones, and ordered work in many blocks.

They run the same operators as the wider queries of the other families.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabspark.functions.scalar import dbl
from tabspark.operators import dist, fill, gram, models, quantiles, reduce, search, split
from tabspark.operators.small import small_table
from tabspark.plans import basics, fitting, profiles  # noqa: F401 (their SQL is used again)
from tabspark.plans.registry import ORACLE, query, tidy
from tabspark.sources import fixtures as fx

# Moments of n_words (x) and n_chars (y).
_DOCS = """st AS (SELECT count(*)::DOUBLE AS n, avg(n_words) AS mx, avg(n_chars) AS my, var_pop(n_words) AS vx, var_pop(n_chars) AS vy,
    covar_pop(n_chars, n_words) AS c FROM doc_feat)"""
# Moments of n_events (x) by class: a day with a purchase (1) or without (0).
_CLASSES = """u AS (SELECT row_id, n_events AS x, CASE WHEN y > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM user_day),
    cls AS (SELECT label, count(*)::DOUBLE AS n, avg(x) AS m, var_pop(x) AS v, (SELECT count(*) FROM u)::DOUBLE AS t FROM u GROUP BY label)"""


def _days(spark, d):
    return fx.user_day(spark, d).withColumn("label", F.when(F.col("y") > 0, 1.0).otherwise(0.0))


def _terms(spark, values: dict):
    return small_table(spark, [(k, float(v)) for k, v in values.items()], "term string, coef double")


# --- least squares and penalties --------------------------------------------------------------

@query("ols_std_errors", """SELECT term, round(b, 6) AS coef, round(e, 6) AS std_err, round(b / e, 4) AS t FROM (
       SELECT 'const' AS term, my - mx * c / vx AS b, sqrt((vy - c * c / vx) * n / (n - 2) * (1 / n + mx * mx / (n * vx))) AS e FROM st
       UNION ALL SELECT 'n_words', c / vx, sqrt((vy - c * c / vx) / (n - 2) / vx) FROM st)""", using=("doc_feat",), extra=_DOCS)
def ols_std_errors(spark, d):
    table = gram.ols_table(fx.doc_feat(spark, d), ["n_words"], "n_chars").filter("term <> 'r2'")
    return tidy(table.select("term", "coef", "std_err", "t"), t=4)


@query("lasso_one_feature", """SELECT term, round(CASE WHEN term = 'n_words' THEN b ELSE my - mx * b END, 3) + 0.0 AS coef FROM (
       SELECT *, sign(c) * greatest(abs(c) - 1000, 0) / vx AS b FROM st), (SELECT unnest(['const', 'n_words']) AS term)""",
       using=("doc_feat",), extra=_DOCS)
def lasso_one_feature(spark, d):
    """One coefficient under an L1 penalty is the soft-thresholded covariance."""
    fit = models.estimator("Lasso", ["n_words"], "n_chars", {"alpha": 1000.0}).fit(fx.doc_feat(spark, d)).info["model"].stages[-1]
    return tidy(_terms(spark, {"const": fit.intercept, "n_words": fit.coefficients[0]}), digits=3)


def _one_feature(name, **params):
    def run(spark, d):
        df = _days(spark, d)
        model = models.estimator(name, ["n_events"], "label", params).fit(df)
        return tidy(models.predict(df, model, ["row_id"]))
    return run


query("ridge_classify_one_feature", """SELECT row_id::BIGINT AS row_id, CASE WHEN my + (x - mx) * b > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
      FROM u, (SELECT avg(x) AS mx, avg(2 * label - 1) AS my,
        covar_pop(2 * label - 1, x) * count(*) / (var_pop(x) * count(*) + 1) AS b FROM u)""",
      using=("user_day",), extra=_CLASSES)(_one_feature("RidgeClassifier"))
query("lda_one_feature", """SELECT row_id::BIGINT AS row_id, max_by(c.label, ln(n / t) + m * x / cov - m * m / (2 * cov)) AS prediction
      FROM u, cls c, (SELECT sum(n * v) / sum(n) AS cov FROM cls) GROUP BY row_id""",
      using=("user_day",), extra=_CLASSES)(_one_feature("LinearDiscriminantAnalysis"))
query("qda_one_feature", """SELECT row_id::BIGINT AS row_id, max_by(c.label, ln(n / t) - 0.5 * ln(w) - (x - m) * (x - m) / (2 * w)) AS prediction
      FROM u, (SELECT *, v * n / (n - 1) AS w FROM cls) c GROUP BY row_id""",
      using=("user_day",), extra=_CLASSES)(_one_feature("QuadraticDiscriminantAnalysis"))


@query("grid_search_ridge", """SELECT a AS trial, round(rmse, 6) AS value, rank() OVER (ORDER BY rmse)::BIGINT AS rank FROM sc
       JOIN (VALUES (0::BIGINT, 0.0005::DOUBLE), (1, 0.1::DOUBLE), (2, 1.0::DOUBLE), (3, 10.0::DOUBLE)) t(a, alpha) USING (alpha)""",
       using=("doc_feat",), extra=fitting._FOLDED)
def grid_search_ridge(spark, d):
    """The search over one penalty gives the scores that the moments of the folds give."""
    df = fitting.hashed_folds(fx.doc_feat(spark, d).select("row_id", "n_words", "n_chars"))
    found = search.grid_search(df, ["n_words"], "n_chars", "Ridge", {"alpha": fitting.ALPHAS})
    return tidy(found.filter("set = 'val' AND metric = 'RMSE'").select("trial", "value", "rank"))


# --- optimality: the gradient of the stated objective is zero at the fit ------------------------

def _gradient(name, label, variance=None, prep=lambda df: df, **params):
    """Gradient of mean half deviance (log link) or log loss plus half the penalty at the fitted coefficients."""
    def run(spark, d):
        df = prep(_days(spark, d))
        model = models.estimator(name, fx.USER_DAY_FEATURES, label, params).fit(df)
        coef = model.info["model"].stages[-1].coefficients
        scored = model.transform(df)
        if variance is None:
            slope, alpha = F.col("score") - dbl(label), 1.0 / (params["C"] * df.count())
        else:
            mu = F.col("prediction")
            slope, alpha = (mu - dbl(label)) * F.pow(mu, F.lit(1.0 - variance)), params["alpha"]
        sums = scored.agg(F.avg(slope), *[F.avg(slope * dbl(c)) for c in fx.USER_DAY_FEATURES]).first()
        rows = {"const": sums[0], **{c: g + alpha * w for c, g, w in zip(fx.USER_DAY_FEATURES, sums[1:], coef)}}
        return tidy(_terms(spark, rows), digits=3)
    return run


_ZERO = "SELECT unnest(['const', {}]) AS term, 0.0::DOUBLE AS coef".format(", ".join(f"'{c}'" for c in fx.USER_DAY_FEATURES))
query("poisson_gradient", _ZERO)(_gradient("PoissonRegressor", "y", 1.0, alpha=0.1, tol=1e-10))
query("tweedie_gradient", _ZERO)(_gradient("TweedieRegressor", "y", 1.5, power=1.5, alpha=0.1, tol=1e-10))
query("gamma_gradient", _ZERO)(_gradient("GammaRegressor", "amount", 2.0, fitting._shifted, alpha=0.1, tol=1e-10))
query("logistic_gradient", _ZERO)(_gradient("LogisticRegression", "label", C=0.1, tol=1e-9))


# --- reduction, leverage and density -----------------------------------------------------------

@query("pca_two_columns", """SELECT row_id::BIGINT AS row_id, round((n_chars - my) * cos(a) + (n_words - mx) * sin(a), 4) + 0.0 AS c1,
       round((n_words - mx) * cos(a) - (n_chars - my) * sin(a), 4) + 0.0 AS c2
       FROM doc_feat, (SELECT *, 0.5 * atan2(2 * c, vy - vx) AS a FROM st)""", using=("doc_feat",), extra=_DOCS)
def pca_two_columns(spark, d):
    """Two columns turn by one angle."""
    df = fx.doc_feat(spark, d)
    return tidy(reduce.pca_project(df, ["n_chars", "n_words"], ["row_id"], 2, standardize=False), digits=4)


@query("pca_variance_two_columns", """SELECT unnest([1, 2])::BIGINT AS component, round(unnest([(1 + r) / 2, (1 - r) / 2]), 6) AS ratio,
       round(unnest([(1 + r) / 2, 1]), 6) AS cumulative FROM (SELECT abs(corr(n_chars, n_lines)) AS r FROM doc_feat)""", using=("doc_feat",))
def pca_variance_two_columns(spark, d):
    return tidy(reduce.pca_variance(fx.doc_feat(spark, d), ["n_chars", "n_lines"]))


@query("lda_project_two_columns", """SELECT row_id::BIGINT AS row_id, round(((x - mx) * wx + (z - mz) * wz) * CASE WHEN
         (abs(wx * sx) >= abs(wz * sz) AND wx < 0) OR (abs(wx * sx) < abs(wz * sz) AND wz < 0) THEN -1 ELSE 1 END, 6) + 0.0 AS c1
       FROM p, ax""", using=("user_day",), extra="""p AS (SELECT row_id, n_events AS x, k_mean AS z, y > 0 AS label FROM user_day),
       g AS (SELECT label, count(*)::DOUBLE AS n, avg(x) AS a, avg(z) AS b, var_pop(x) * count(*) AS vx, var_pop(z) * count(*) AS vz,
         covar_pop(x, z) * count(*) AS c FROM p GROUP BY label),
       s AS (SELECT sum(vx) / (sum(n) - 2) AS vx, sum(vz) / (sum(n) - 2) AS vz, sum(c) / (sum(n) - 2) AS c,
         max(a) FILTER (label) - max(a) FILTER (NOT label) AS da, max(b) FILTER (label) - max(b) FILTER (NOT label) AS db FROM g),
       raw AS (SELECT *, (vz * da - c * db) / (vx * vz - c * c) AS ux, (vx * db - c * da) / (vx * vz - c * c) AS uz FROM s),
       ax AS (SELECT ux / sqrt(ux * da + uz * db) AS wx, uz / sqrt(ux * da + uz * db) AS wz, t.* FROM raw,
         (SELECT avg(x) AS mx, avg(z) AS mz, stddev_pop(x) AS sx, stddev_pop(z) AS sz FROM p) t)""")
def lda_project_two_columns(spark, d):
    """Two classes have one axis: the inverse of the covariance within them times the difference of their means."""
    return tidy(reduce.lda_project(_days(spark, d), ["n_events", "k_mean"], "label", ["row_id"], 1))


@query("hat_trace", "SELECT least(count(*), 64)::DOUBLE AS trace, round(least(count(*), 64) / count(*), 6) AS mean FROM embeddings")
def hat_trace(spark, d):
    """The hat diagonal of a wide table sums to its rank."""
    h = gram.hat_diag(fx.embed_wide(spark, d), fx.EMBED_COLUMNS, ["row_id"])
    return tidy(h.agg(F.sum("h").alias("trace"), F.avg("h").alias("mean")))


@query("kde_exact", """SELECT round(lo + i * (hi - lo) / 19, 6) AS x, round(avg(exp(-0.5 * pow((lo + i * (hi - lo) / 19 - value) / bw, 2))) / any_value(bw)
       / sqrt(2 * pi()), 6) AS density FROM events_value, (SELECT min(value) AS lo, max(value) AS hi,
       stddev_samp(value) * pow(count(*), -0.2) AS bw FROM events_value), (SELECT unnest(range(20)) AS i) GROUP BY i, lo, hi""",
       using=("events_value",))
def kde_exact(spark, d):
    """Density at 20 places against the sum over all values."""
    return tidy(dist.kde_grid(fx.events_value(spark, d), "value", points=20))


# --- the block paths, on blocks small enough to be many -----------------------------------------

BLOCK_ROWS = 1_000


@query("kfold_blocks", ORACLE["kfold_assign"])
def kfold_blocks(spark, d):
    return tidy(split.kfold(fx.scored(spark, d).select("row_id"), rows_per_block=BLOCK_ROWS // 10))


@query("fill_ffill_blocks", ORACLE["fill_ffill"])
def fill_ffill_blocks(spark, d):
    return tidy(fill.fill_missing(fx.events_missing(spark, d), ["value"], "ffill", order="row_id", keys=["user_id"],
                                  rows_per_block=BLOCK_ROWS).select("row_id", "value"))


@query("quantiles_blocks", " UNION ALL ".join(f"""SELECT '{c}' AS "column", round(quantile_cont({c}, 0.25), 4) AS q25,
       round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75 FROM line_num"""
                                              for c in profiles.LINE_NUMERIC), using=("line_num",))
def quantiles_blocks(spark, d):
    """Quartiles by brackets and blocks, the way of long columns."""
    columns = {c: dbl(c) for c in profiles.LINE_NUMERIC}
    got = quantiles.exact_quantiles(fx.line_num(spark, d), columns, [0.25, 0.5, 0.75], limit=0, rows_per_block=BLOCK_ROWS)
    return tidy(small_table(spark, [(c, *q) for c, q in got.items()], "column string, q25 double, q50 double, q75 double"), digits=4)
