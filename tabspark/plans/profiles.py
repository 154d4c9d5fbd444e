"""Profiles, correlation and distribution queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tabspark.functions.scalar import dbl
from tabspark.functions.special import digamma
from tabspark.operators import dist, gram, likelihood, ordered, profile, roles
from tabspark.operators.small import small_table
from tabspark.plans.registry import query, tidy
from tabspark.sources import fixtures as fx

LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_TEXT = ["l_returnflag", "l_linestatus"]
DOC_NUMERIC = ["n_chars", "n_words", "n_lines"]


@query("numeric_profile", " UNION ALL ".join(f"""SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
       round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM line_num""" for c in LINE_NUMERIC), using=("line_num",))
def numeric_profile(spark, d):
    return tidy(profile.numeric_profile(fx.line_num(spark, d), LINE_NUMERIC), digits=4)


@query("categorical_profile", " UNION ALL ".join(f"""SELECT '{c}' AS "column", {c} AS value, count(*)::BIGINT AS n,
       round(count(*) * 100.0 / (SELECT count(*) FROM line_num), 6) AS pct FROM line_num GROUP BY {c}""" for c in LINE_TEXT),
       using=("line_num",))
def categorical_profile(spark, d):
    return tidy(profile.categorical_profile(fx.line_num(spark, d), LINE_TEXT))


@query("describe_cols", " UNION ALL ".join(
    [f"""SELECT 'Numerical' AS type, '{c}' AS "column", NULL::VARCHAR AS value, count({c})::BIGINT AS n, round(avg({c}), 4) AS mean,
     round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25,
     round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max,
     NULL::DOUBLE AS pct FROM line_num""" for c in LINE_NUMERIC]
    + [f"""SELECT 'Categorical', '{c}', {c}::VARCHAR, count(*)::BIGINT, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
     round(count(*) * 100.0 / (SELECT count(*) FROM line_num), 4) FROM line_num GROUP BY {c}"""
       for c in [*LINE_TEXT, "l_linenumber"]]), using=("line_num",))
def describe_cols(spark, d):
    return tidy(profile.describe_columns(fx.line_num(spark, d)), digits=4)


@query("class_counts", "SELECT y::BIGINT AS y, count(*)::BIGINT AS n FROM scored GROUP BY y", using=("scored",))
def class_counts(spark, d):
    return tidy(profile.class_counts(fx.scored(spark, d), "y"))


@query("class_weights", """SELECT y::BIGINT AS y, round((SELECT count(*) FROM scored) / ((SELECT count(DISTINCT y) FROM scored) * count(*)), 6)
       AS weight FROM scored GROUP BY y""", using=("scored",))
def class_weights(spark, d):
    return tidy(profile.class_weights(fx.scored(spark, d), "y"))


@query("distribution_summary", """SELECT round(min(y), 6) AS min, round(max(y), 6) AS max, round(avg(y), 6) AS mean,
       round(stddev_samp(y), 6) AS std, count(*) FILTER (y = 0)::BIGINT AS n_zero FROM user_day""", using=("user_day",))
def distribution_summary(spark, d):
    return tidy(profile.distribution_summary(fx.user_day(spark, d), "y"))


@query("variance_threshold", " UNION ALL ".join(f"""SELECT '{c}' AS "column", round(var_pop({c}), 4) AS var_pop,
       CASE WHEN var_pop({c}) <= 0.01 THEN 0 ELSE 1 END::BIGINT AS kept FROM line_num""" for c in LINE_NUMERIC), using=("line_num",))
def variance_threshold(spark, d):
    return tidy(profile.variance_table(fx.line_num(spark, d), LINE_NUMERIC, 0.01), digits=4)


_PAIRS = [(a, b) for i, a in enumerate(DOC_NUMERIC) for b in DOC_NUMERIC[i + 1:]]


@query("correlation_pairs", " UNION ALL ".join(
    [f"SELECT '{a}' AS col_i, '{b}' AS col_j, round(corr({a}, {b}), 6) AS r FROM doc_feat" for a, b in _PAIRS]
    + [f"SELECT '{a}', 'one', NULL FROM (SELECT 1)" for a in DOC_NUMERIC]), using=("doc_feat",))
def correlation_pairs(spark, d):
    from pyspark.sql import functions as F

    df = fx.doc_feat(spark, d).withColumn("one", F.lit(1.0))
    return tidy(gram.correlation_pairs(df, [*DOC_NUMERIC, "one"]))


@query("correlated_columns", """SELECT col_j AS "column", min_by(col_i, i) AS partner, round(min_by(r, i), 6) AS r FROM ("""
       + " UNION ALL ".join(f"SELECT {DOC_NUMERIC.index(a)} AS i, '{a}' AS col_i, '{b}' AS col_j, corr({a}, {b}) AS r FROM doc_feat"
                            for a, b in _PAIRS) + ") WHERE abs(r) >= 0.9 GROUP BY col_j", using=("doc_feat",))
def correlated_columns(spark, d):
    return tidy(gram.correlated_columns(fx.doc_feat(spark, d), DOC_NUMERIC, threshold=0.9)
                .select("column", "partner", "r"))


# --- distributions ---------------------------------------------------------------------------

@query("hist_counts", """SELECT b.bin::BIGINT AS bin, coalesce(c.n, 0)::BIGINT AS n FROM (SELECT unnest(range(20)) AS bin) b LEFT JOIN (
       SELECT least(floor((value - lo) / ((hi - lo) / 20)), 19)::BIGINT AS bin, count(*) AS n
       FROM events_value, (SELECT min(value) AS lo, max(value) AS hi FROM events_value) GROUP BY 1) c ON b.bin = c.bin""",
       using=("events_value",))
def hist_counts(spark, d):
    return tidy(dist.histogram(fx.events_value(spark, d), "value", 20))


def _class_hist_sql(cols, prep):
    return " UNION ALL ".join(f"""SELECT '{c}' AS feature, c_mktsegment AS class,
        least(floor((x - lo) / ((hi - lo) / 20)), 19)::BIGINT AS bin, count(*)::BIGINT AS n FROM (
        SELECT *, min(x) OVER () AS lo, max(x) OVER () AS hi FROM (SELECT c_mktsegment, {prep.format(c)} AS x FROM cust_feat))
        WHERE x IS NOT NULL GROUP BY ALL""" for c in cols)


@query("hist_by_class", _class_hist_sql(["c_acctbal", "n_orders"], "{}::DOUBLE"), using=("cust_feat",))
def hist_by_class(spark, d):
    return tidy(dist.histogram_by_class(fx.cust_feat(spark, d), ["c_acctbal", "n_orders"], "c_mktsegment"))


@query("hist_by_class_all_bins", f"""SELECT k.feature, k.class, b.bin, coalesce(h.n, 0)::BIGINT AS n FROM (
       SELECT DISTINCT feature, c_mktsegment AS class FROM cust_feat, (VALUES ('c_acctbal'), ('n_orders')) f(feature)) k
       CROSS JOIN (SELECT range::BIGINT AS bin FROM range(20)) b
       LEFT JOIN ({_class_hist_sql(["c_acctbal", "n_orders"], "{}::DOUBLE")}) h
       ON h.feature = k.feature AND h.class = k.class AND h.bin = b.bin""", using=("cust_feat",))
def hist_by_class_all_bins(spark, d):
    return tidy(dist.histogram_by_class(fx.cust_feat(spark, d), ["c_acctbal", "n_orders"], "c_mktsegment", empty=True))


@query("hist_by_class_log", _class_hist_sql(["c_acctbal", "n_orders"], "CASE WHEN {0} > 0 THEN log10({0}::DOUBLE) END"),
       using=("cust_feat",))
def hist_by_class_log(spark, d):
    return tidy(dist.histogram_by_class(fx.cust_feat(spark, d), ["c_acctbal", "n_orders"], "c_mktsegment", log_bins=True))


@query("fit_norm", """SELECT 'loc' AS parameter, round(avg(value), 6) AS value FROM events_value
       UNION ALL SELECT 'scale', round(stddev_pop(value), 6) FROM events_value""", using=("events_value",))
def fit_norm(spark, d):
    return tidy(dist.fit_table(fx.events_value(spark, d), "value", "norm"))


@query("fit_lognorm", """SELECT 's' AS parameter, round(stddev_pop(ln(value)), 6) AS value FROM events_value
       UNION ALL SELECT 'scale', round(exp(avg(ln(value))), 6) FROM events_value""", using=("events_value",))
def fit_lognorm(spark, d):
    return tidy(dist.fit_table(fx.events_value(spark, d), "value", "lognorm"))


@query("fit_gamma")
def fit_gamma(spark, d):
    return tidy(dist.fit_table(fx.events_value(spark, d), "value", "gamma"))


_COUNTS = """UNION ALL SELECT 'rows', count(value)::DOUBLE FROM events_missing UNION ALL SELECT 'missing', (count(*) - count(value))::DOUBLE FROM events_missing
       UNION ALL SELECT 'outside', 0.0"""


@query("likelihood_lognorm", f"""SELECT 's' AS parameter, round(stddev_pop(ln(value)), 3) AS value FROM events_missing
       UNION ALL SELECT 'scale', round(exp(avg(ln(value))), 3) FROM events_missing UNION ALL SELECT 'loc', 0.0
       UNION ALL SELECT 'mean_log_density', round(-avg(ln(value)) - ln(stddev_pop(ln(value))) - 0.5 * ln(2 * pi()) - 0.5, 3) FROM events_missing
       {_COUNTS}""", using=("events_missing",))
def likelihood_lognorm(spark, d):
    return tidy(likelihood.likelihood_table(fx.events_missing(spark, d), "value", "lognorm", fixed={"loc": 0.0}), digits=3)


RAYLEIGH = likelihood.Density(lambda x, sigma: F.when(x > 0, F.log(x) - 2 * math.log(sigma) - x * x / (2 * sigma ** 2)),
                              lambda mean, std, least: {"sigma": mean}, ("sigma",))


@query("likelihood_own_density", f"""SELECT 'sigma' AS parameter, round(sqrt(avg(value) / 2), 3) AS value FROM events_missing
       UNION ALL SELECT 'mean_log_density', round(avg(ln(value)) / 2 - ln(avg(value) / 2) - 1, 3) FROM events_missing
       {_COUNTS}""", using=("events_missing",))
def likelihood_own_density(spark, d):
    """A density given by its formula, fitted to the root of the value."""
    return tidy(likelihood.likelihood_table(fx.events_missing(spark, d), "value", RAYLEIGH, apply_transform=F.sqrt), digits=3)


@query("likelihood_gamma_moments", """SELECT 'newton' AS fit, round(avg(value), 3) AS mean, round(avg(ln(value)), 3) AS mean_log FROM events_value
       UNION ALL SELECT 'likelihood', round(avg(value), 3), round(avg(ln(value)), 3) FROM events_value""", using=("events_value",))
def likelihood_gamma_moments(spark, d):
    """At the maximum the fitted mean and mean logarithm, which fix both parameters, are those of the data."""
    df = fx.events_value(spark, d)
    fits = {"newton": dist.fit_gamma(df, dbl("value")),
            "likelihood": likelihood.fit_likelihood(df, "value", "gamma", fixed={"loc": 0.0}).params}
    rows = [(k, p["a"] * p["scale"], digamma(p["a"]) + math.log(p["scale"])) for k, p in fits.items()]
    return tidy(small_table(spark, rows, "fit string, mean double, mean_log double"), digits=3)


@query("rank_hot_value_blocks", """SELECT row_id::BIGINT AS row_id, row_number() OVER (ORDER BY y, row_id)::BIGINT AS position FROM user_day""", using=("user_day",))
def rank_hot_value_blocks(spark, d):
    """Ranks of a target that is mostly zero, cut into blocks of 25 rows."""
    df = fx.user_day(spark, d).select("row_id", "y")
    return tidy(ordered.ranked(df, "position", "y", tie_break=["row_id"], rows_per_block=25).select("row_id", "position"))


@query("fitted_density", """SELECT round(lo + i * ((hi - lo) / 999), 6) AS x,
       round(exp(-pow((lo + i * ((hi - lo) / 999) - m) / s, 2) / 2) / (s * sqrt(2 * pi())), 9) AS density
       FROM (SELECT min(value) AS lo, max(value) AS hi, avg(value) AS m, stddev_pop(value) AS s FROM events_value),
       (SELECT unnest(range(1000)) AS i)""", using=("events_value",))
def fitted_density(spark, d):
    return tidy(dist.density_grid(fx.events_value(spark, d), "value", "norm"), density=9)


@query("qq_points")
def qq_points(spark, d):
    return tidy(dist.qq_points(fx.events_value(spark, d), "value", "row_id"))


@query("kde_grid")
def kde_grid(spark, d):
    return tidy(dist.kde_grid(fx.events_value(spark, d), "value"), digits=9)
