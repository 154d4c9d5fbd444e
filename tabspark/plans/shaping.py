"""Scaling, distribution transforms, preprocessing, selection and reduction."""

from __future__ import annotations

from functools import reduce as fold_left

from pyspark.sql import functions as F

from tabspark.operators import information, preprocess, reduce, select, split, transforms
from tabspark.operators.roles import TabularDataset
from tabspark.plans.registry import query, tidy
from tabspark.sources import fixtures as fx


def _scaled(method):
    def run(spark, d):
        df = transforms.Scaler(method, ["value"]).fit(fx.events_value(spark, d)).transform(fx.events_value(spark, d))
        return tidy(df.select("row_id", F.col("value").alias("z")))
    return run


_Z = "SELECT row_id::BIGINT AS row_id, round((value - a) / b, 6) + 0.0 AS z FROM events_value, ({} FROM events_value)"
query("scale_standard", _Z.format("SELECT avg(value) AS a, stddev_pop(value) AS b"), using=("events_value",))(_scaled("standard"))
query("scale_minmax", _Z.format("SELECT min(value) AS a, max(value) - min(value) AS b"), using=("events_value",))(_scaled("minmax"))
query("scale_robust", _Z.format("SELECT median(value) AS a, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS b"),
      using=("events_value",))(_scaled("robust"))


@query("normalize_rows", """SELECT row_id::BIGINT AS row_id, pos::BIGINT AS pos,
       round(val / CASE WHEN n = 0 THEN 1 ELSE n END, 6) + 0.0 AS val FROM (
       SELECT *, sqrt(sum(val * val) OVER (PARTITION BY row_id)) AS n FROM emb_long)""", using=("emb_long",))
def normalize_rows(spark, d):
    df = transforms.normalize_rows(fx.embeddings(spark, d), "x", "u")
    return tidy(df.select("row_id", F.posexplode("u").alias("pos", "val")))


# --- power and log transforms -----------------------------------------------------------------

LAMBDAS = {"t0": 0.0, "t05": 0.5, "t2": 2.0}


def _powers(method, column, df):
    """One output column per fixed lambda, all in one projection."""
    models = {out: transforms.Scaler(method, [column], lambdas={column: lam}).fit(df) for out, lam in LAMBDAS.items()}
    return df.select("row_id", *[F.expr(m.forward_sql(column)).alias(out) for out, m in models.items()])


@query("yeo_johnson_fixed", """SELECT row_id::BIGINT AS row_id,
       round(CASE WHEN c_acctbal >= 0 THEN ln(1 + c_acctbal) ELSE -(pow(1 - c_acctbal, 2) - 1) / 2 END, 6) + 0.0 AS t0,
       round(CASE WHEN c_acctbal >= 0 THEN (pow(1 + c_acctbal, 0.5) - 1) / 0.5 ELSE -(pow(1 - c_acctbal, 1.5) - 1) / 1.5 END, 6) + 0.0 AS t05,
       round(CASE WHEN c_acctbal >= 0 THEN (pow(1 + c_acctbal, 2) - 1) / 2 ELSE -ln(1 - c_acctbal) END, 6) + 0.0 AS t2 FROM cust_feat""",
       using=("cust_feat",))
def yeo_johnson_fixed(spark, d):
    return tidy(_powers("yeo-johnson", "c_acctbal", fx.cust_feat(spark, d)))


@query("box_cox_fixed", """SELECT row_id::BIGINT AS row_id, round(ln(value), 6) + 0.0 AS t0, round((sqrt(value) - 1) / 0.5, 6) + 0.0 AS t05,
       round((value * value - 1) / 2, 6) + 0.0 AS t2 FROM events_value""", using=("events_value",))
def box_cox_fixed(spark, d):
    return tidy(_powers("box-cox", "value", fx.events_value(spark, d)))


def _plain(method, source, column):
    def run(spark, d):
        df = source(spark, d)
        model = transforms.Scaler(method, [column]).fit(df)
        return tidy(df.select("row_id", F.expr(model.forward_sql(column)).alias("t")))
    return run


def thousandths(spark, d):
    return fx.cust_feat(spark, d).select("row_id", (F.col("c_acctbal") / 1000).alias("x"))


_T = "SELECT row_id::BIGINT AS row_id, round({}, 6) + 0.0 AS t FROM {}"
query("log_transform", _T.format("ln(1 + value)", "events_value"), using=("events_value",))(_plain("log", fx.events_value, "value"))
query("symlog", _T.format("sign(c_acctbal) * ln(1 + abs(c_acctbal))", "cust_feat"), using=("cust_feat",))(
    _plain("symlog", fx.cust_feat, "c_acctbal"))
query("symexp", _T.format("sign(c_acctbal / 1000) * (exp(abs(c_acctbal / 1000)) - 1)", "cust_feat"), using=("cust_feat",))(
    _plain("symexp", thousandths, "x"))
query("arcsinh", _T.format("asinh(c_acctbal)", "cust_feat"), using=("cust_feat",))(_plain("arcsinh", fx.cust_feat, "c_acctbal"))


@query("yeo_johnson_fit")
def yeo_johnson_fit(spark, d):
    a = transforms.power_table(fx.events_value(spark, d), ["value"])
    b = transforms.power_table(fx.doc_feat(spark, d), ["n_chars", "n_words"])
    return tidy(a.unionByName(b), digits=4)


def _quantile(output):
    def run(spark, d):
        df = transforms.quantile_transform(fx.events_value(spark, d), "value", "t", output)
        return tidy(df.select("row_id", "t"))
    return run


query("quantile_uniform", """SELECT row_id::BIGINT AS row_id, round(CASE WHEN value = q THEN (i0 + i1) / 2.0
      ELSE i1 + (value - q) / (nxt - q) END / (k - 1), 6) + 0.0 AS t FROM ev ASOF JOIN knots ON value >= q""", using=("events_value",),
      extra="""ev AS (SELECT row_id, value, least(1000, count(*) OVER ()) AS k FROM events_value),
      grid AS (SELECT unnest(range(k)) AS i, unnest(quantile_cont) AS q FROM (
        SELECT k, list_transform(range(k), lambda j: v[1 + floor(j * (n - 1) / (k - 1.0))::BIGINT] + (j * (n - 1) / (k - 1.0) - floor(j * (n - 1) / (k - 1.0)))
          * (v[least(n, 2 + floor(j * (n - 1) / (k - 1.0))::BIGINT)] - v[1 + floor(j * (n - 1) / (k - 1.0))::BIGINT])) AS quantile_cont
        FROM (SELECT list_sort(list(value)) AS v, count(*) AS n, least(1000, count(*)) AS k FROM events_value))),
      knots AS (SELECT q, min(i) AS i0, max(i) AS i1, lead(q) OVER (ORDER BY q) AS nxt FROM grid GROUP BY q)""")(_quantile("uniform"))
query("quantile_normal")(_quantile("normal"))


@query("transform_numerical", """SELECT row_id::BIGINT AS row_id,
       round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) + 0.0 AS c_acctbal,
       round((n_orders - avg(n_orders) OVER ()) / stddev_pop(n_orders) OVER (), 6) + 0.0 AS n_orders FROM cust_feat""",
       using=("cust_feat",))
def transform_numerical(spark, d):
    df = fx.cust_feat(spark, d).select("row_id", "c_acctbal", "n_orders")
    return tidy(TabularDataset.of(df, low_unique_is_categorical=False).transform_numerical("standard").df)


INVERTIBLE = ["standard", "minmax", "robust", "symlog", "arcsinh", "yeo-johnson"]


@query("inverse_transforms", "SELECT row_id::BIGINT AS row_id, " + ", ".join(
    f"round(c_acctbal, 4) + 0.0 AS \"{m}\"" for m in INVERTIBLE) + " FROM cust_feat", using=("cust_feat",))
def inverse_transforms(spark, d):
    """Forward then inverse of every transform gives the input back."""
    df = fx.cust_feat(spark, d).select("row_id", "c_acctbal")
    models = {m: transforms.Scaler(m, ["c_acctbal"], lambdas={"c_acctbal": 0.5}).fit(df) for m in INVERTIBLE}
    fwd = df.select("row_id", *[F.expr(s.forward_sql("c_acctbal")).alias(m) for m, s in models.items()])
    return tidy(fwd.select("row_id", *[F.expr(s.inverse_sql("c_acctbal", f"`{m}`")).alias(m) for m, s in models.items()]),
                digits=4)


# --- preprocessing ------------------------------------------------------------------------------

def _features(spark, d):
    return fx.user_day(spark, d).drop("y")


@query("preprocess_v1")
def preprocess_v1(spark, d):
    df = _features(spark, d)
    return tidy(preprocess.preprocess_v1(df, ["row_id"], drop=["n_view"]).transform(df))


@query("preprocess_v2")
def preprocess_v2(spark, d):
    df = _features(spark, d)
    return tidy(preprocess.preprocess_v2(df, ["row_id"], drop=["n_view"]).transform(df))


@query("prepare_train")
def prepare_train(spark, d):
    df = fx.cust_feat(spark, d).withColumn("target", F.when(F.col("n_orders") > 10, "HIGH").otherwise("LOW")).persist()
    out, _, _ = preprocess.prepare_train(df, "target", remove=["n_orders"], target_mapping={"LOW": 0, "HIGH": 1},
                                         stratify=True)
    return tidy(out)


# --- selection ------------------------------------------------------------------------------------

DOCS = ["n_chars", "n_words", "n_lines"]


@query("select_k_anova", "SELECT feature, round(f, 6) AS score, rank FROM (SELECT *, row_number() OVER (ORDER BY f DESC, feature)::BIGINT AS rank FROM ("
       + " UNION ALL ".join(f"""SELECT '{c}' AS feature, (sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*))) AS f
       FROM (SELECT quality, count(*) AS n, avg({c}) AS m, var_pop({c}) * count(*) AS w, (SELECT avg({c}) FROM doc_feat WHERE quality IS NOT NULL) AS g
       FROM doc_feat WHERE quality IS NOT NULL GROUP BY quality)""" for c in DOCS) + ")) WHERE rank <= 2", using=("doc_feat",))
def select_k_anova(spark, d):
    return tidy(select.anova_scores(fx.doc_feat(spark, d), DOCS, "quality", k=2))


_FREG = ["n_words", "n_lines", "toxic"]


@query("select_k_freg", "SELECT feature, round(f, 4) AS score, rank FROM (SELECT *, row_number() OVER (ORDER BY f DESC, feature)::BIGINT AS rank FROM ("
       + " UNION ALL ".join(f"SELECT '{c}' AS feature, r * r * (n - 2) / (1 - r * r) AS f FROM (SELECT corr({c}, n_chars) AS r, count(*) AS n "
                            f"FROM doc_feat WHERE {c} IS NOT NULL)" for c in _FREG) + ")) WHERE rank <= 2", using=("doc_feat",))
def select_k_freg(spark, d):
    return tidy(select.regression_f_scores(fx.doc_feat(spark, d), _FREG, "n_chars", k=2), digits=4)


def _bin_sql(c):
    return (f"least(floor(({c} - min({c}) OVER ()) / ((max({c}) OVER () - min({c}) OVER ()) / 10)), 9)")


def _mi_sql(target):
    return " UNION ALL ".join(f"""SELECT '{c}' AS feature, round(sum(n::DOUBLE / t * ln(n::DOUBLE * t / (na * nb))), 6) + 0.0 AS score FROM (
        SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY a) AS na, sum(n) OVER (PARTITION BY b) AS nb FROM (
        SELECT a, b, count(*) AS n FROM (SELECT {_bin_sql(c)} AS a, {target} AS b FROM lab) GROUP BY a, b))""" for c in DOCS[1:])


_LAB = "lab AS (SELECT * FROM doc_feat WHERE quality IS NOT NULL)"


@query("mutual_info_binned", _mi_sql("quality"), using=("doc_feat",), extra=_LAB)
def mutual_info_binned(spark, d):
    return tidy(select.mutual_information(fx.doc_feat(spark, d), DOCS[1:], "quality"))


def _neighbour_sql(c, k=3):
    """All pairs of one feature: psi of whole numbers is a harmonic sum, and the Euler constants cancel."""
    return f"""SELECT '{c}' AS feature, round(greatest(0, psi_n + mean), 6) + 0.0 AS score FROM (
        SELECT avg(own.psi - cls.psi - alle.psi) AS mean, any_value(total.psi) AS psi_n FROM (
            SELECT i, size, n, sum(CASE WHEN same AND near THEN 1 ELSE 0 END) AS own_rows, sum(CASE WHEN near THEN 1 ELSE 0 END) AS all_rows FROM (
                SELECT *, CASE WHEN r = 0 THEN dist = 0 ELSE dist < r END AS near FROM (
                    SELECT *, max(CASE WHEN same AND j <> i AND nth = least({k}, size - 1) THEN dist END) OVER (PARTITION BY i) AS r FROM (
                        SELECT a.row_id AS i, b.row_id AS j, a.size, a.n, a.y = b.y AS same, abs(a.x - b.x) AS dist,
                            row_number() OVER (PARTITION BY a.row_id, a.y = b.y, a.row_id = b.row_id ORDER BY abs(a.x - b.x)) AS nth
                        FROM pts_{c} a CROSS JOIN pts_{c} b)))
            GROUP BY i, size, n) q
        JOIN psi own ON own.m = q.own_rows JOIN psi cls ON cls.m = q.size JOIN psi alle ON alle.m = q.all_rows JOIN psi total ON total.m = q.n)"""


_POINTS = [f"""pts_{c} AS (SELECT *, count(*) OVER () AS n FROM (SELECT row_id, quality AS y, {c} AS x, count(*) OVER (PARTITION BY quality) AS size
    FROM doc_feat WHERE quality IS NOT NULL AND {c} IS NOT NULL) WHERE size > 1)""" for c in DOCS[1:]]
_PSI = "psi AS (SELECT m, coalesce(sum(1.0::DOUBLE / (m - 1)) FILTER (m > 1) OVER (ORDER BY m), 0) AS psi FROM (SELECT unnest(range(1, (SELECT count(*) + 2 FROM documents))) AS m))"


@query("mutual_info_neighbours", " UNION ALL ".join(map(_neighbour_sql, DOCS[1:])), using=("doc_feat",), extra=", ".join([*_POINTS, _PSI]))
def mutual_info_neighbours(spark, d):
    return tidy(information.neighbour_information(fx.doc_feat(spark, d), DOCS[1:], "quality"))


@query("mutual_info_neighbours_blocks", " UNION ALL ".join(map(_neighbour_sql, DOCS[1:])), using=("doc_feat",), extra=", ".join([*_POINTS, _PSI]))
def mutual_info_neighbours_blocks(spark, d):
    """The same in blocks of 50 values, as a large table is cut."""
    return tidy(information.neighbour_information(fx.doc_feat(spark, d), DOCS[1:], "quality", rows_per_block=50))


@query("mutual_info_regression_binned", _mi_sql(_bin_sql("n_chars")), using=("doc_feat",), extra="lab AS (SELECT * FROM doc_feat)")
def mutual_info_regression_binned(spark, d):
    return tidy(select.mutual_information(fx.doc_feat(spark, d), DOCS[1:], "n_chars", regression=True))


@query("chi2_scores", " UNION ALL ".join(f"""SELECT '{c}' AS feature, round(sum((o - e) * (o - e) / e), 4) AS score FROM (
       SELECT sum({c}) AS o, (SELECT sum({c}) FROM lab) * count(*) / (SELECT count(*) FROM lab) AS e FROM lab GROUP BY quality)"""
       for c in DOCS), using=("doc_feat",), extra=_LAB)
def chi2_scores(spark, d):
    return tidy(select.chi2_scores(fx.doc_feat(spark, d), DOCS, "quality"), digits=4)


_KF = """nf AS (SELECT count(*) AS n FROM doc_feat),
    kf AS (SELECT *, CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
      ELSE n % 5 + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold
      FROM (SELECT d.*, n, row_number() OVER (ORDER BY row_id) - 1 AS i FROM doc_feat d, nf))"""


def _cv_sql(c):
    per_fold = " UNION ALL ".join(
        f"""SELECT sqrt(avg(power(n_chars - (s * {c} + q), 2))) AS e FROM kf, (SELECT regr_slope(n_chars, {c}) AS s,
        regr_intercept(n_chars, {c}) AS q FROM kf WHERE fold <> {k}) WHERE fold = {k}""" for k in range(5))
    return f"SELECT '{c}' AS feature, -avg(e) AS v FROM ({per_fold})"


@query("univariate_cv_rank", "SELECT feature, round(v, 4) AS neg_rmse, row_number() OVER (ORDER BY v DESC, feature)::BIGINT AS rank FROM ("
       + " UNION ALL ".join(map(_cv_sql, DOCS[1:])) + ")", using=("doc_feat",), extra=_KF)
def univariate_cv_rank(spark, d):
    df = split.kfold(fx.doc_feat(spark, d).select("row_id", *DOCS))
    return tidy(select.univariate_cv_rank(df, DOCS[1:], "n_chars"), digits=4)


@query("rfe_cv")
def rfe_cv(spark, d):
    df = fx.user_day(spark, d).withColumn("label", F.when(F.col("y") > 0, 1.0).otherwise(0.0))
    df = split.stratified_kfold(df, "label", n_splits=5)
    return tidy(select.rfe_cv(df, fx.USER_DAY_FEATURES, "label", step=3, max_iter=3, max_depth=2))


# --- reduction ---------------------------------------------------------------------------------------

@query("pca_project")
def pca_project(spark, d):
    return tidy(reduce.pca_project(fx.embed_wide(spark, d), fx.EMBED_COLUMNS, ["row_id", "label"], 2))


@query("pca_variance")
def pca_variance(spark, d):
    return tidy(reduce.pca_variance(fx.embed_wide(spark, d), fx.EMBED_COLUMNS))


@query("lda_project")
def lda_project(spark, d):
    return tidy(reduce.lda_project(fx.embed_wide(spark, d), fx.EMBED_COLUMNS, "label", ["row_id", "label"], 2))


@query("ica_project")
def ica_project(spark, d):
    return tidy(reduce.ica_project(fx.embed_wide(spark, d), fx.EMBED_COLUMNS, ["row_id", "label"], 2))


@query("reduce_dispatch")
def reduce_dispatch(spark, d):
    docs = fx.doc_feat(spark, d)
    parts = [reduce.reduce(docs, DOCS, m, ["row_id"], 2, label="lang").select(
        F.lit(m).alias("method"), "row_id", F.col("lang").alias("group"), "c1", "c2") for m in ("pca", "lda", "ica")]
    return tidy(fold_left(lambda a, b: a.unionByName(b), parts))


@query("nystroem_features")
def nystroem_features(spark, d):
    return tidy(reduce.nystroem(fx.embeddings(spark, d), "x", ["row_id"], "row_id", n_components=100))
