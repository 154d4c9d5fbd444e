"""Models, two-part models, folds and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabspark.operators import gram, grids, metrics, models, neighbours, search, split, twopart
from tabspark.operators.small import small_table
from tabspark.plans.registry import query, tidy
from tabspark.sources import fixtures as fx, io

FEATS = fx.USER_DAY_FEATURES


def two_part_by_split(spark, d):
    """Hurdle model fitted on the train split, all five metrics per split."""
    df = split.hash_split(fx.user_day(spark, d)).persist()
    model = twopart.HurdleRegression(FEATS, "y").fit(df.filter("split = 'train'"))
    return tidy(metrics.regression_by(model.transform(df), "y", "prediction", "split"))


query("two_part_by_split")(two_part_by_split)


# --- linear ------------------------------------------------------------------------------------

ALPHAS = [0.0005, 0.1, 1.0, 10.0]


@query("ridge_fit", "SELECT alpha, 'n_words' AS term, round(s / (v + alpha), 6) AS coef FROM mom "
       "UNION ALL SELECT alpha, 'const', round(my - mx * s / (v + alpha), 6) FROM mom", using=("doc_feat",),
       extra="""mom AS (SELECT * FROM (SELECT covar_pop(n_chars, n_words) * count(*) AS s, var_pop(n_words) * count(*) AS v,
       avg(n_chars) AS my, avg(n_words) AS mx FROM doc_feat), (VALUES (0.0005::DOUBLE), (0.1::DOUBLE), (1.0::DOUBLE), (10.0::DOUBLE)) a(alpha))""")
def ridge_fit(spark, d):
    return tidy(gram.ridge_path(fx.doc_feat(spark, d), ["n_words"], "n_chars", ALPHAS), exact=("alpha",))


_FOLDED = """f AS (SELECT n_chars, n_words, ('0x' || substr(md5('42:' || row_id), 1, 8))::BIGINT % 5 AS fold FROM doc_feat),
    cv AS (SELECT alpha, k, s / (v + alpha) AS b, my - mx * s / (v + alpha) AS q FROM (
      SELECT k, covar_pop(n_chars, n_words) * count(*) AS s, var_pop(n_words) * count(*) AS v, avg(n_chars) AS my, avg(n_words) AS mx
      FROM f, (SELECT unnest(range(5)) AS k) WHERE fold <> k GROUP BY k),
      (VALUES (0.0005::DOUBLE), (0.1::DOUBLE), (1.0::DOUBLE), (10.0::DOUBLE)) a(alpha)),
    sc AS (SELECT alpha, avg(e) AS rmse FROM (SELECT alpha, k, sqrt(avg(power(n_chars - b * n_words - q, 2))) AS e
      FROM f JOIN cv ON f.fold = cv.k GROUP BY alpha, k) GROUP BY alpha)"""


def hashed_folds(df, key="row_id", n_splits=5):
    from tabspark.functions.scalar import hash32

    return df.withColumn("fold", F.pmod(hash32(F.col(key), 42), F.lit(n_splits)))


@query("ridge_grid_cv", "SELECT alpha, round(rmse, 6) AS rmse, rank() OVER (ORDER BY rmse)::BIGINT AS rank FROM sc",
       using=("doc_feat",), extra=_FOLDED)
def ridge_grid_cv(spark, d):
    df = hashed_folds(fx.doc_feat(spark, d))
    return tidy(gram.ridge_grid_cv(df, ["n_words"], "n_chars", ALPHAS), exact=("alpha",))


def _fitted(name, label, features=FEATS, source=fx.user_day, prep=None, **params):
    """Fit on the train split, predict every row."""
    def run(spark, d):
        df = source(spark, d)
        if prep is not None:
            df = prep(df)
        df = split.hash_split(df).persist()
        model = models.estimator(name, features, label, params).fit(df.filter("split = 'train'"))
        return tidy(model.transform(df).select("row_id", F.col(label).cast("double").alias("y"), "prediction"))
    return run


def _any_purchase(df):
    return df.withColumn("label", F.when(F.col("y") > 0, 1.0).otherwise(0.0))


def _shifted(df):
    """A strictly positive target for the log-link families."""
    return df.withColumn("amount", F.col("y") + 1.0)


query("lasso_fit")(_fitted("Lasso", "y", alpha=0.1))
query("tweedie_fit")(_fitted("TweedieRegressor", "y", power=1.5, alpha=0.1))
query("gamma_fit")(_fitted("GammaRegressor", "amount", prep=_shifted, alpha=0.1))
query("poisson_fit")(_fitted("PoissonRegressor", "y", alpha=0.1))
query("gbt_regress")(_fitted("GradientBoostingRegressor", "y"))
query("gbt_classify")(_fitted("GradientBoostingClassifier", "label", prep=_any_purchase))
query("logistic_fit")(_fitted("LogisticRegression", "label", prep=_any_purchase, class_weight="balanced"))
query("ridge_classify")(_fitted("RidgeClassifier", "label", prep=_any_purchase, class_weight="balanced"))
query("linear_gd_fit")(_fitted("SGDRegressor", "y", loss="huber", epsilon=10.0))
query("linear_gd_classify")(_fitted("SGDClassifier", "label", prep=_any_purchase, loss="modified_huber",
                                    class_weight="balanced"))
query("kernel_nystroem_fit")(_fitted("KernelRidge", "y", kernel="rbf"))
query("kernel_svc_fit")(_fitted("SVC", "label", prep=_any_purchase, kernel="rbf", n_components=100,
                                class_weight="balanced"))
query("lda_fit")(_fitted("LinearDiscriminantAnalysis", "label", prep=_any_purchase))
query("qda_fit")(_fitted("QuadraticDiscriminantAnalysis", "label", prep=_any_purchase, reg_param=0.1))


@query("transformed_target")
def transformed_target(spark, d):
    df = split.hash_split(fx.user_day(spark, d)).persist()
    model = models.transformed_target(df.filter("split = 'train'"), "Ridge", FEATS, "y", "yeo-johnson", {"alpha": 1.0})
    return tidy(model.transform(df).select("row_id", "y", "prediction"))


_EMB_SPLIT = """('0x' || substr(md5('42:' || row_id), 1, 8))::BIGINT < 858993459"""


@query("gaussian_nb", f"""SELECT row_id::BIGINT AS row_id, max_by(label, s)::DOUBLE AS prediction FROM (
       SELECT e.row_id, c.label, any_value(c.prior) + sum(-0.5 * ln(2 * pi() * c.v) - (e.val - c.m) * (e.val - c.m) / (2 * c.v)) AS s
       FROM emb_long e JOIN cls c USING (pos) GROUP BY e.row_id, c.label) GROUP BY row_id""", using=("emb_long",),
       extra=f"""tr AS (SELECT * FROM emb_long WHERE NOT {_EMB_SPLIT}),
       eps AS (SELECT 1e-9 * max(v) AS eps FROM (SELECT var_pop(val) AS v FROM tr GROUP BY pos)),
       cls AS (SELECT label, pos, avg(val) AS m, var_pop(val) + any_value(eps) AS v,
         ln(count(*)::DOUBLE * 64 / (SELECT count(*) FROM tr)) AS prior FROM tr, eps GROUP BY label, pos)""")
def gaussian_nb(spark, d):
    df = split.hash_split(fx.embed_wide(spark, d))
    model = models.estimator("GaussianNB", fx.EMBED_COLUMNS, "label").fit(df.filter("split = 'train'"))
    return tidy(models.predict(df, model, ["row_id"]))


@query("knn_classify", f"""SELECT row_id::BIGINT AS row_id, arg_min(label, struct_pack(v := -n, l := label))::BIGINT AS prediction FROM (
       SELECT q AS row_id, label, count(*) AS n FROM (
         SELECT a.vec_id AS q, b.vec_id AS t, b.label, row_number() OVER (PARTITION BY a.vec_id
           ORDER BY round(sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: power(z[1]::DOUBLE - z[2]::DOUBLE, 2)))), 9), b.vec_id) AS rk
         FROM embeddings a, (SELECT *, vec_id AS row_id FROM embeddings) b WHERE NOT {_EMB_SPLIT.replace('row_id', 'b.row_id')})
       WHERE rk <= 5 GROUP BY q, label) GROUP BY row_id""")
def knn_classify(spark, d):
    df = split.hash_split(fx.embeddings(spark, d))
    return tidy(neighbours.knn_classify(df.filter("split = 'train'"), df, k=5))


# --- neighbours of wide vectors: every hundredth row asks all rows --------------------------------

@query("knn_wide", """SELECT q AS vec_id, t AS neighbour, round(round(d, 9), 6) AS distance, rank FROM (
       SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(d, 9), t)::BIGINT AS rank FROM (
         SELECT a.vec_id AS q, b.vec_id AS t, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d
         FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0)) WHERE rank <= 10""")
def knn_wide(spark, d):
    df = fx.embeddings(spark, d)
    out = neighbours.nearest_neighbours(df, df.filter("row_id % 100 = 0"), 10)
    return tidy(out.select(F.col("row_id").alias("vec_id"), "neighbour", "distance", "rank"))


@query("knn_index_recall", """SELECT count(*) AS queries, 10 * count(*) AS neighbours, 1::BIGINT AS recall_reached,
       count(*) AS own_found FROM embeddings WHERE vec_id % 100 = 0""")
def knn_index_recall(spark, d):
    df = fx.embeddings(spark, d).persist()
    asked = df.filter("row_id % 100 = 0")
    index = neighbours.fit_index(df, 10)
    own = neighbours.nearest_neighbours(df, asked, 1, index=index).filter("row_id = neighbour")
    report = neighbours.index_report(df, asked, 10, index).select(
        "queries", "neighbours", F.when(F.col("recall") >= 0.9, 1).otherwise(0).alias("recall_reached"), F.lit(0).alias("own_found"))
    each = own.select(*[F.lit(0).alias(c) for c in report.columns[:3]], F.lit(1).alias("own_found"))
    return tidy(report.unionByName(each).agg(*[F.sum(c).alias(c) for c in report.columns]))


# --- two-part -----------------------------------------------------------------------------------

def _hurdle(expected):
    def run(spark, d):
        df = split.hash_split(fx.user_day(spark, d)).persist()
        model = twopart.HurdleRegression(FEATS, "y", reg_name="Ridge").fit(df.filter("split = 'train'"))
        out = model.expected_value(df) if expected else model.transform(df)
        return tidy(out.select("row_id", "y", "prediction"))
    return run


query("hurdle_predict")(_hurdle(False))
query("hurdle_expected")(_hurdle(True))


@query("zir_predict")
def zir_predict(spark, d):
    df = split.hash_split(fx.user_day(spark, d).withColumn("is_zero", F.when(F.col("y") == 0, 1.0).otherwise(0.0))).persist()
    train = df.filter("split = 'train'")
    clf = models.estimator("LogisticRegression", FEATS, "is_zero").fit(train)
    reg = models.estimator("LinearRegression", FEATS, "y").fit(train.filter("y > 0"))
    return tidy(twopart.ZeroInflatedModel(clf, reg).transform(df).select("row_id", "y", "prediction"))


@query("zir_compose", """SELECT row_id::BIGINT AS row_id, CASE WHEN n_events >= 3 THEN 12.5 * n_events ELSE 0 END::DOUBLE AS prediction
       FROM user_day""", using=("user_day",))
def zir_compose(spark, d):
    df = fx.user_day(spark, d)
    zero = F.when(F.col("n_events") >= 3, 0).otherwise(1)
    return tidy(df.select("row_id", twopart.compose(zero, F.col("n_events") * 12.5).alias("prediction")))


# --- splits and folds ---------------------------------------------------------------------------

def _h(seed, key="row_id"):
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT"


@query("hash_split", f"""SELECT row_id::BIGINT AS row_id, CASE WHEN {_h(42)} < 858993459 THEN 'test' ELSE 'train' END AS split FROM user_day""",
       using=("user_day",))
def hash_split(spark, d):
    return split.hash_split(fx.user_day(spark, d).select("row_id"))


@query("stratified_split", f"""SELECT row_id::BIGINT AS row_id, y::BIGINT AS y, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY {_h(42)}, row_id)
       <= ceil(0.2 * count(*) OVER (PARTITION BY y)) THEN 'test' ELSE 'train' END AS split FROM scored""", using=("scored",))
def stratified_split(spark, d):
    return tidy(split.stratified_split(fx.scored(spark, d).select("row_id", "y"), "y"))


@query("shuffle_split", """SELECT row_id::BIGINT AS row_id, r::BIGINT AS repeat, CASE WHEN ('0x' || substr(md5('42:' || r || ':' || row_id), 1, 8))::BIGINT
       < 858993459 THEN 'test' ELSE 'train' END AS split FROM scored, (SELECT unnest(range(5)) AS r)""", using=("scored",))
def shuffle_split(spark, d):
    return split.shuffle_split(fx.scored(spark, d).select("row_id"))


@query("kfold_assign", """SELECT row_id::BIGINT AS row_id, CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
       ELSE n % 5 + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END::BIGINT AS fold
       FROM (SELECT row_id, count(*) OVER () AS n, row_number() OVER (ORDER BY row_id) - 1 AS i FROM scored)""", using=("scored",))
def kfold_assign(spark, d):
    return tidy(split.kfold(fx.scored(spark, d).select("row_id")))


_SKF = """sk AS (SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY row_id) AS i,
    count(*) OVER (PARTITION BY y) AS n, (SELECT count(*) FROM scored s WHERE s.y < scored.y) AS st FROM scored),
    cum AS (SELECT y, f, sum(c) OVER (PARTITION BY y ORDER BY f) AS edge FROM (
      SELECT y, f, (CASE WHEN e > f THEN (e - f + 4) // 5 ELSE 0 END) - (CASE WHEN b > f THEN (b - f + 4) // 5 ELSE 0 END) AS c
      FROM (SELECT y, any_value(st) AS b, any_value(st) + any_value(n) AS e FROM sk GROUP BY y), (SELECT unnest(range(5)) AS f))),
    folded AS (SELECT row_id, sk.y, min(f) AS fold FROM sk JOIN cum ON cum.y = sk.y AND sk.i <= cum.edge GROUP BY row_id, sk.y)"""


@query("stratified_kfold", "SELECT row_id::BIGINT AS row_id, fold::BIGINT AS fold FROM folded", using=("scored",), extra=_SKF)
def stratified_kfold(spark, d):
    return tidy(split.stratified_kfold(fx.scored(spark, d), "y").select("row_id", "fold"))


@query("masked_folds", """SELECT k::BIGINT AS fold, part, count(*) FILTER (CASE WHEN part = 'train' THEN fold <> k AND score <= 0.9 ELSE fold = k END)::BIGINT AS n
       FROM (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS i, count(*) OVER () AS c FROM scored) s,
       LATERAL (SELECT CASE WHEN i < (c % 5) * (c // 5 + 1) THEN i // (c // 5 + 1) ELSE c % 5 + (i - (c % 5) * (c // 5 + 1)) // (c // 5) END AS fold),
       (SELECT unnest(range(5)) AS k), (SELECT unnest(['train', 'val']) AS part) GROUP BY k, part""", using=("scored",))
def masked_folds(spark, d):
    df = split.kfold(fx.scored(spark, d))
    return tidy(split.masked_fold_sizes(df, F.col("score") <= 0.9, 5))


# --- trials and search ---------------------------------------------------------------------------

_RIDGE_TRIALS = """(SELECT row_number() OVER (ORDER BY a, b) - 1 AS trial, alpha, fit_intercept FROM
    (VALUES (0, 0.0005::DOUBLE), (1, 0.1::DOUBLE), (2, 1.0::DOUBLE), (3, 10.0::DOUBLE)) x(a, alpha), (VALUES (0, 'True'), (1, 'False')) z(b, fit_intercept))"""


@query("trials_table", f"""SELECT t.trial::BIGINT AS trial, t.alpha, t.fit_intercept, m.k::BIGINT AS fold, any_value(m.n)::BIGINT AS n_train, count(*)::BIGINT AS n_val,
       round(sqrt(avg(power(y - CASE WHEN t.fit_intercept = 'True' THEN my + (x - mx) * n * c / (n * v + t.alpha) ELSE x * sxy / (sxx + t.alpha) END, 2))), 4) AS rmse
       FROM tt JOIN m ON tt.fold = m.k, {_RIDGE_TRIALS} t GROUP BY t.trial, t.alpha, t.fit_intercept, m.k""", using=("doc_feat",),
       extra=f"""tt AS (SELECT n_chars AS y, n_words AS x, {_h(42)} % 5 AS fold FROM doc_feat),
       m AS (SELECT k, count(*)::DOUBLE AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS v, covar_pop(y, x) AS c, sum(x * x) AS sxx, sum(x * y) AS sxy
         FROM tt, (SELECT unnest(range(5)) AS k) WHERE fold <> k GROUP BY k)""")
def trials_table(spark, d):
    """Every (trial, fold) fit of the built-in ridge grid: its row counts and held-out error."""
    trials = grids.expand(grids.choose_grid("Ridge"))
    df = hashed_folds(fx.doc_feat(spark, d))
    scores = search.cross_validate(df, ["n_words"], "n_chars", "Ridge", trials).filter("set = 'val' AND metric = 'RMSE'")
    sizes = {r["fold"]: r["count"] for r in df.groupBy("fold").count().collect()}
    n = F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (int(k), v)])
    entries = F.array(*[F.struct(F.lit(float(t["alpha"])).alias("alpha"), F.lit(str(t["fit_intercept"])).alias("fit_intercept")) for t in trials])
    own = entries[F.col("trial").cast("int")]
    return tidy(scores.select("trial", own["alpha"].alias("alpha"), own["fit_intercept"].alias("fit_intercept"), "fold",
                              (F.lit(sum(sizes.values())) - n[F.col("fold").cast("int")]).alias("n_train"), n[F.col("fold").cast("int")].alias("n_val"),
                              F.col("value").alias("rmse")), exact=("alpha",), rmse=4)


@query("grid_product", """SELECT (row_number() OVER (ORDER BY p, c, a, b) - 1)::BIGINT AS trial, pen AS clf_penalty, cv AS clf_c, alpha AS reg_alpha,
       fit_intercept AS reg_fit_intercept, (SELECT count(*) FROM user_day)::BIGINT AS n_clf_rows, (SELECT count(*) FROM user_day WHERE y > 0)::BIGINT AS n_reg_rows
       FROM (VALUES (0, 'None'), (1, 'l2')) x1(p, pen), (VALUES (0, 0.1::DOUBLE), (1, 1.0::DOUBLE)) x2(c, cv),
       (VALUES (0, 0.0005::DOUBLE), (1, 0.1::DOUBLE)) x3(a, alpha), (VALUES (0, 'True'), (1, 'False')) x4(b, fit_intercept)""", using=("user_day",))
def grid_product(spark, d):
    """The two-part grid product with the rows each part is fitted on."""
    clf = {k: v for k, v in grids.truncate(grids.choose_grid("LogisticRegression")[0]).items() if k in ("penalty", "C")}
    clf = {f"clf__{k}": clf[k] for k in ("penalty", "C")}
    reg = {f"reg__{k}": v for k, v in grids.truncate(grids.choose_grid("Ridge")).items()}
    trials = grids.expand(grids.combine(clf, reg))
    entries = F.array(*[F.struct(
        F.lit(i).cast("bigint").alias("trial"), F.lit(str(t["clf__penalty"])).alias("clf_penalty"),
        F.lit(float(t["clf__C"])).alias("clf_c"), F.lit(t["reg__alpha"]).alias("reg_alpha"),
        F.lit(str(t["reg__fit_intercept"])).alias("reg_fit_intercept")) for i, t in enumerate(trials)])
    rows = fx.user_day(spark, d).agg(F.count(F.lit(1)).alias("n_clf_rows"), F.count_if(F.col("y") > 0).alias("n_reg_rows"))
    return tidy(rows.select(F.explode(entries).alias("t"), "n_clf_rows", "n_reg_rows").select("t.*", "n_clf_rows", "n_reg_rows"),
                exact=("clf_c", "reg_alpha"))


def _searchable(spark, d):
    return hashed_folds(_any_purchase(fx.user_day(spark, d)))


@query("grid_search_classify")
def grid_search_classify(spark, d):
    grid = {"C": [0.1, 1], "class_weight": ["balanced", None]}
    return tidy(search.grid_search(_searchable(spark, d), FEATS, "label", "LogisticRegression", grid))


@query("random_search")
def random_search(spark, d):
    return tidy(search.random_search(_searchable(spark, d), FEATS, "y", "Ridge"))


@query("model_search")
def model_search(spark, d):
    df = split.hash_split(_searchable(spark, d)).persist()
    root = io.scratch_dir(spark, "runs")
    return tidy(search.model_search(df.filter("split = 'train'").drop("split"), df.filter("split = 'test'").drop("split"),
                                    FEATS, "y", {"LinearRegression": None, "Ridge": None}, "regression", root=root))
