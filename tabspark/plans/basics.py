"""Sources, projection, typing, encoding and filling."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tabspark.functions.scalar import dbl, format_number
from tabspark.operators import encode, fill, profile, project, roles, select, sparse
from tabspark.operators.outliers import outlier_mask
from tabspark.operators.small import small_table
from tabspark.plans.registry import query, tidy
from tabspark.sources import fixtures as fx, io

CUSTOMER_CSV = "c_custkey bigint, c_name string, c_acctbal double"


@query("scan_csv_roundtrip", "SELECT c_custkey::BIGINT AS c_custkey, c_name, c_acctbal::DOUBLE AS c_acctbal FROM customer")
def scan_csv_roundtrip(spark, d):
    path = io.scratch_dir(spark, "csv")
    io.write_csv(io.read_table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return tidy(io.read_csv(spark, path, CUSTOMER_CSV), exact=("c_acctbal",))


@query("json_roundtrip",
       "SELECT event_id::BIGINT AS row_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json_roundtrip(spark, d):
    e = io.read_table(spark, d, "events")
    return e.select(F.col("event_id").cast("bigint").alias("row_id"),
                    io.json_field(F.col("props"), "k bigint", "k").alias("k"))


@query("drop_columns", """SELECT row_id::BIGINT AS row_id, c_mktsegment, c_acctbal::DOUBLE AS c_acctbal,
       round(spend, 4) + 0.0 AS spend, n_orders, n_final FROM cust_feat""", using=("cust_feat",))
def drop_columns(spark, d):
    return tidy(project.drop_columns(fx.cust_feat(spark, d), ["c_nationkey", "no_such_column"]),
                exact=("c_acctbal",), spend=4)


@query("select_existing", "SELECT row_id::BIGINT AS row_id, n_orders, c_mktsegment FROM cust_feat", using=("cust_feat",))
def select_existing(spark, d):
    return tidy(project.select_existing(fx.cust_feat(spark, d), ["row_id", "absent", "n_orders", "c_mktsegment"]))


@query("column_extract", "SELECT row_id::BIGINT AS row_id, c_mktsegment, c_nationkey::BIGINT AS c_nationkey, n_final FROM cust_feat",
       using=("cust_feat",))
def column_extract(spark, d):
    return tidy(project.extract_columns(fx.cust_feat(spark, d), [0, 1, 2, 6]))


@query("rename_columns", "SELECT row_id::BIGINT AS row_id, c_mktsegment AS segment, n_orders AS orders FROM cust_feat",
       using=("cust_feat",))
def rename_columns(spark, d):
    df = fx.cust_feat(spark, d).select("row_id", "c_mktsegment", "n_orders")
    return tidy(project.rename_columns(df, {"c_mktsegment": "segment", "n_orders": "orders"}))


SEGMENT_CODES = {"BUILDING": 0, "MACHINERY": 1, "HOUSEHOLD": 2}


@query("map_values", """SELECT row_id::BIGINT AS row_id, CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1
       WHEN 'HOUSEHOLD' THEN 2 END::BIGINT AS code FROM cust_feat""", using=("cust_feat",))
def map_values(spark, d):
    df = project.map_values(fx.cust_feat(spark, d), "c_mktsegment", SEGMENT_CODES, out="code")
    return tidy(df.select("row_id", "code"))


@query("zero_indicator", "SELECT row_id::BIGINT AS row_id, CASE WHEN y = 0 THEN 1 ELSE 0 END::BIGINT AS is_zero FROM user_day",
       using=("user_day",))
def zero_indicator(spark, d):
    return tidy(fx.user_day(spark, d).select("row_id", project.zero_indicator("y").alias("is_zero")))


@query("filter_masks", """SELECT row_id::BIGINT AS row_id, round(y, 6) + 0.0 AS y FROM user_day
       WHERE y > 0 AND abs(y - (SELECT avg(y) FROM user_day)) / (SELECT stddev_pop(y) FROM user_day) <= 3""",
       using=("user_day",))
def filter_masks(spark, d):
    df = fx.user_day(spark, d)
    return tidy(project.keep_rows(df, F.col("y") > 0, drop=[outlier_mask(df, "y")]).select("row_id", "y"))


@query("drop_rows_by_id", "SELECT row_id::BIGINT AS row_id, round(y, 6) + 0.0 AS y FROM user_day WHERE n_error = 0",
       using=("user_day",))
def drop_rows_by_id(spark, d):
    df = fx.user_day(spark, d)
    return tidy(project.drop_rows_by_id(df, df.filter("n_error > 0")).select("row_id", "y"))


@query("feature_union", """SELECT row_id::BIGINT AS row_id, lang AS categorical__lang, source AS categorical__source,
       n_chars AS numerical__n_chars, n_words AS numerical__n_words FROM doc_feat""", using=("doc_feat",))
def feature_union(spark, d):
    df = fx.doc_feat(spark, d)
    return tidy(project.feature_union(df, {
        "categorical": {"lang": F.col("lang"), "source": F.col("source")},
        "numerical": {"n_chars": F.col("n_chars"), "n_words": F.col("n_words")}}, ["row_id"]))


@query("assemble_xy", """SELECT row_id::BIGINT AS row_id, n_words, n_lines, n_chars FROM doc_feat""", using=("doc_feat",))
def assemble_xy(spark, d):
    return tidy(project.assemble_xy(fx.doc_feat(spark, d), ["n_words", "n_lines", "quality"], "n_chars",
                                    ["row_id"], omit=["quality"]))


@query("format_number", """SELECT text, count(*)::BIGINT AS n FROM (
       SELECT printf('%.3f', l_quantity * l_discount) AS text FROM lineitem
       UNION ALL SELECT CASE WHEN abs(t) < 1e-7 THEN '0.000' WHEN abs(t) < 1e-3 THEN printf('%.3e', t)
         ELSE printf('%.3f', t) END FROM (SELECT l_discount * l_tax / 1000 AS t FROM lineitem)) GROUP BY text""")
def format_number_query(spark, d):
    li = fx.line_num(spark, d)
    text = F.explode(F.array(
        format_number(F.col("l_quantity") * F.col("l_discount")),
        format_number(F.col("l_discount") * F.col("l_tax") / 1000, precision=7)))
    return li.select(text.alias("text")).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


@query("missing_census", """SELECT 'l_quantity' AS "column", count(*) FILTER (l_quantity IS NULL)::BIGINT AS n_null FROM line_missing
       UNION ALL SELECT 'l_tax', count(*) FILTER (l_tax IS NULL) FROM line_missing
       UNION ALL SELECT 'l_returnflag', count(*) FILTER (l_returnflag IS NULL) FROM line_missing""", using=("line_missing",))
def missing_census(spark, d):
    return profile.missing_census(fx.line_missing(spark, d), ["l_quantity", "l_tax", "l_returnflag"])


def _fill_events(method):
    def run(spark, d):
        return tidy(fill.fill_missing(fx.events_missing(spark, d), ["value"], method, order="row_id",
                                      keys=["user_id"] if method in ("ffill", "bfill") else None)
                    .select("row_id", "value"))
    return run


_FILL = "SELECT row_id::BIGINT AS row_id, round({}, 6) + 0.0 AS value FROM events_missing"
query("fill_mean", _FILL.format("coalesce(value, (SELECT avg(value) FROM events_missing))"),
      using=("events_missing",))(_fill_events("mean"))
query("fill_median", _FILL.format("coalesce(value, (SELECT median(value) FROM events_missing))"),
      using=("events_missing",))(_fill_events("median"))
query("fill_drop", _FILL.format("value") + " WHERE value IS NOT NULL", using=("events_missing",))(_fill_events("drop"))
query("fill_ffill", _FILL.format("last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY row_id "
                                 "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
      using=("events_missing",))(_fill_events("ffill"))
query("fill_bfill", _FILL.format("first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY row_id "
                                 "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"),
      using=("events_missing",))(_fill_events("bfill"))


@query("fill_axis1", """SELECT l_discount, coalesce(l_tax, l_discount) AS l_tax, l_linenumber::BIGINT AS l_linenumber
       FROM line_missing""", using=("line_missing",))
def fill_axis1(spark, d):
    df = fill.fill_missing(fx.line_missing(spark, d), ["l_discount", "l_tax"], "ffill", axis=1)
    return tidy(df.select("l_discount", "l_tax", "l_linenumber"), exact=("l_discount", "l_tax"))


# --- roles --------------------------------------------------------------------------------

CUST_KINDS = {"c_mktsegment": "string", "c_nationkey": "int", "c_acctbal": "float", "spend": "float",
              "n_orders": "int", "n_final": "int"}
LINE_KINDS = {"l_quantity": "float", "l_extendedprice": "float", "l_discount": "float", "l_tax": "float",
              "l_linenumber": "int", "l_returnflag": "string", "l_linestatus": "string"}
ROLE_VARIANTS = {
    "default": {},
    "off": dict(dummy_is_categorical=False, consecutive_is_categorical=False, low_unique_is_categorical=False),
}


def _roles_sql() -> str:
    stats = []
    for table, kinds in (("cust_feat", CUST_KINDS), ("line_num", LINE_KINDS)):
        for c, kind in kinds.items():
            nums = (f"min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi, count(DISTINCT {c})::BIGINT AS nd, "
                    f"count(*) FILTER ({c} NOT IN (0, 1)) AS off" if kind != "string"
                    else "NULL::DOUBLE AS lo, NULL::DOUBLE AS hi, NULL::BIGINT AS nd, 0 AS off")
            stats.append(f"SELECT '{table}' AS tbl, '{c}' AS col, '{kind}' AS kind, count(*) AS n, {nums} FROM {table}")
    flags = "(VALUES ('default', true), ('off', false)) v(variant, flag)"
    reason = """CASE WHEN kind = 'string' THEN 'string'
        WHEN lo = 0 AND hi = 1 AND ((kind = 'int' AND nd = 2) OR (kind = 'float' AND off = 0)) THEN 'binary'
        WHEN flag AND kind = 'int' AND nd > 1 AND lo IN (0, 1) AND hi - lo + 1 = nd THEN 'consecutive'
        WHEN flag AND kind = 'int' AND nd / n <= 0.001 THEN 'low_cardinality' ELSE 'numeric' END"""
    return f"""SELECT tbl AS "table", variant, col AS "column",
        CASE WHEN reason = 'numeric' OR (reason = 'binary' AND NOT flag) THEN 'numerical' ELSE 'categorical' END AS role,
        reason, CASE WHEN kind = 'int' THEN nd END AS n_distinct
        FROM (SELECT *, {reason} AS reason FROM ({' UNION ALL '.join(stats)}), {flags})"""


@query("column_roles", _roles_sql(), using=("cust_feat", "line_num"))
def column_roles(spark, d):
    rows = []
    for table, df in (("cust_feat", fx.cust_feat(spark, d).drop("row_id")), ("line_num", fx.line_num(spark, d))):
        stats = roles.role_statistics(df)
        for variant, flags in ROLE_VARIANTS.items():
            rows += [(table, variant, *r) for r in roles.apply_rules(*stats, **flags)]
    return small_table(spark, rows, "table string, variant string, " + roles.ROLE_SCHEMA)


@query("likely_categorical", """SELECT 'l_linenumber' AS "column", count(DISTINCT l_linenumber)::BIGINT AS n_distinct,
       round(count(DISTINCT l_linenumber) / count(*), 9) AS ratio,
       CASE WHEN count(DISTINCT l_linenumber) / count(*) <= 0.001 THEN 1 ELSE 0 END::BIGINT AS flag FROM line_num""",
       using=("line_num",))
def likely_categorical(spark, d):
    return tidy(roles.likely_categorical(fx.line_num(spark, d)), ratio=9)


def skew_sql(c: str) -> str:
    """Population skewness from raw-centred moments."""
    return (f"(avg(pow({c} - m_{c}, 3)) / pow(avg(pow({c} - m_{c}, 2)), 1.5))")


def _skew_rows(table: str, cols: list[str]) -> str:
    means = ", ".join(f"avg({c}) OVER () AS m_{c}" for c in cols)
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {skew_sql(c)} AS skewness FROM (SELECT *, {means} FROM {table})" for c in cols)


@query("feature_set_decider", f"""SELECT "column", round(skewness, 6) AS skewness,
       CASE WHEN abs(skewness) > 0.75 THEN 'skewed' ELSE 'non_skewed' END AS set FROM (
       {_skew_rows('doc_feat', ['n_chars', 'n_words', 'n_lines'])} UNION ALL {_skew_rows('events_value', ['value'])}
       UNION ALL {_skew_rows('line_num', ['l_quantity', 'l_tax'])})""", using=("doc_feat", "events_value", "line_num"))
def feature_set_decider(spark, d):
    parts = [select.feature_set_table(fx.doc_feat(spark, d), ["n_chars", "n_words", "n_lines"]),
             select.feature_set_table(fx.events_value(spark, d), ["value"]),
             select.feature_set_table(fx.line_num(spark, d), ["l_quantity", "l_tax"])]
    return tidy(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("column_skewness", f"""SELECT "column", round(skewness, 6) AS skewness FROM (
       {_skew_rows('doc_feat', ['n_chars', 'n_words', 'n_lines'])} UNION ALL {_skew_rows('events_value', ['value'])})""",
       using=("doc_feat", "events_value"))
def column_skewness(spark, d):
    return tidy(profile.column_skewness(fx.doc_feat(spark, d), ["n_chars", "n_words", "n_lines"]).unionByName(
        profile.column_skewness(fx.events_value(spark, d), ["value"])))


# --- encoding -------------------------------------------------------------------------------

@query("onehot_fit", """SELECT 'c_mktsegment' AS "column", v AS category, (row_number() OVER (ORDER BY v) - 1)::BIGINT AS position
       FROM (SELECT DISTINCT c_mktsegment AS v FROM cust_feat)
       UNION ALL SELECT 'c_nationkey', v::VARCHAR, (row_number() OVER (ORDER BY v) - 1)::BIGINT
       FROM (SELECT DISTINCT c_nationkey AS v FROM cust_feat)""", using=("cust_feat",))
def onehot_fit(spark, d):
    return encode.category_table(fx.cust_feat(spark, d), ["c_mktsegment", "c_nationkey"])


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _onehot_sql(cats):
    cols = ", ".join(f"CASE WHEN c_mktsegment = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"c_mktsegment_{v}\"" for v in cats[1:])
    return f"SELECT row_id::BIGINT AS row_id, {cols} FROM cust_feat"


@query("onehot_transform", _onehot_sql(SEGMENTS), using=("cust_feat",))
def onehot_transform(spark, d):
    df = fx.cust_feat(spark, d).select("row_id", "c_mktsegment")
    return tidy(encode.OneHot(["c_mktsegment"]).fit(df).transform(df))


@query("onehot_unknown", _onehot_sql([s for s in SEGMENTS if s != "FURNITURE"]), using=("cust_feat",))
def onehot_unknown(spark, d):
    df = fx.cust_feat(spark, d).select("row_id", "c_mktsegment")
    model = encode.OneHot(["c_mktsegment"]).fit(df.filter("c_mktsegment <> 'FURNITURE'"))
    return tidy(model.transform(df))


def _places_sql(table, column, first):
    return (f"SELECT v, CASE WHEN p > 0 THEN p - 1 + {first} END::BIGINT AS place FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS p "
            f"FROM (SELECT DISTINCT {column} AS v FROM {table}))")


@query("one_hot_sparse", f"""SELECT c_custkey::BIGINT AS c_custkey, s.place AS segment_place, n.place AS name_place FROM customer
       JOIN ({_places_sql('customer', 'c_mktsegment', 0)}) s ON s.v = c_mktsegment
       JOIN ({_places_sql('customer', 'c_name', '(SELECT count(DISTINCT c_mktsegment) - 1 FROM customer)')}) n ON n.v = c_name""")
def one_hot_sparse(spark, d):
    df = io.read_table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_name")
    model = sparse.SparseOneHot(["c_mktsegment", "c_name"]).fit(df)
    places = F.transform(sparse.entries("encoded"), lambda e: e["place"])
    split = F.lit(model.state["first"]["c_name"])
    return tidy(model.transform(df).withColumn("p", places).select(
        "c_custkey", F.get(F.filter("p", lambda i: i < split), 0).alias("segment_place"),
        F.get(F.filter("p", lambda i: i >= split), 0).alias("name_place")))


@query("sparse_moments", f"""WITH pri AS ({_places_sql('orders', 'o_orderpriority', 0)}),
       cust AS ({_places_sql('orders', 'o_custkey', '(SELECT count(DISTINCT o_orderpriority) - 1 FROM orders)')}),
       cells AS (SELECT o_orderkey AS k, -2 AS place, 1::BIGINT AS x FROM orders
         UNION ALL SELECT o_orderkey, -1, floor(o_totalprice / 1000)::BIGINT FROM orders
         UNION ALL SELECT o_orderkey, place, 1 FROM orders JOIN pri ON v = o_orderpriority WHERE place IS NOT NULL
         UNION ALL SELECT o_orderkey, place, 1 FROM orders JOIN cust ON v = o_custkey WHERE place IS NOT NULL)
       SELECT a.place::BIGINT AS i, b.place::BIGINT AS j, count(*)::BIGINT AS n, sum(a.x * b.x)::BIGINT AS v
       FROM cells a JOIN cells b ON a.k = b.k AND a.place <= b.place GROUP BY ALL""")
def sparse_moments(spark, d):
    df = io.read_table(spark, d, "orders").select("o_orderpriority", "o_custkey", F.floor(F.col("o_totalprice") / 1000).alias("y"))
    out = sparse.SparseOneHot(["o_orderpriority", "o_custkey"]).fit(df).transform(df)
    return tidy(sparse.sparse_moments(out, "encoded", "y").withColumn("v", F.round("v").cast("bigint")))


_FLAGS = ["l_linenumber", "l_returnflag", "l_linestatus"]
_FLAG_VALUES = [("l_linenumber", n) for n in range(2, 8)] + [("l_returnflag", "N"), ("l_returnflag", "R"), ("l_linestatus", "O")]
_FLAG_NAMES = ["l_quantity", "l_extendedprice"] + [f"{c}_{v}" for c, v in _FLAG_VALUES]


@query("correlated_places", "WITH ind AS (SELECT l_quantity, l_extendedprice, " + ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"{c}_{v}\"" for c, v in _FLAG_VALUES) + " FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(r, 6) AS r FROM (SELECT corr(\"{a}\", \"{b}\") AS r FROM ind) WHERE abs(r) >= 0.15"
    for a, b in combinations(_FLAG_NAMES, 2)))
def correlated_places(spark, d):
    df = io.read_table(spark, d, "lineitem").select("l_quantity", "l_extendedprice", *_FLAGS)
    model = sparse.SparseOneHot(_FLAGS, numerical=["l_quantity", "l_extendedprice"]).fit(df)
    path = io.scratch_dir(spark, "moments")
    sparse.sparse_moments(model.transform(df), "encoded").write.parquet(path)
    pairs = sparse.correlated_places(spark.read.parquet(path), 0.15)
    names = model.names(spark)
    return tidy(pairs.join(names.toDF("i", "a"), "i").join(names.toDF("j", "b"), "j").select("a", "b", "r"))


@query("label_encode", """SELECT l_returnflag, (dense_rank() OVER (ORDER BY l_returnflag) - 1)::BIGINT AS code,
       count(*)::BIGINT AS n FROM line_num GROUP BY l_returnflag""", using=("line_num",))
def label_encode(spark, d):
    return tidy(encode.label_encode(fx.line_num(spark, d), "l_returnflag"))


def _poly_input(spark, d):
    return fx.doc_feat(spark, d).select("row_id", F.col("n_words").alias("a"), F.col("n_lines").alias("b"),
                                        F.col("n_chars").alias("c"))


@query("poly_features", """SELECT row_id::BIGINT AS row_id, 1.0::DOUBLE AS "1", n_words AS a, n_lines AS b, n_words * n_words AS "a^2",
       n_words * n_lines AS "a b", n_lines * n_lines AS "b^2", n_chars AS c FROM doc_feat""", using=("doc_feat",))
def poly_features(spark, d):
    return encode.polynomial_features(_poly_input(spark, d), ["a", "b", "c"], n_dimensions=2, keep=["row_id"])


@query("poly_interactions", """SELECT row_id::BIGINT AS row_id, n_words AS a, n_lines AS b, n_words * n_lines AS "a b",
       n_chars AS c FROM doc_feat""", using=("doc_feat",))
def poly_interactions(spark, d):
    return encode.polynomial_features(_poly_input(spark, d), ["a", "b", "c"], n_dimensions=2, interaction_only=True,
                                      include_bias=False, keep=["row_id"])
