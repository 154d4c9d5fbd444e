"""Derived input tables, with the same definition as SQL text beside each.

``SQL`` holds DuckDB common table expressions over the raw tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabspark.sources.io import read_table


def line_num(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_returnflag", "l_linestatus")


def line_missing(spark: SparkSession, d: str) -> DataFrame:
    """line_num with l_tax missing on line 3."""
    return line_num(spark, d).withColumn("l_tax", F.when(F.col("l_linenumber") != 3, F.col("l_tax")))


def doc_feat(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select(
        F.col("doc_id").alias("row_id"), "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
        # Both separators are one byte, and byte lengths need no scan of the text.
        F.expr("cast(octet_length(text) - octet_length(replace(text, ' ', '')) + 1 as double)").alias("n_words"),
        F.expr(r"cast(octet_length(text) - octet_length(replace(text, '\n', '')) + 1 as double)").alias("n_lines"))
    labels = read_table(spark, d, "labels").withColumnRenamed("doc_id", "row_id")
    return docs.join(labels, "row_id", "left")


def events_value(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events").select(F.col("event_id").alias("row_id"), "user_id", "value")


def events_missing(spark: SparkSession, d: str) -> DataFrame:
    """events with value missing on every seventh event."""
    return events_value(spark, d).withColumn("value", F.when(F.col("row_id") % 7 != 0, F.col("value")))


def user_day(spark: SparkSession, d: str) -> DataFrame:
    """One row per user and day; the target is the purchase value, mostly zero."""
    e = read_table(spark, d, "events").select(
        "user_id", "ts", "event_type", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    kind = lambda t: F.count_if(F.col("event_type") == t).cast("double")
    return (e.withColumn("row_id", (F.col("user_id") * 1000 + day).cast("bigint")).groupBy("row_id").agg(
        F.count(F.lit(1)).cast("double").alias("n_events"), kind("click").alias("n_click"),
        kind("view").alias("n_view"), kind("error").alias("n_error"), F.avg("k").alias("k_mean"),
        F.max(F.hour("ts")).cast("double").alias("last_hour"),
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0)).alias("y")))


USER_DAY_FEATURES = ["n_events", "n_click", "n_view", "n_error", "k_mean", "last_hour"]


def cust_feat(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("row_id"), "c_mktsegment", "c_nationkey", "c_acctbal")
    o = read_table(spark, d, "orders").groupBy(F.col("o_custkey").alias("row_id")).agg(
        F.sum("o_totalprice").alias("spend"), F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_final"))
    return c.join(o, "row_id", "left").fillna({"spend": 0.0, "n_orders": 0, "n_final": 0})


def embeddings(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("x"), "label")


EMBED_DIM = 64
EMBED_COLUMNS = [f"e{i}" for i in range(EMBED_DIM)]


def embed_wide(spark: SparkSession, d: str) -> DataFrame:
    # Elements are cast one by one: casting the whole array first would be
    # repeated for every element once the projections are merged.
    return read_table(spark, d, "embeddings").select(
        F.col("vec_id").alias("row_id"), "label",
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(EMBED_COLUMNS)])


def scored(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "labels").select(
        F.col("doc_id").alias("row_id"), F.col("quality").alias("y"),
        (F.pmod(F.col("doc_id") * 7919, F.lit(1000)) / 1000.0).alias("score"))


def runs(spark: SparkSession, d: str) -> DataFrame:
    """Each supplier's lines scored with one price rule, as runs with three sets.

    Run ids end in the supplier's region; returned, open and other lines are the
    train, val and test sets.
    """
    li = read_table(spark, d, "lineitem").select(
        "l_suppkey", "l_returnflag", (F.col("l_extendedprice") - F.col("l_quantity") * 1500.0).alias("e"))
    s = (read_table(spark, d, "supplier").join(read_table(spark, d, "nation"),
                                               F.col("s_nationkey") == F.col("n_nationkey"))
         .join(read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
         .select("s_suppkey", "r_name"))
    agg = li.groupBy("l_suppkey", "l_returnflag").agg(
        F.round(F.sqrt(F.avg(F.col("e") * F.col("e"))), 4).alias("RMSE"),
        F.round(F.avg(F.abs("e")), 4).alias("MAE"))
    sets = (F.when(F.col("l_returnflag") == "A", "train").when(F.col("l_returnflag") == "N", "val")
            .otherwise("test"))
    wide = agg.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.lit("run_"), F.lpad(F.col("l_suppkey").cast("string"), 8, "0"), F.lit("_"),
                 F.replace("r_name", F.lit(" "), F.lit("-"))).alias("run_id"),
        F.col("r_name").alias("name"), sets.alias("set"), F.col("l_suppkey").cast("bigint").alias("trial"),
        "RMSE", "MAE")
    return wide.unpivot(["run_id", "name", "set", "trial"], ["RMSE", "MAE"], "metric", "value")


def region_runs(spark: SparkSession, d: str) -> DataFrame:
    """The same scores averaged over a region's suppliers: one model per region."""
    return (runs(spark, d).groupBy("name", "set", "metric").agg(
        F.round(F.avg("value"), 3).alias("value"), F.min("trial").alias("trial"))
        .withColumn("run_id", F.concat(F.lit("run_"), F.col("name"))))


SQL = {
    "line_num": "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber, l_returnflag, l_linestatus FROM lineitem",
    "line_missing": "SELECT l_quantity, l_extendedprice, l_discount, CASE WHEN l_linenumber <> 3 THEN l_tax END AS l_tax, l_linenumber, l_returnflag, l_linestatus FROM lineitem",
    "doc_feat": """SELECT d.doc_id AS row_id, d.lang, d.source, d.n_chars::DOUBLE AS n_chars,
        (length(d.text) - length(replace(d.text, ' ', '')) + 1)::DOUBLE AS n_words,
        (length(d.text) - length(replace(d.text, chr(10), '')) + 1)::DOUBLE AS n_lines,
        l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "events_value": "SELECT event_id AS row_id, user_id, value FROM events",
    "events_missing": "SELECT event_id AS row_id, user_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events",
    "user_day": """SELECT user_id * 1000 + date_diff('day', DATE '2024-01-01', ts::DATE) AS row_id,
        count(*)::DOUBLE AS n_events, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::DOUBLE AS n_click,
        sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::DOUBLE AS n_view,
        sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::DOUBLE AS n_error,
        avg(json_extract_string(props, '$.k')::DOUBLE) AS k_mean, max(hour(ts))::DOUBLE AS last_hour,
        sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS y FROM events GROUP BY 1""",
    "cust_feat": """SELECT c.c_custkey AS row_id, c.c_mktsegment, c.c_nationkey, c.c_acctbal,
        coalesce(o.spend, 0.0) AS spend, coalesce(o.n_orders, 0)::BIGINT AS n_orders,
        coalesce(o.n_final, 0)::BIGINT AS n_final
        FROM customer c LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS spend, count(*) AS n_orders,
          sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_final FROM orders GROUP BY 1) o
        ON o.o_custkey = c.c_custkey""",
    "emb_long": """SELECT vec_id AS row_id, label, unnest(range(64)) AS pos, unnest(embedding)::DOUBLE AS val FROM embeddings""",
    "scored": "SELECT doc_id AS row_id, quality AS y, ((doc_id * 7919) % 1000) / 1000.0::DOUBLE AS score FROM labels",
    "run_wide": """SELECT 'run_' || lpad(l_suppkey::VARCHAR, 8, '0') || '_' || replace(any_value(r_name), ' ', '-') AS run_id,
        any_value(r_name) AS name,
        CASE l_returnflag WHEN 'A' THEN 'train' WHEN 'N' THEN 'val' ELSE 'test' END AS set,
        l_suppkey::BIGINT AS trial,
        round(sqrt(avg((l_extendedprice - l_quantity * 1500.0) * (l_extendedprice - l_quantity * 1500.0))), 4) AS RMSE,
        round(avg(abs(l_extendedprice - l_quantity * 1500.0)), 4) AS MAE
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY l_suppkey, l_returnflag""",
    "runs": """SELECT run_id, name, set, 'RMSE' AS metric, RMSE AS value, trial FROM run_wide
        UNION ALL SELECT run_id, name, set, 'MAE', MAE, trial FROM run_wide""",
    "region_runs": """SELECT name, set, metric, round(avg(value), 3) AS value, min(trial) AS trial,
        'run_' || name AS run_id FROM runs GROUP BY name, set, metric""",
}
# Common table expressions that build on another one.
NEEDS = {"runs": ("run_wide",), "region_runs": ("run_wide", "runs")}


def with_fixtures(names: tuple[str, ...], body: str, extra: str = "") -> str:
    """SQL text with the named fixtures as common table expressions."""
    order: list[str] = []
    for n in names:
        for m in (*NEEDS.get(n, ()), n):
            if m not in order:
                order.append(m)
    ctes = [f"{n} AS ({SQL[n]})" for n in order] + ([extra] if extra else [])
    return f"WITH {', '.join(ctes)} {body}"
