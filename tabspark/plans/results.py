"""Run-store, ranking, pivot and union queries over runs derived from the order lines."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tabspark.functions.scalar import map_invert, map_key_with_suffix, map_rename_keys
from tabspark.operators import split
from tabspark.plans.registry import ORACLE, query, tidy
from tabspark.sources import fixtures as fx, io, runs as rs

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
METRICS = ["RMSE", "MAE"]


# --- store --------------------------------------------------------------------------------

@query("runs_scan", """SELECT run_id, name, set, metric, value, trial FROM runs
       WHERE (run_id LIKE '%\\_ASIA' ESCAPE '\\' OR run_id LIKE '%\\_EUROPE' ESCAPE '\\') AND run_id LIKE '%run\\_0%' ESCAPE '\\'""", using=("runs",))
def runs_scan(spark, d):
    root = io.scratch_dir(spark, "runs")
    rs.write_run_folders(rs.nest_metrics(fx.runs(spark, d)), root)
    found = rs.scan_runs(spark, root, suffixes=["_ASIA", "_EUROPE"], contains=["run_0"])
    return tidy(rs.unpivot_metrics(found), exact=("value",))


def _results(folder, files):
    """Rows of the results files of one run folder."""
    return [(r["name"], side, metric, value, r["trial"]) for data in files.values() for r in map(json.loads, data.decode().splitlines())
            for side, values in r["metrics"].items() for metric, value in values.items()]


@query("runs_scan_own_parser", ORACLE["runs_scan"])
def runs_scan_own_parser(spark, d):
    """The scan of run folders by a function of one's own."""
    root = io.scratch_dir(spark, "runs")
    rs.write_run_folders(rs.nest_metrics(fx.runs(spark, d)), root)
    found = rs.from_folders(spark, root, _results, "name string, set string, metric string, value double, trial bigint",
                            ["_ASIA", "_EUROPE"], ["run_0"], "*.json")
    return tidy(found, exact=("value",))


@query("runs_append", """SELECT task, set, metric, count(*)::BIGINT AS n, round(sum(value), 2) AS total FROM (
       SELECT *, 'regression' AS task FROM runs UNION ALL SELECT *, 'second' FROM runs) GROUP BY ALL""", using=("runs",))
def runs_append(spark, d):
    path = io.scratch_dir(spark, "store")
    df = fx.runs(spark, d)
    for task in ("regression", "second"):
        rs.append_runs(df.withColumn("task", F.lit(task)), path)
    back = io.load_table(spark, path, missing="error")
    return tidy(back.groupBy("task", "set", "metric").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), digits=2)


@query("predictions_sink", """SELECT row_id::BIGINT AS row_id, 20 * n_events AS prediction FROM user_day""", using=("user_day",))
def predictions_sink(spark, d):
    root = io.scratch_dir(spark, "predictions")
    df = split.hash_split(fx.user_day(spark, d)).withColumn("prediction", F.col("n_events") * 20.0)
    path = io.write_predictions(df, root, "team", "test", "regression")
    return tidy(spark.read.parquet(path), exact=("prediction",))


# --- ranking and reshaping -----------------------------------------------------------------------

@query("nth_best_run", " UNION ALL ".join(f"""SELECT * FROM (SELECT metric, row_number() OVER (ORDER BY value, run_id)::BIGINT AS rank, run_id, value
       FROM runs WHERE set = 'val' AND metric = '{m}') WHERE rank = {k}""" for m, k in (("RMSE", 1), ("RMSE", 3), ("MAE", 2))), using=("runs",))
def nth_best_run(spark, d):
    df = fx.runs(spark, d)
    parts = [rs.nth_best_run(df, m, k) for m, k in (("RMSE", 1), ("RMSE", 3), ("MAE", 2))]
    return tidy(parts[0].unionByName(parts[1]).unionByName(parts[2]), exact=("value",))


@query("parse_cv_results", """SELECT set, metric, abs(value) AS value FROM runs WHERE run_id =
       (SELECT run_id FROM runs WHERE set = 'val' AND metric = 'RMSE' ORDER BY value, run_id LIMIT 1)""", using=("runs",))
def parse_cv_results(spark, d):
    return tidy(rs.parse_cv_results(fx.runs(spark, d), "RMSE"), exact=("value",))


@query("cv_results_wide", """SELECT set, name, metric, max(value) FILTER (o) AS original, max(value) FILTER (NOT o) AS scaled FROM (
       SELECT name, set, metric, value, false AS o FROM region_runs UNION ALL SELECT name, set, metric, round(value * 2, 3), true FROM region_runs)
       GROUP BY set, name, metric""", using=("region_runs",))
def cv_results_wide(spark, d):
    """Both target scales as columns, per model."""
    df = fx.region_runs(spark, d)
    both = df.unionByName(df.withColumns({"metric": F.concat(F.lit("orig_scale_"), "metric"), "value": F.round(F.col("value") * 2, 3)}))
    out = rs.cv_results_wide(both.withColumn("set", F.concat_ws("\x1f", "set", "name")).select("set", "metric", "value"))
    parts = F.split("set", "\x1f")
    return tidy(out.withColumns({"name": F.get(parts, F.lit(1)), "set": F.get(parts, F.lit(0))}), digits=3)


@query("cv_results_compare", """SELECT set, list_position(['train', 'val', 'test'], set)::BIGINT AS pos,
       string_agg(printf('%.4f', value) || ' (' || name || ')', chr(10) ORDER BY name) FILTER (metric = 'RMSE') AS RMSE,
       string_agg(printf('%.4f', value) || ' (' || name || ')', chr(10) ORDER BY name) FILTER (metric = 'MAE') AS MAE
       FROM region_runs GROUP BY set""", using=("region_runs",))
def cv_results_compare(spark, d):
    return tidy(rs.cv_results_compare(fx.region_runs(spark, d), METRICS))


@query("runs_unpivot", """SELECT name AS model, set, max(value) FILTER (metric = 'RMSE') AS RMSE, max(value) FILTER (metric = 'MAE') AS MAE
       FROM region_runs GROUP BY name, set""", using=("region_runs",))
def runs_unpivot(spark, d):
    long = rs.unpivot_metrics(rs.nest_metrics(fx.region_runs(spark, d)))
    return tidy(long.groupBy(F.col("name").alias("model"), "set").pivot("metric", METRICS).agg(F.first("value")), digits=3)


@query("metric_series", """SELECT CASE metric WHEN 'RMSE' THEN 'Rmse' ELSE 'Mae' END AS axis, set, name AS x, value AS y FROM runs""", using=("runs",))
def metric_series(spark, d):
    return tidy(rs.metric_series(fx.runs(spark, d), METRICS), exact=("y",))


@query("run_codes", """SELECT 'E' || row_number() OVER (ORDER BY trial, run_id) AS code, run_id, split_part(run_id, '_', 3) AS name
       FROM (SELECT run_id, min(trial) AS trial FROM runs GROUP BY run_id)""", using=("runs",))
def run_codes(spark, d):
    return rs.run_codes(fx.runs(spark, d))


_PIVOT = ", ".join(f"max(value) FILTER (metric = 'RMSE' AND name = '{r}') AS \"{r}\"" for r in REGIONS)


@query("pivot_single", f"SELECT set, {_PIVOT} FROM region_runs GROUP BY set", using=("region_runs",))
def pivot_single(spark, d):
    df = fx.region_runs(spark, d).filter("metric = 'RMSE'").select("name", "set", "value")
    return tidy(rs.pivot_outer(df, "name", "set", sort_by="value", sort_row="val"), digits=3)


@query("pivot_multi", "SELECT set, " + ", ".join(f"max(value) FILTER (metric = '{m}' AND name = '{r}') AS \"{r}_{m}\"" for r in REGIONS for m in METRICS)
       + " FROM region_runs GROUP BY set", using=("region_runs",))
def pivot_multi(spark, d):
    wide = (fx.region_runs(spark, d).groupBy("name", "set").pivot("metric", METRICS).agg(F.first("value")))
    return tidy(rs.pivot_outer(wide, "name", "set", inner=METRICS), digits=3)


@query("union_with_origin", """SELECT 'Numerical' AS Type, set, name, printf('%.3f', value) AS value, '' AS trial FROM region_runs WHERE metric = 'RMSE'
       UNION ALL SELECT 'Categorical', set, '', printf('%.3f', value), trial::VARCHAR FROM region_runs WHERE metric = 'MAE'""", using=("region_runs",))
def union_with_origin(spark, d):
    df = fx.region_runs(spark, d)
    value = F.format_string("%.3f", "value").alias("value")
    a = df.filter("metric = 'RMSE'").select("set", "name", value)
    b = df.filter("metric = 'MAE'").select("set", value, "trial")
    return rs.union_with_origin([a, b], ["Numerical", "Categorical"], column="Type")


@query("sort_custom_order", """SELECT set, count(*)::BIGINT AS n, list_position(['train', 'val', 'test'], set)::BIGINT AS pos FROM runs GROUP BY set""",
       using=("runs",))
def sort_custom_order(spark, d):
    return rs.sort_custom_order(fx.runs(spark, d).groupBy("set").agg(F.count(F.lit(1)).alias("n")), "set", rs.SET_ORDER)


@query("sort_groups_by_val", """SELECT name, set, value, max(value) FILTER (set = 'val') OVER (PARTITION BY name) AS group_score
       FROM region_runs WHERE metric = 'RMSE'""", using=("region_runs",))
def sort_groups_by_val(spark, d):
    df = fx.region_runs(spark, d).filter("metric = 'RMSE'").select("name", "set", "value")
    return tidy(rs.sort_groups_by(df, "name", "set", "value"), digits=3)


@query("set_ops", """SELECT 'both' AS part, count(*)::BIGINT AS n FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders)
       UNION ALL SELECT 'only_customer', count(*)::BIGINT FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)""")
def set_ops(spark, d):
    c = io.read_table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    o = io.read_table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    tag = lambda df, part: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("part"), "n")
    return tag(c.intersect(o), "both").unionByName(tag(c.subtract(o), "only_customer"))


@query("map_functions", """SELECT row_id::BIGINT AS row_id, 'n_click' AS first_click, (n_click + n_view)::DOUBLE AS click_and_view,
       CASE WHEN n_click = n_view THEN NULL WHEN greatest(n_click, n_view) = n_view THEN 'views' ELSE 'n_click' END AS larger FROM user_day""",
       using=("user_day",))
def map_functions(spark, d):
    """Suffix lookup, key renaming and inversion on a per-row map."""
    m = F.create_map(F.lit("n_click"), F.col("n_click"), F.lit("n_view"), F.col("n_view"))
    renamed = map_rename_keys(m, {"n_view": "views"})
    larger = F.when(F.col("n_click") != F.col("n_view"),
                    F.element_at(map_invert(renamed), F.greatest("n_click", "n_view")))
    return fx.user_day(spark, d).select(
        "row_id", map_key_with_suffix(m, "click").alias("first_click"),
        (F.element_at(renamed, "n_click") + F.element_at(renamed, "views")).alias("click_and_view"),
        larger.alias("larger"))


@query("scatter_sample", """SELECT CASE WHEN y > 0 THEN 'purchase' ELSE 'none' END AS "group",
       count(*) OVER (PARTITION BY y > 0)::BIGINT AS group_size, round(n_events, 6) AS n_events, round(k_mean, 6) AS k_mean
       FROM user_day, (SELECT count(*) AS n FROM user_day)
       QUALIFY n <= 2000 OR ('0x' || substr(md5('scatter42:' || row_id), 1, 8))::BIGINT < floor(2000.0::DOUBLE / n * 4294967296)""",
       using=("user_day",))
def scatter_sample(spark, d):
    df = fx.user_day(spark, d).withColumn("group", F.when(F.col("y") > 0, "purchase").otherwise("none"))
    return tidy(rs.scatter_sample(df.select("row_id", "group", "n_events", "k_mean"), "group", ["n_events", "k_mean"], budget=2_000))
