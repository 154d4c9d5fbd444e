"""Experiment runs as tables: store, scan, rank, pivot and compare.

Long form: (run_id, name, set, metric, value, trial).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

import pyarrow as pa
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from tabspark.functions.scalar import ident
from tabspark.operators.fitted import load
from tabspark.operators.metrics import minimised
from tabspark.operators.ordered import ranked
from tabspark.operators.small import small_table

SET_ORDER = ["train", "val", "test"]
RESULT_JSON = "name string, trial bigint, metrics map<string, map<string, double>>"


# --- store --------------------------------------------------------------------------------

def append_runs(runs: DataFrame, path: str) -> None:
    """Append long rows to the run table, partitioned by task."""
    runs.write.mode("append").partitionBy("task").parquet(path)


def nest_metrics(runs: DataFrame) -> DataFrame:
    """One row per run with metrics as {set: {metric: value}}.

    A run holds a handful of metrics, so the collected lists are short.
    """
    per_set = runs.groupBy("run_id", "name", "trial", "set").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m"))
    return per_set.groupBy("run_id", "name", "trial").agg(
        F.map_from_entries(F.collect_list(F.struct("set", "m"))).alias("metrics"))


def write_run_folders(nested: DataFrame, root: str) -> None:
    """One folder with a results file per run."""
    nested.write.mode("append").partitionBy("run_id").json(root)


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def scan_runs(spark: SparkSession, root: str, suffixes: list[str] | None = None,
              contains: list[str] | None = None) -> DataFrame:
    """Results of every run folder, filtered by folder-name suffix or substring."""
    df = (spark.read.schema(RESULT_JSON).option("recursiveFileLookup", True)
          .option("pathGlobFilter", "*.json").json(root))
    folder = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2), "^run_id=", "")
    df = df.select(F.url_decode(folder).alias("run_id"), "name", "trial", "metrics")
    if suffixes:
        df = df.filter(any_of([F.col("run_id").endswith(s) for s in suffixes]))
    if contains:
        df = df.filter(any_of([F.col("run_id").contains(s) for s in contains]))
    return df


def from_folders(spark: SparkSession, root: str, parse: Callable[[str, dict[str, bytes]], list[tuple] | None], schema: str,
                 suffixes: list[str] | None = None, contains: list[str] | None = None, pattern: str = "*") -> DataFrame:
    """(run_id, columns of ``schema``): what a function of the user's own makes of every run folder below ``root``.

    ``parse`` gets a folder's name and its files as {name: bytes} and gives rows, or None for nothing.
    Folders are chosen by the end or a part of their name before a file is opened, and one task has the files of a folder.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    parts = F.split("path", "/")
    files = files.select(F.url_decode(F.regexp_replace(F.element_at(parts, -2), "^run_id=", "")).alias("run_id"), F.element_at(parts, -1).alias("name"), "content")
    if suffixes:
        files = files.filter(any_of([F.col("run_id").endswith(s) for s in suffixes]))
    if contains:
        files = files.filter(any_of([F.col("run_id").contains(s) for s in contains]))
    out = StructType([StructField("run_id", StringType()), *StructType.fromDDL(schema)])
    arrow = to_arrow_schema(out)

    def run(batch: pa.Table) -> pa.Table:
        folder = batch["run_id"][0].as_py()
        rows = parse(folder, dict(zip(batch["name"].to_pylist(), batch["content"].to_pylist()))) or []
        columns = list(zip(*[(folder, *r) for r in rows])) if rows else [[] for _ in arrow]
        return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return files.groupBy("run_id").applyInArrow(run, out)


def unpivot_metrics(nested: DataFrame) -> DataFrame:
    """{set: {metric: value}} to long rows."""
    return (nested.select("run_id", "name", "trial", F.explode("metrics").alias("set", "m"))
            .select("run_id", "name", "set", F.explode("m").alias("metric", "value"), "trial"))


def run_id(name: str) -> str:
    """A new run's folder name: time (UTC), model and a random part, so that two runs never share one."""
    now = datetime.now(timezone.utc)
    return f"run_{now:%Y-%m-%d_%H-%M-%S}_{name}_{uuid.uuid4().hex[:8]}"


def save_search(df: DataFrame, features: list[str], label: str, pipeline: list[tuple[str, str]], grid, root: str, metric: str,
                test: DataFrame | None = None, **options) -> str:
    """Search a pipeline, refit its best trial on every row, and save the run: the new folder.

    It holds ``record`` (JSON: id, time, model, pipeline, grid, best parameters), ``results`` (every
    trial, fold, set and metric), ``scores`` (sets of the best trial) and ``model``.
    """
    from tabspark.operators import grids, pipelines
    from tabspark.operators.search import metrics_by_set, task_of

    spark = df.sparkSession
    grid = grid if isinstance(grid, list) else [grid]
    trials = grids.expand(grid)
    results = pipelines.search(df, features, label, pipeline, trials, **options).persist()
    best, model = pipelines.best_pipeline(df, results, features, label, pipeline, trials, metric, options.get("scorers", ()))
    name = trials[best].get(pipeline[-1][0], pipeline[-1][1])
    folder = f"{root.rstrip('/')}/{run_id(name)}"
    record = {"run_id": folder.rsplit("/", 1)[1], "created": datetime.now(timezone.utc).isoformat(timespec="seconds"), "model": name, "metric": metric,
              "pipeline": pipeline, "grid": grid, "n_trials": len(trials), "best_trial": best, "best_params": trials[best], "features": features, "label": label}
    tagged = df.withColumn("__set", F.lit("train"))
    if test is not None:
        tagged = tagged.unionByName(test.withColumn("__set", F.lit("test")), allowMissingColumns=True)
    scores = metrics_by_set(model.transform(tagged), label, "__set", task_of(name))
    scores += [(r["set"], r["metric"], r["v"]) for r in results.filter((F.col("trial") == best) & (F.col("set") == "val")).groupBy("set", "metric").agg(
        F.avg("value").alias("v")).collect()]
    small_table(spark, [(json.dumps(record, default=str),)], "record string").write.parquet(f"{folder}/record")
    results.write.parquet(f"{folder}/results")
    small_table(spark, [(record["run_id"], name, s, m, float(v), best) for s, m, v in scores],
                "run_id string, name string, set string, metric string, value double, trial bigint").write.parquet(f"{folder}/scores")
    model.write().save(f"{folder}/model")
    results.unpersist()
    return folder


def load_search(spark: SparkSession, folder: str) -> tuple[dict, DataFrame, Model]:
    """(record, results, model) of a run that :func:`save_search` saved."""
    record = json.loads(spark.read.parquet(f"{folder}/record").first()[0])
    return record, spark.read.parquet(f"{folder}/results"), load_run_model(folder)


def save_run(model: Model | None, runs: DataFrame, folder: str, tables: dict[str, DataFrame] | None = None) -> None:
    """A run folder: metrics, the fitted pipeline and any named tables."""
    runs.write.mode("overwrite").parquet(f"{folder}/runs")
    if model is not None:
        model.write().overwrite().save(f"{folder}/model")
    for name, t in (tables or {}).items():
        t.write.mode("overwrite").parquet(f"{folder}/{name}")


def load_run_model(folder: str) -> Model:
    """The model of a run, of whatever class it is."""
    return load(f"{folder}/model")


def load_from_run(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


# --- ranking ----------------------------------------------------------------------------------

def score_key(metric: str) -> Column:
    """Ascending sort key of a metric: errors as they are, scores negated."""
    return F.col("value") if minimised(metric) else -F.col("value")


def nth_best_run(runs: DataFrame, metric: str, rank: int = 1, on: str = "val") -> DataFrame:
    """The run with the nth best value of a metric on one set; ties by run id.

    ``limit`` after a sort keeps ``rank`` rows per task, so no task sorts the
    whole table.
    """
    best = (runs.filter((F.col("set") == on) & (F.col("metric") == metric))
            .withColumn("__key", score_key(metric)).orderBy("__key", "run_id").limit(rank))
    w = Window.partitionBy(F.lit(0)).orderBy("__key", "run_id")
    return (best.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") == rank)
            .select("metric", "rank", "run_id", "value"))


def parse_cv_results(runs: DataFrame, best_metric: str, on: str = "val") -> DataFrame:
    """Metrics of the best trial by set; errors as magnitudes, scores with their sign."""
    best = nth_best_run(runs, best_metric, 1, on).select("run_id")
    out = runs.join(F.broadcast(best), "run_id", "left_semi")
    flip = F.col("metric").startswith("neg_") | F.col("metric").isin("RMSE", "MAE", "RMedSE", "MedAE", "MSE")
    return out.select("set", "metric", F.when(flip, F.abs("value")).otherwise(F.col("value")).alias("value"))


def cv_results_wide(parsed: DataFrame) -> DataFrame:
    """(set, metric) rows with one column per target scale."""
    prefix = "orig_scale_"
    orig = F.col("metric").startswith(prefix)
    return (parsed.withColumn("scale", F.when(orig, "original").otherwise("scaled"))
            .withColumn("metric", F.regexp_replace("metric", f"^{prefix}", ""))
            .groupBy("set", "metric").pivot("scale", ["original", "scaled"]).agg(F.first("value")))


def cv_results_compare(runs: DataFrame, metrics: list[str], label: str = "name",
                       order: list[str] = SET_ORDER) -> DataFrame:
    """Per set one text column per metric: 'value (label)' lines, in label order."""
    cell = F.format_string("%.4f (%s)", F.col("value"), F.col(label))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(label).alias("l"), cell.alias("t")))),
                                    lambda s: s["t"]), "\n")
    wide = runs.filter(F.col("metric").isin(metrics)).groupBy("set").pivot("metric", metrics).agg(text)
    return sort_custom_order(wide, "set", order)


# --- ordering and codes ---------------------------------------------------------------------------

def sort_custom_order(df: DataFrame, column: str, order: list[str], out: str = "pos") -> DataFrame:
    """Rows by a custom value order with an explicit position; unlisted values are an error."""
    lits = F.array(*[F.lit(v) for v in order])
    pos = F.array_position(lits, F.col(ident(column))).cast("bigint")
    checked = F.when(pos > 0, pos).otherwise(
        F.raise_error(F.concat(F.lit("value outside the order: "), F.col(ident(column)))).cast("bigint"))
    return df.withColumn(out, checked).orderBy(out)


def sort_groups_by(df: DataFrame, group: str, set_column: str, score: str, on: str = "val",
                   descending: bool = True, order: list[str] = SET_ORDER) -> DataFrame:
    """Rows ordered by their group's score on one set, each group's rows kept together.

    The group score is a pre-aggregate joined back, so a large group is not
    gathered in one task.
    """
    scores = df.groupBy(ident(group)).agg(F.max(F.when(F.col(set_column) == on, F.col(score))).alias("__g"))
    key = F.col("__g").desc_nulls_last() if descending else F.col("__g").asc_nulls_last()
    lits = F.array(*[F.lit(v) for v in order])
    out = df.join(scores, group).withColumn("group_score", F.col("__g"))
    return out.orderBy(key, F.col(ident(group)), F.array_position(lits, F.col(set_column))).drop("__g")


def run_codes(runs: DataFrame, prefix: str = "E", by: str = "run_id", order: str = "trial",
              rows_per_block: int | None = None) -> DataFrame:
    """Short codes E1, E2... in first-seen order, with the name taken from the id's suffix."""
    first = runs.groupBy(ident(by)).agg(F.min(ident(order)).alias("__o"))
    r = ranked(first, "__i", "__o", tie_break=[by], rows_per_block=rows_per_block)
    return r.select(F.concat(F.lit(prefix), F.col("__i")).alias("code"), ident(by),
                    F.element_at(F.split(F.col(ident(by)), "_"), -1).alias("name"))


def rename_by_suffix(runs: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Run names by the first matching id suffix; unmatched names stay."""
    expr = None
    for suffix, name in mapping.items():
        cond = F.col("run_id").endswith(suffix)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return runs.withColumn("name", expr.otherwise(F.col("name")) if expr is not None else F.col("name"))


# --- pivots and unions ----------------------------------------------------------------------------

def pivot_outer(df: DataFrame, outer: str, row: str, inner: list[str] | None = None,
                exclude: list[str] = (), outer_values: list | None = None, sort_by: str | None = None,
                sort_row=None, ascending: bool = True, max_columns: int = 1_000) -> DataFrame:
    """Rows by ``row``, columns by ``outer`` (and ``inner`` when there is more than one).

    Column order follows the inner value in one row when ``sort_by`` is given.
    """
    inner = [c for c in (inner or [c for c in df.columns if c not in (outer, row)]) if c not in exclude]
    if sort_by is not None and sort_by not in inner:
        raise ValueError(f"sort_by column {sort_by!r} is not a pivoted column")
    if outer_values is None:
        found = df.select(ident(outer)).distinct().limit(max_columns + 1).collect()
        if len(found) > max_columns:
            raise ValueError(f"{outer} has over {max_columns} values")
        outer_values = sorted(r[0] for r in found)
    if sort_by is not None:
        if sort_row is None:
            sort_row = df.agg(F.min(ident(row))).first()[0]
        keys = {r[0]: r[1] for r in df.filter(F.col(ident(row)) == F.lit(sort_row)).groupBy(ident(outer))
                .agg(F.first(ident(sort_by))).collect()}
        if not keys:
            raise ValueError(f"sort_row {sort_row!r} not found")
        outer_values = sorted(outer_values, key=lambda v: (v not in keys, keys.get(v, 0) if ascending else -keys.get(v, 0)))
    aggs = [F.first(ident(c)).alias(c) for c in inner]
    return df.groupBy(ident(row)).pivot(outer, outer_values).agg(*aggs)


def union_with_origin(tables: list[DataFrame], labels: list[str] | None = None, column: str = "Table_Origin",
                      fill: str = "") -> DataFrame:
    """Tables stacked with their label; missing columns become the fill text."""
    labels = labels or [f"table_{i + 1}" for i in range(len(tables))]
    if len(labels) != len(tables):
        raise ValueError("one label per table is needed")
    names = list(dict.fromkeys(c for t in tables for c in t.columns))
    out = None
    for t, lab in zip(tables, labels):
        part = t.select(F.lit(lab).alias(column), *[
            F.coalesce(F.col(ident(c)).cast("string"), F.lit(fill)).alias(c) if c in t.columns
            else F.lit(fill).alias(c) for c in names])
        out = part if out is None else out.unionByName(part)
    return out


def metric_series(runs: DataFrame, metrics: list[str], sets: list[str] = SET_ORDER) -> DataFrame:
    """(axis, set, x, y) series behind a metric comparison."""
    return runs.filter(F.col("metric").isin(metrics) & F.col("set").isin(sets)).select(
        F.initcap("metric").alias("axis"), "set", F.col("name").alias("x"), F.col("value").alias("y"))


def scatter_sample(df: DataFrame, group: str, columns: list[str], budget: int = 10_000, seed: int = 42,
                   key: str = "row_id") -> DataFrame:
    """Points per group, large groups first, thinned by a seeded hash to a point budget.

    Sampling is the feature: a scatter plot has a point budget.
    """
    from tabspark.functions.scalar import HASH_RANGE, hash32

    if not 1 <= len(columns) <= 3:
        raise ValueError("a scatter needs one to three columns")
    counts = df.groupBy(ident(group)).agg(F.count(F.lit(1)).alias("group_size"))
    n = counts.agg(F.sum("group_size")).first()[0]
    keep = hash32(F.col(ident(key)), f"scatter{seed}") < F.lit(int(min(1.0, budget / n) * HASH_RANGE))
    picked = df if n <= budget else df.filter(keep)
    return picked.join(counts, group).select(F.col(ident(group)).alias("group"), "group_size",
                                             *map(ident, columns)).orderBy(F.col("group_size").desc(), "group")
