"""ROC, precision-recall and threshold curves.

Rows are first reduced to distinct scores (or threshold bins), so the cumulative
step never sees raw rows and a popular score is a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabspark.functions.scalar import bound_index, dbl, ident
from tabspark.operators.metrics import f1_macro_from
from tabspark.operators.ordered import running_sum


def cumulative_counts(df: DataFrame, y: str, score: str, rows_per_block: int | None = None) -> DataFrame:
    """(threshold, tp, fp, p, n) per distinct score, counting scores >= threshold."""
    pos = dbl(y) == 1
    per = df.groupBy(dbl(score).alias("threshold")).agg(
        F.count_if(pos).alias("dp"), F.count_if(~pos).alias("dn"))
    p, n = df.agg(F.count_if(pos), F.count_if(~pos)).first()
    cum = running_sum(per, {"tp": F.col("dp"), "fp": F.col("dn")}, "threshold", descending=True,
                      rows_per_block=rows_per_block)
    # literals as long: products of two counts pass 32 bits
    return cum.select("threshold", "tp", "fp", "dp", "dn", *[F.lit(v).cast("bigint").alias(c) for c, v in (("p", p), ("n", n))])


def roc_points(df: DataFrame, y: str, score: str, rows_per_block: int | None = None) -> DataFrame:
    """One point per distinct score, without the (0, 0) start."""
    c = cumulative_counts(df, y, score, rows_per_block)
    return c.select("threshold", F.try_divide("fp", "n").alias("fpr"), F.try_divide("tp", "p").alias("tpr"))


def pr_points(df: DataFrame, y: str, score: str, rows_per_block: int | None = None) -> DataFrame:
    c = cumulative_counts(df, y, score, rows_per_block)
    return c.select("threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    F.try_divide("tp", "p").alias("recall"))


def auc_roc(df: DataFrame, y: str, score: str, rows_per_block: int | None = None) -> DataFrame:
    """Trapezoid area; each score adds its negatives times the mean height before and after."""
    c = cumulative_counts(df, y, score, rows_per_block)
    return c.agg((F.sum(F.col("dn") * (F.col("tp") - F.col("dp") / 2.0))
                  / (F.first("p").cast("double") * F.first("n"))).alias("value"))


def average_precision(df: DataFrame, y: str, score: str, rows_per_block: int | None = None) -> DataFrame:
    c = cumulative_counts(df, y, score, rows_per_block)
    return c.agg((F.sum(F.col("dp").cast("double") * F.col("tp") / (F.col("tp") + F.col("fp"))) / F.first("p")).alias("value"))


def chance_level(df: DataFrame, y: str) -> DataFrame:
    return df.agg(F.avg((dbl(y) == 1).cast("double")).alias("value"))


def cutoff_point(df: DataFrame, y: str, score: str, threshold: float) -> DataFrame:
    """(fpr, tpr, precision, recall) of one decision threshold."""
    pos, hit = dbl(y) == 1, dbl(score) >= threshold
    c = df.agg(F.count_if(pos & hit).alias("tp"), F.count_if(~pos & hit).alias("fp"),
               F.count_if(pos).alias("p"), F.count_if(~pos).alias("n"))
    return c.select(F.try_divide("fp", "n").alias("fpr"), F.try_divide("tp", "p").alias("tpr"),
                    F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
                    F.try_divide("tp", "p").alias("recall"))


def closest_roc_point(df: DataFrame, y: str, score: str, recall: float) -> DataFrame:
    """ROC point nearest to (1 - recall, recall), the (0, 0) start included.

    Ties go to the higher threshold, that is the lower point of the curve.
    """
    pts = roc_points(df, y, score).withColumn("d2", F.round(
        F.pow(F.col("fpr") - (1 - recall), 2) + F.pow(F.col("tpr") - recall, 2), 12))
    start = round((1 - recall) ** 2 + recall ** 2, 12)
    best = F.min_by(F.struct("fpr", "tpr", "d2"), F.struct(F.col("d2"), -F.col("threshold")))
    return pts.agg(best.alias("b")).select(
        F.when(F.col("b.d2") < start, F.col("b.fpr")).otherwise(0.0).alias("fpr"),
        F.when(F.col("b.d2") < start, F.col("b.tpr")).otherwise(0.0).alias("tpr"))


# --- decision-threshold tuning ----------------------------------------------------------------

def threshold_curve(df: DataFrame, y: str, score: str, fold: str, thresholds: list[float],
                    objective=f1_macro_from) -> DataFrame:
    """Mean over folds of an objective at every threshold (prediction = score >= threshold).

    A row belongs to the bin of the thresholds it passes; counts at a threshold
    are sums of the bins above it, so no row is repeated per threshold.
    """
    ts = sorted(thresholds)
    pos = dbl(y) == 1
    bins = df.groupBy(F.col(ident(fold)).alias("f"), bound_index(dbl(score), ts).alias("b")).agg(
        F.count_if(pos).alias("dp"), F.count_if(~pos).alias("dn"))
    # Every fold carries all bins, so that empty ones still give a threshold row.
    grid = bins.groupBy("f").agg(F.map_from_entries(F.collect_list(
        F.struct("b", F.struct("dp", "dn")))).alias("m"))
    full = grid.select("f", F.explode(F.sequence(F.lit(0), F.lit(len(ts)))).alias("b"), "m").select(
        "f", "b", F.coalesce(F.try_element_at("m", F.col("b"))["dp"], F.lit(0)).alias("dp"),
        F.coalesce(F.try_element_at("m", F.col("b"))["dn"], F.lit(0)).alias("dn"))
    up = Window.partitionBy("f").orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    allw = Window.partitionBy("f")
    c = full.select("f", "b", F.sum("dp").over(up).alias("tp"), F.sum("dn").over(up).alias("fp"),
                    F.sum("dp").over(allw).alias("p"), F.sum("dn").over(allw).alias("n")).filter("b > 0")
    value = objective(F.col("tp"), F.col("fp"), F.col("p") - F.col("tp"), F.col("n") - F.col("fp"))
    lits = F.array(*[F.lit(float(t)) for t in ts])
    return c.groupBy("b").agg(F.avg(value).alias("score")).select(
        F.get(lits, F.col("b") - 1).alias("threshold"), "score")


def best_threshold(curve: DataFrame) -> DataFrame:
    """The lowest threshold with the highest mean score."""
    key = F.struct(F.round("score", 12).alias("s"), (-F.col("threshold")).alias("t"))
    return curve.agg(F.max_by(F.struct("threshold", "score"), key).alias("b")).select("b.threshold", "b.score")


def threshold_grid(n: int = 100, lo: float = 0.0, hi: float = 1.0) -> list[float]:
    return [lo + (hi - lo) * i / (n - 1) for i in range(n)]
