"""Regression and classification metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.scalar import dbl, ident
from tabspark.operators.quantiles import LIMIT, medians_by
from tabspark.operators.small import small_table

REGRESSION = ("RMSE", "MAE", "RMedSE", "MedAE", "R2")
CLASSIFICATION = ("precision", "recall", "f1-score", "accuracy")
# Metrics where a smaller value is better; every other metric is maximised.
MINIMISED = {"RMSE", "MSE", "MAE", "RMedSE", "MedAE", "fpr", "root_mean_squared_error",
             "mean_squared_error", "mean_absolute_error", "median_absolute_error",
             "root_median_squared_error"}


def minimised(metric: str) -> bool:
    """Direction by metric name; negated scorer names are maximised."""
    return metric in MINIMISED


def _error(y: str, yhat: str) -> Column:
    return dbl(y) - dbl(yhat)


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """RMSE, MAE, root median squared error, median absolute error and R2."""
    return regression_by(df, y, yhat, None)


def regression_by(df: DataFrame, y: str, yhat: str, by: str | None, max_groups: int = 100) -> DataFrame:
    """The five metrics overall, or per value of a small grouping column.

    The medians of large groups come from the exact distributed quantile of each row's own
    group, so no such group is held by one task; sqrt is monotone, so the root median squared error at an odd count
    equals the median absolute error and at an even count averages two squares.
    """
    e, t = _error(y, yhat), dbl(y)
    sums = [F.count(e).alias("n"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
            F.var_pop(t).alias("var")]
    if by:
        rows = df.groupBy(F.col(ident(by)).alias("g")).agg(*sums).limit(max_groups + 1).collect()
        if len(rows) > max_groups:
            raise ValueError(f"{by} has over {max_groups} groups")
    else:
        rows = df.agg(F.lit(None).cast("string").alias("g"), *sums).collect()
    group = F.col(ident(by)) if by else F.lit(None).cast("string")
    if max((r["n"] for r in rows), default=0) <= LIMIT:
        half = df.groupBy(group.alias("g")).agg(F.percentile(e * e, 0.5).alias("s"), F.percentile(F.abs(e), 0.5).alias("a"))
        med = {r["g"]: (r["s"], r["a"]) for r in half.collect()}
    else:
        # squares keep the order, so the middle squares are the squares of the middle errors
        pairs = medians_by(df, group, F.abs(e), {r["g"]: r["n"] for r in rows})
        med = {g: (a * a + (b * b - a * a) * 0.5, a + (b - a) * 0.5) for g, (a, b) in pairs.items()}
    out = [((r["g"],) if by else ()) + (
        r["mse"] ** 0.5, r["mae"], med[r["g"]][0] ** 0.5, med[r["g"]][1],
        1.0 - r["mse"] / r["var"] if r["var"] else None) for r in rows]
    group = f"{ident(by)} {dict(df.dtypes)[by]}, " if by else ""
    return small_table(df.sparkSession, 
        out, group + ", ".join(f"{m} double" for m in REGRESSION))


def residual_frame(df: DataFrame, y: str, yhat: str, keep: list[str]) -> DataFrame:
    return df.select(*map(ident, keep), dbl(y).alias("y"), dbl(yhat).alias("prediction"),
                     _error(y, yhat).alias("residual"))


# --- classification ---------------------------------------------------------------------

def confusion_matrix(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.groupBy(F.col(ident(y)).alias("y"), F.col(ident(yhat)).alias("yhat")).agg(
        F.count(F.lit(1)).alias("n"))


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def per_class(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """(label, precision, recall, f1, support); undefined scores are 0."""
    cm = confusion_matrix(df, y, yhat)
    cells = cm.select(F.explode(F.array(
        F.struct(F.col("y").cast("string").alias("label"),
                 F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(0).alias("tp"),
                 F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("yhat").cast("string").alias("label"), F.lit(0).cast("bigint").alias("tp"),
                 F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")))).alias("c")).select("c.*")
    s = cells.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"),
                                   F.sum("predicted").alias("predicted"))
    return s.select("label", _div(F.col("tp"), F.col("predicted")).alias("precision"),
                    _div(F.col("tp"), F.col("support")).alias("recall"),
                    _div(2.0 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
                    "support", "tp")


def classification_report(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Per-class rows, then accuracy, macro and weighted averages."""
    rows = per_class(df, y, yhat)
    n = F.sum("support")
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / n
    avg = rows.agg(F.array(
        F.struct(F.lit("accuracy").alias("label"), (F.sum("tp") / n).alias("precision"),
                 (F.sum("tp") / n).alias("recall"), (F.sum("tp") / n).alias("f1"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                 F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), weighted("precision").alias("precision"),
                 weighted("recall").alias("recall"), weighted("f1").alias("f1"), n.alias("support")),
    ).alias("r")).select(F.inline("r"))
    return rows.drop("tp").unionByName(avg)


def report_by_split(df: DataFrame, y: str, yhat: str, split: str, splits: list[str]) -> DataFrame:
    parts = [classification_report(df.filter(F.col(ident(split)) == s), y, yhat).withColumn("split", F.lit(s))
             for s in splits]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def classification_metrics(df: DataFrame, y: str, yhat: str) -> dict[str, float]:
    """Macro precision, recall and F1, and accuracy."""
    r = per_class(df, y, yhat).agg(F.avg("precision"), F.avg("recall"), F.avg("f1"),
                                   F.sum("tp") / F.sum("support")).first()
    return dict(zip(CLASSIFICATION, map(float, r)))


def macro_f1(df: DataFrame, y: str, yhat: str) -> float:
    return classification_metrics(df, y, yhat)["f1-score"]


def binary_counts(y: Column, yhat: Column, pos=1) -> dict[str, Column]:
    p, q = y == F.lit(pos), yhat == F.lit(pos)
    return {"tp": F.count_if(p & q), "fp": F.count_if(~p & q), "fn": F.count_if(p & ~q), "tn": F.count_if(~p & ~q)}


def f1_macro_from(tp, fp, fn, tn) -> Column:
    return (_div(2.0 * tp, 2.0 * tp + fp + fn) + _div(2.0 * tn, 2.0 * tn + fp + fn)) / 2.0


def binary_scores(df: DataFrame, y: str, yhat: str, pos=1) -> DataFrame:
    """Positive-class precision and recall (= true-positive rate), macro F1, false-positive rate."""
    c = binary_counts(F.col(ident(y)), F.col(ident(yhat)), pos)
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    return df.agg(*[v.alias(k) for k, v in c.items()]).select(
        _div(tp, tp + fp).alias("precision"), _div(tp, tp + fn).alias("recall"),
        f1_macro_from(tp, fp, fn, tn).alias("f1_macro"),
        F.try_divide(fp, fp + tn).alias("fpr"), _div(tp, tp + fn).alias("tpr"))


# Gain per false positive and per false negative.
FALSE_POSITIVE_GAIN = -3.67
FALSE_NEGATIVE_GAIN = -1.0


def cost_gain(df: DataFrame, y: str, yhat: str, pos=1, fp_gain: float = FALSE_POSITIVE_GAIN,
              fn_gain: float = FALSE_NEGATIVE_GAIN) -> DataFrame:
    c = binary_counts(F.col(ident(y)), F.col(ident(yhat)), pos)
    return df.agg((c["fp"] * fp_gain + c["fn"] * fn_gain).alias("gain"))


def evaluate(df: DataFrame, y: str, yhat: str, task: str) -> dict[str, float]:
    """All search metrics of a scored table."""
    if task == "classification":
        return classification_metrics(df, y, yhat)
    return regression_metrics(df, y, yhat).first().asDict()
