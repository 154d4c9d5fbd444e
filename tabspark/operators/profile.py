"""Column profiles, each a single aggregate reshaped into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.scalar import dbl, ident
from tabspark.operators.quantiles import exact_quantiles
from tabspark.operators.roles import Roles, infer_roles
from tabspark.operators.small import small_table

PROFILE_SCHEMA = ("column string, mean double, std double, min double, q25 double, q50 double, "
                  "q75 double, max double")


def unpivot_agg(df: DataFrame, structs: list[Column]) -> DataFrame:
    """One global aggregate, returned as one row per struct."""
    return df.agg(F.array(*structs).alias("r")).select(F.inline("r"))


def _numeric_rows(df: DataFrame, columns: list[str], exact: bool) -> list[tuple]:
    """(column, n, mean, std, min, q25, q50, q75, max) of each column."""
    aggs = []
    for i, c in enumerate(columns):
        x = dbl(c)
        aggs += [F.struct(F.avg(x), F.stddev_samp(x), F.min(x), F.max(x), F.count(x),
                          *([] if exact else [F.percentile_approx(x, [0.25, 0.5, 0.75], 10_000)])
                          ).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    if exact:
        qs = exact_quantiles(df, {c: dbl(c) for c in columns}, [0.25, 0.5, 0.75],
                             counts={c: row[i][4] for i, c in enumerate(columns)})
    else:
        qs = {c: row[i][5] or [None] * 3 for i, c in enumerate(columns)}
    return [(c, row[i][4], row[i][0], row[i][1], row[i][2], *qs[c], row[i][3]) for i, c in enumerate(columns)]


def numeric_profile(df: DataFrame, columns: list[str], exact: bool = True,
                    scalers: dict[str, str] | None = None) -> DataFrame:
    """Mean, sample std, min, quartiles and max per column (optionally its scaler name).

    ``exact=False`` takes the quartiles from a sketch in the same single scan.
    """
    rows = [(c, *values) for c, _, *values in _numeric_rows(df, columns, exact)]
    out = small_table(df.sparkSession, rows, PROFILE_SCHEMA)
    if scalers:
        names = F.create_map(*[F.lit(v) for kv in scalers.items() for v in kv])
        out = out.withColumn("scaler", F.coalesce(F.element_at(names, F.col("column")), F.lit("")))
    return out


def categorical_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Value counts and percentage of all rows per column."""
    total = df.count()
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(ident(c)).cast("string").alias("value"))
        for c in columns])).alias("e")).select("e.*").filter("value IS NOT NULL")
    return cells.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")).withColumn("pct", F.col("n") * 100.0 / F.lit(total))


def describe_columns(df: DataFrame, roles: Roles | None = None, **flags) -> DataFrame:
    """Both profiles under one schema with a type column; what a type does not have is null."""
    roles = roles or infer_roles(df, **flags)
    figures = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    rows = _numeric_rows(df, list(roles.numerical), True) if roles.numerical else []
    out = small_table(df.sparkSession, rows, "column string, n bigint, " + ", ".join(f"{f} double" for f in figures)).select(
        F.lit("Numerical").alias("type"), "column", F.lit(None).cast("string").alias("value"), "n", *figures,
        F.lit(None).cast("double").alias("pct"))
    if not roles.categorical:
        return out
    return out.unionByName(categorical_profile(df, list(roles.categorical)).select(
        F.lit("Categorical").alias("type"), "column", "value", "n",
        *[F.lit(None).cast("double").alias(f) for f in figures], F.col("pct").cast("double").alias("pct")))


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(ident(target)).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weights n / (k * n_c)."""
    counts = class_counts(df, target)
    total, k = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    return counts.select(ident(target), (F.lit(float(total)) / (F.lit(float(k)) * F.col("n"))).alias("weight"))


def distribution_summary(df: DataFrame, column: str) -> DataFrame:
    x = dbl(column)
    return df.agg(F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
                  F.stddev_samp(x).alias("std"), F.count_if(x == 0).alias("n_zero"))


def column_skewness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Population skewness; null for a constant column."""
    return unpivot_agg(df, [F.struct(F.lit(c).alias("column"), F.skewness(dbl(c)).alias("skewness"))
                            for c in columns])


def variance_table(df: DataFrame, columns: list[str], threshold: float = 0.0) -> DataFrame:
    return unpivot_agg(df, [
        F.struct(F.lit(c).alias("column"), F.var_pop(dbl(c)).alias("var_pop"),
                 F.when(F.var_pop(dbl(c)) <= threshold, 0).otherwise(1).cast("bigint").alias("kept"))
        for c in columns])


def low_variance_columns(df: DataFrame, columns: list[str], threshold: float = 0.0) -> list[str]:
    return [r["column"] for r in variance_table(df, columns, threshold).collect() if not r["kept"]]


def missing_census(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    cols = columns or df.columns
    return unpivot_agg(df, [
        F.struct(F.lit(c).alias("column"), F.count_if(F.col(ident(c)).isNull()).alias("n_null"))
        for c in cols])


def assert_no_missing(df: DataFrame) -> None:
    bad = {r["column"]: r["n_null"] for r in missing_census(df).collect() if r["n_null"]}
    if bad:
        raise ValueError(f"missing values: {bad}")


def table_shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)
