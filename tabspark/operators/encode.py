"""One-hot encoding, label codes and polynomial columns."""

from __future__ import annotations

from itertools import combinations, combinations_with_replacement
from math import comb
from os.path import commonprefix

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, functions as F

from tabspark.functions.scalar import ident, num
from tabspark.operators.fitted import Fitted, kind
from tabspark.operators.ordered import ranked

MAX_WIDE_CATEGORIES = 1_000


def category_table(df: DataFrame, columns: list[str], rows_per_block: int | None = None) -> DataFrame:
    """(column, category, position): sorted categories, position 0 is the dropped one."""
    parts = []
    for c in columns:
        values = df.select(F.col(ident(c)).alias("v")).filter(F.col("v").isNotNull()).distinct()
        if dict(values.dtypes)["v"] == "string":
            # A string order column has no numeric quantiles to cut at, so it is
            # cut on the first bytes behind those that all values share, which sort the same way.
            low, high = values.agg(F.min("v"), F.max("v")).first()
            shared = len(commonprefix([low.encode(), high.encode()])) if low is not None else 0
            head = F.substring(F.hex("v"), 2 * shared + 1, 12)
            values = values.withColumn("__prefix", F.conv(F.rpad(head, 12, "0"), 16, 10).cast("bigint"))
            pos = ranked(values, "position", "__prefix", tie_break=["v"], rows_per_block=rows_per_block)
        else:
            pos = ranked(values, "position", "v", rows_per_block=rows_per_block)
        parts.append(pos.select(F.lit(c).alias("column"), F.col("v").cast("string").alias("category"),
                                (F.col("position") - 1).cast("bigint").alias("position")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _native(text: str, dtype: str):
    """A collected category back in its own type, so that it sorts natively."""
    if dtype == "string":
        return text
    if dtype == "boolean":
        return text == "true"
    return float(text) if dtype in ("double", "float") or dtype.startswith("decimal") else int(text)


class OneHot(Estimator):
    """Sorted categories, first one dropped, unknown values become all zeros."""

    def __init__(self, columns: list[str], max_categories: int = MAX_WIDE_CATEGORIES):
        super().__init__()
        self.columns = list(columns)
        self.max_categories = max_categories

    def _fit(self, df: DataFrame) -> "OneHotModel":
        """One pass for all columns; the collected values are bounded by the limit."""
        if not self.columns:
            return OneHotModel({})
        types = dict(df.dtypes)
        cells = df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.col(ident(c)).cast("string").alias("v"))
            for i, c in enumerate(self.columns)])).alias("e")).select("e.*").filter("v IS NOT NULL")
        most = self.max_categories * len(self.columns)
        seen = cells.distinct().limit(most + 1).collect()
        cats: dict[str, list] = {c: [] for c in self.columns}
        for r in seen:
            c = self.columns[r["i"]]
            cats[c].append(_native(r["v"], types[c]))
        wide = [c for c, vs in cats.items() if len(vs) > self.max_categories]
        if wide or len(seen) > most:
            raise ValueError(f"over {self.max_categories} categories in {wide or self.columns}: use SparseOneHot")
        return OneHotModel({c: sorted(vs) for c, vs in cats.items()})


class OneHotModel(Fitted):
    def __init__(self, categories: dict[str, list]):
        super().__init__("one_hot", {"categories": categories})

    @property
    def categories(self) -> dict[str, list]:
        return self.state["categories"]

    @property
    def output_columns(self) -> list[str]:
        return [f"{c}_{v}" for c, vs in self.categories.items() for v in vs[1:]]

    def encoded(self) -> list:
        return [F.when(F.col(ident(c)) == F.lit(v), 1.0).otherwise(0.0).alias(f"{c}_{v}")
                for c, vs in self.categories.items() for v in vs[1:]]

    def transform_only(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """Encoded columns with the key columns only."""
        return df.select(*map(ident, keep), *self.encoded())


@kind("one_hot")
def _one_hot(df, s):
    keep = [ident(c) for c in df.columns if c not in s["categories"]]
    return df.select(*keep, *OneHotModel(s["categories"]).encoded())


def encode_long(df: DataFrame, key: str, columns: list[str], table: DataFrame) -> DataFrame:
    """Sparse one-hot for any cardinality: (key, column, position) of the ones."""
    cells = df.select(ident(key), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(ident(c)).cast("string").alias("category"))
        for c in columns])).alias("e")).select(ident(key), "e.*")
    return (cells.join(table, ["column", "category"]).filter("position > 0")
            .select(ident(key), "column", "position"))


def label_encode(df: DataFrame, column: str, rows_per_block: int | None = None) -> DataFrame:
    """Distinct values with their sorted 0-based code and row count."""
    counts = df.groupBy(ident(column)).agg(F.count(F.lit(1)).alias("n"))
    codes = category_table(df, [column], rows_per_block).select(
        F.col("category").alias("__c"), F.col("position").alias("code"))
    return (counts.join(codes, F.col(ident(column)).cast("string") == F.col("__c"))
            .select(ident(column), "code", "n"))


def polynomial_terms(columns: list[str], degree: int, interaction_only: bool, include_bias: bool) -> list[tuple]:
    pick = combinations if interaction_only else combinations_with_replacement
    terms = [t for d in range(1, degree + 1) for t in pick(columns, d)]
    return ([()] if include_bias else []) + terms


def polynomial_name(term: tuple) -> str:
    if not term:
        return "1"
    return " ".join(c if term.count(c) == 1 else f"{c}^{term.count(c)}" for c in dict.fromkeys(term))


def polynomial_features(
    df: DataFrame,
    columns: list[str],
    n_dimensions: int | None = None,
    degree: int = 2,
    interaction_only: bool = False,
    include_bias: bool = True,
    keep: list[str] = (),
) -> DataFrame:
    """Polynomial terms of the first ``n_dimensions`` columns, the rest passed through."""
    if not columns:
        raise ValueError("no input columns")
    n = len(columns) if n_dimensions is None else min(n_dimensions, len(columns))
    if n <= 0:
        raise ValueError("n_dimensions must be positive")
    terms = polynomial_terms(columns[:n], degree, interaction_only, include_bias)
    exprs = [F.expr(" * ".join(f"CAST({ident(c)} AS DOUBLE)" for c in t) or num(1)).alias(polynomial_name(t))
             for t in terms]
    rest = [F.col(ident(c)).cast("double").alias(c) for c in columns[n:]]
    return df.select(*map(ident, keep), *exprs, *rest)


def expected_polynomial_columns(n_features: int, degree: int, total_columns: int) -> int:
    """Output width with the bias term: C(n + d, d) plus the untouched columns."""
    return comb(n_features + degree, degree) + total_columns - n_features
