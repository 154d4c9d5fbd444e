"""Column and row selection: narrow plans only, except for external id lists."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.scalar import dbl, ident, map_lookup

log = logging.getLogger(__name__)
MAP_LITERAL_LIMIT = 1_000


def filter_values(items: list, values: Iterable, operator: str = "not_in", return_missing: bool = False):
    """Set algebra on name lists; input order is kept in both modes."""
    values = list(values)
    if operator == "in":
        kept = [i for i in items if i in values]
        missing = [i for i in items if i not in values]
    elif operator == "not_in":
        kept = [i for i in items if i not in values]
        missing = [v for v in values if v not in items]
    else:
        raise NotImplementedError(f"operator {operator!r}")
    return (kept, missing) if return_missing else kept


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    present, missing = filter_values(columns, df.columns, "in", return_missing=True)
    if missing:
        log.warning("columns not found and ignored: %s", missing)
    return df.drop(*present)


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[ident(c) for c in filter_values(columns, df.columns, "in")])


def column_indices(df: DataFrame, columns: list[str]) -> list[int]:
    return [df.columns.index(c) for c in columns if c in df.columns]


def extract_columns(df: DataFrame, indices: slice | int | list[int]) -> DataFrame:
    """Columns by slice, one position or a list of positions."""
    cols = df.columns
    if isinstance(indices, slice):
        picked = cols[indices]
    elif isinstance(indices, int):
        picked = [cols[indices]]
    else:
        picked = [cols[i] for i in indices]
    return df.select(*map(ident, picked))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    unknown = [c for c in mapping if c not in df.columns]
    if unknown:
        raise KeyError(f"columns not found: {unknown}")
    return df.withColumnsRenamed(dict(mapping))


def rename_keys(nested, mapping: Mapping[str, str]):
    """Rename metric names in nested dictionaries."""
    if isinstance(nested, Mapping):
        return {mapping.get(k, k): rename_keys(v, mapping) for k, v in nested.items()}
    return nested


def invert_dict(d: Mapping) -> dict:
    return {v: k for k, v in d.items()}


def map_values(df: DataFrame, column: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    """Dictionary lookup on a column; an integer-keyed mapping is read inverted."""
    if mapping and all(isinstance(k, int) for k in mapping):
        mapping = invert_dict(mapping)
    out = out or column
    if len(mapping) <= MAP_LITERAL_LIMIT:
        return df.withColumn(out, map_lookup(F.col(ident(column)), dict(mapping)))
    dim = df.sparkSession.createDataFrame(list(mapping.items()), ["__key", "__value"])
    joined = df.join(dim, F.col(ident(column)) == F.col("__key"), "left")
    return joined.withColumn(out, F.col("__value")).drop("__key", "__value")


def zero_indicator(column: str) -> Column:
    """1 where the value is zero, else 0."""
    return F.when(F.col(ident(column)) == 0, 1).otherwise(0).cast("bigint")


def keep_rows(df: DataFrame, *masks: Column, drop: Iterable[Column] = ()) -> DataFrame:
    """Rows that satisfy every mask and none of the ``drop`` masks."""
    for m in masks:
        df = df.filter(m)
    for m in drop:
        df = df.filter(~F.coalesce(m, F.lit(False)))
    return df


def drop_rows_by_id(df: DataFrame, ids: DataFrame, key: str = "row_id") -> DataFrame:
    """Drop rows whose key is in another table (shuffled or broadcast by its size)."""
    return df.join(ids.select(key), key, "left_anti")


def feature_union(df: DataFrame, branches: Mapping[str, Mapping[str, Column]], keep: list[str]) -> DataFrame:
    """Side-by-side branches as one projection; names become ``branch__column``."""
    cols = [e.alias(f"{b}__{c}") for b, exprs in branches.items() for c, e in exprs.items()]
    return df.select(*map(ident, keep), *cols)


def assemble_xy(df: DataFrame, features: list[str], target: str, keep: list[str],
                omit: Iterable[str] = ()) -> DataFrame:
    """Keys, features and target cast to double."""
    feats = filter_values(features, [target, *omit])
    return df.select(*map(ident, keep), *[dbl(c).alias(c) for c in feats], dbl(target).alias(target))
