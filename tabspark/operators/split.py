"""Seeded splits and folds as columns on the row."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.scalar import HASH_RANGE, hash32, ident
from tabspark.operators.ordered import ranked


def hash_split(df: DataFrame, key: str = "row_id", test_size: float = 0.2, seed: int = 42,
               out: str = "split") -> DataFrame:
    """Row-wise train/test split by a seeded hash: no shuffle, stable under re-runs."""
    cut = int(test_size * HASH_RANGE)
    return df.withColumn(out, F.when(hash32(F.col(ident(key)), seed) < F.lit(cut), "test").otherwise("train"))


def _class_sizes(df: DataFrame, target: str, limit: int = 10_000) -> dict:
    rows = df.groupBy(ident(target)).agg(F.count(F.lit(1)).alias("n")).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{target} has over {limit} strata")
    return {r[0]: r["n"] for r in rows}


def _per_class(target: str, values: dict, otherwise=None) -> Column:
    whens = reduce(lambda acc, kv: acc.when(F.col(ident(target)).eqNullSafe(F.lit(kv[0])), F.lit(kv[1])),
                   values.items(), F)
    return whens.otherwise(F.lit(otherwise)) if otherwise is not None else whens


def stratified_split(df: DataFrame, target: str, key: str = "row_id", test_size: float = 0.2,
                     seed: int = 42, out: str = "split", rows_per_block: int | None = None) -> DataFrame:
    """Exact test share per stratum: the first ceil(share * n) rows in hash order."""
    sizes = {v: math.ceil(test_size * n) for v, n in _class_sizes(df, target).items()}
    h = df.withColumn("__h", hash32(F.col(ident(key)), seed))
    r = ranked(h, "__i", "__h", [target], rows_per_block=rows_per_block, tie_break=[key])
    return r.withColumn(out, F.when(F.col("__i") <= _per_class(target, sizes), "test").otherwise("train")
                        ).drop("__h", "__i")


def kfold(df: DataFrame, order: str = "row_id", n_splits: int = 5, out: str = "fold",
          rows_per_block: int | None = None) -> DataFrame:
    """Contiguous unshuffled folds; the first n mod k folds have one row more."""
    n = df.count()
    base, extra = divmod(n, n_splits)
    r = ranked(df, "__i", order, rows_per_block=rows_per_block)
    big = extra * (base + 1)
    i = F.col("__i") - 1
    fold = F.when(i < big, F.floor(i / (base + 1))).otherwise(extra + F.floor((i - big) / max(base, 1)))
    return r.withColumn(out, fold.cast("bigint")).drop("__i")


def stratified_allocation(sizes: dict, n_splits: int) -> dict:
    """Rows of each class per fold when the class-sorted labels are dealt round robin."""
    out, start = {}, 0
    for v in sorted(sizes, key=lambda v: (v is not None, v)):  # a missing label is a class of its own, the first
        n = sizes[v]
        out[v] = [_dealt(start, n, f, n_splits) for f in range(n_splits)]
        start += n
    return out


def _dealt(start: int, n: int, f: int, k: int) -> int:
    """Positions p in [start, start+n) with p mod k == f."""
    upto = lambda m: (m - f + k - 1) // k if m > f else 0
    return upto(start + n) - upto(start)


def stratified_kfold(df: DataFrame, target: str, order: str = "row_id", n_splits: int = 5,
                     out: str = "fold", rows_per_block: int | None = None) -> DataFrame:
    """Stratified unshuffled folds: contiguous within a class, sizes as dealt round robin."""
    alloc = stratified_allocation(_class_sizes(df, target), n_splits)
    r = ranked(df, "__i", order, [target], rows_per_block=rows_per_block)
    fold = None
    for v, sizes in alloc.items():
        edge, inner = 0, None
        for f, s in enumerate(sizes[:-1]):
            edge += s
            cond = F.col("__i") <= edge
            inner = F.when(cond, f) if inner is None else inner.when(cond, f)
        inner = inner.otherwise(n_splits - 1) if inner is not None else F.lit(0)
        cond = F.col(ident(target)).eqNullSafe(F.lit(v))
        fold = F.when(cond, inner) if fold is None else fold.when(cond, inner)
    return r.withColumn(out, fold.cast("bigint")).drop("__i")


def shuffle_split(df: DataFrame, key: str = "row_id", n_splits: int = 5, test_size: float = 0.2,
                  seed: int = 42) -> DataFrame:
    """One row per repeat with an independent hashed split."""
    cut = int(test_size * HASH_RANGE)
    rep = df.withColumn("repeat", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_splits - 1).cast("bigint"))))
    tag = F.concat(F.col("repeat"), F.lit(":"), F.col(ident(key)))
    return rep.withColumn("split", F.when(hash32(tag, seed) < F.lit(cut), "test").otherwise("train"))


def fold_part(df: DataFrame, fold_value: int, fold: str = "fold", mask: Column | None = None,
              only_train: bool = True) -> tuple[DataFrame, DataFrame]:
    """(train, validation) of one fold; the mask keeps rows, in validation only on request."""
    train, val = df.filter(F.col(fold) != fold_value), df.filter(F.col(fold) == fold_value)
    if mask is not None:
        train = train.filter(mask)
        if not only_train:
            val = val.filter(mask)
    return train, val


def masked_fold_sizes(df: DataFrame, mask: Column, n_splits: int, fold: str = "fold",
                      only_train: bool = True) -> DataFrame:
    """(fold, part, n) after masking, in one aggregate."""
    m = F.coalesce(mask, F.lit(False))
    val = F.lit(True) if only_train else m
    rows = F.array(*[s for k in range(n_splits) for s in (
        F.struct(F.lit(k).cast("bigint").alias("fold"), F.lit("train").alias("part"),
                 F.count_if((F.col(fold) != k) & m).alias("n")),
        F.struct(F.lit(k).cast("bigint").alias("fold"), F.lit("val").alias("part"),
                 F.count_if((F.col(fold) == k) & val).alias("n")))])
    return df.agg(rows.alias("r")).select(F.inline("r"))
