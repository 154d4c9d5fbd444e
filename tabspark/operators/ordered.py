"""Ordered computations without a single-task window.

A global or hot-key window would sort everything in one task.  Here rows are cut
into ranges of the order column ("blocks", from approximate quantiles); a small
aggregate per (key, block) gives each block its carry-in, and the real window
runs inside a block.  The number of blocks follows the row count, so small input
keeps the plain window plan.  Where one order value (or null) fills several blocks, its
rows are cut by the tie break.
"""

from __future__ import annotations

import math

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabspark.functions.scalar import bound_index, ident

ROWS_PER_BLOCK = 1_000_000
MAX_BLOCKS = 16_384
TREE_BOUNDS = 256
SUB_BLOCKS = 1 << 20
SAMPLE_PER_CUT = 64
BLOCK = "__block"


def _cuts(df: DataFrame, order: Column, rows_per_block: int | None) -> tuple[list, int]:
    """Approximate quantiles of the order column, a hot value once for each block it fills, and its null count."""
    per_block = rows_per_block or ROWS_PER_BLOCK
    n, missing = df.select(F.count(order), F.count_if(order.isNull())).first()
    blocks = min(MAX_BLOCKS, math.ceil(n / per_block))
    if blocks <= 1:
        return [], missing
    probs = [i / blocks for i in range(1, blocks)]
    return df.select(F.percentile_approx(order, probs, 10 * blocks)).first()[0] or [], missing


def block_bounds(df: DataFrame, order: Column, rows_per_block: int | None = None) -> list:
    """Split points of the order column; empty when one block is enough."""
    return sorted(set(_cuts(df, order, rows_per_block)[0]))


def _tie_cuts(df: DataFrame, order: Column, tie: Column, times: dict) -> dict:
    """{hot value: sorted split points of the tie break among its rows}; ``times`` has the blocks each fills."""
    hot = [v for v in times if v is not None]
    inside = (order.isin(hot) if hot else F.lit(False)) | (order.isNull() if None in times else F.lit(False))
    rows = df.filter(inside & tie.isNotNull()).select(order.alias("v"), tie.alias("t"))
    kind, most = rows.schema["t"].dataType, max(times.values())
    if isinstance(kind, T.StringType):
        # percentiles of text: those of a sample by hash, of a size that follows the number of cuts
        counts = {r["v"]: r["n"] for r in rows.groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()}
        share = min(1.0, most * SAMPLE_PER_CUT / max(1, min(counts.values(), default=1)))
        picked = rows.filter(F.pmod(F.xxhash64("t"), F.lit(1 << 30)) < int(share * (1 << 30)))
        found = {r["v"]: r["t"] for r in picked.groupBy("v").agg(F.sort_array(F.collect_set("t")).alias("t")).collect()}
    elif isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        probs = [i / (most + 1) for i in range(1, most + 1)]
        found = {r["v"]: r["t"] for r in rows.groupBy("v").agg(F.percentile_approx("t", probs, 10 * (most + 1)).alias("t")).collect()}
    else:
        return {}
    return {v: sorted({t[i * len(t) // (times[v] + 1)] for i in range(1, times[v] + 1)}) for v, t in found.items() if t}


def blocks_of(df: DataFrame, order: Column, tie: Column | None = None, rows_per_block: int | None = None) -> Column | None:
    """The block number of a row, rising with (order, tie); None where one block is enough.

    A value or null that fills more than two blocks is cut by the first tie-break
    column, so equal order values are no bound to a block's size; equal (order, tie) rows are.
    """
    cuts, missing = _cuts(df, order, rows_per_block)
    times = {v: n for v, n in Counter(cuts).items() if n > 1}
    if missing > 2 * (rows_per_block or ROWS_PER_BLOCK):
        times[None] = min(MAX_BLOCKS, missing // (rows_per_block or ROWS_PER_BLOCK))
    parts = _tie_cuts(df, order, tie, times) if tie is not None and times else {}
    if not cuts and not parts:
        return None
    block = block_column(order, sorted(set(cuts)))
    if not parts:
        return block
    # a hot value is a split point: its rows are the first of its block, and nulls the first of all
    sub = F.lit(SUB_BLOCKS - 1)
    for v, bounds in parts.items():
        mine = order.isNull() if v is None else order == F.lit(v)
        sub = F.when(mine, block_column(tie, bounds)).otherwise(sub)
    return block.cast("bigint") * SUB_BLOCKS + sub


def block_column(order: Column, bounds: list) -> Column:
    if len(bounds) <= TREE_BOUNDS:
        return bound_index(order, bounds)
    edges = pd.Series(bounds).to_numpy()  # datetimes as datetime64, as the batches have them
    known = F.coalesce(order, F.lit(bounds[0]))

    @F.pandas_udf("int")
    def search(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, x.to_numpy(), side="right").astype("int32"))

    # A missing order value sorts first, so it belongs to the first block.
    return F.when(order.isNull(), F.lit(0)).otherwise(search(known))


def _with_carry(df: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """Each row with its block's carry-in; a missing key is a key of its own."""
    names = [*keys, BLOCK]
    right = carry.withColumnsRenamed({k: f"__r_{k}" for k in names})
    cond = [F.col(ident(k)).eqNullSafe(F.col(ident(f"__r_{k}"))) for k in names]
    return df.join(right, cond, "inner").drop(*[f"__r_{k}" for k in names])


def _block_window(keys: list[str], order: list[Column], descending: bool):
    part = [F.col(ident(k)) for k in keys] + [F.col(BLOCK)]
    return Window.partitionBy(*part).orderBy(*[c.desc() if descending else c.asc() for c in order])


def _carry_window(keys: list[str], descending: bool):
    step = F.col(BLOCK).desc() if descending else F.col(BLOCK).asc()
    w = Window.partitionBy(*[F.col(ident(k)) for k in keys]) if keys else Window.partitionBy(F.lit(0))
    return w.orderBy(step).rowsBetween(Window.unboundedPreceding, -1)


def running_sum(
    df: DataFrame,
    sums: dict[str, Column],
    order: str,
    keys: list[str] | None = None,
    descending: bool = False,
    rows_per_block: int | None = None,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """Inclusive running sums over ``order`` (unique within a key, or with a tie break)."""
    keys = keys or []
    oc = F.col(ident(order))
    by = [oc] + [F.col(ident(t)) for t in tie_break or []]
    inner = [f"__v{i}" for i in range(len(sums))]
    block = blocks_of(df, oc, by[1] if len(by) > 1 else None, rows_per_block)
    df = df.withColumns({BLOCK: F.lit(0) if block is None else block, **dict(zip(inner, sums.values()))})
    w = _block_window(keys, by, descending).rowsBetween(Window.unboundedPreceding, 0)
    if block is None:
        return df.withColumns(
            {o: F.sum(v).over(w) for o, v in zip(sums, inner)}).drop(BLOCK, *inner)
    carry = (
        df.groupBy(*keys, BLOCK)
        .agg(*[F.sum(v).alias(f"__t{i}") for i, v in enumerate(inner)])
        .select(*keys, BLOCK, *[
            F.coalesce(F.sum(f"__t{i}").over(_carry_window(keys, descending)), F.lit(0)).alias(f"__c{i}")
            for i in range(len(inner))])
    )
    out = _with_carry(df, carry, keys)
    return out.withColumns({
        o: F.sum(v).over(w) + F.col(f"__c{i}") for i, (o, v) in enumerate(zip(sums, inner))
    }).drop(BLOCK, *inner, *[f"__c{i}" for i in range(len(inner))])


def ranked(
    df: DataFrame,
    out: str,
    order: str,
    keys: list[str] | None = None,
    descending: bool = False,
    rows_per_block: int | None = None,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """1-based row number over ``order`` within ``keys``."""
    return running_sum(df, {out: F.lit(1).cast("bigint")}, order, keys, descending,
                       rows_per_block, tie_break)


def filled(
    df: DataFrame,
    column: str,
    order: str,
    keys: list[str] | None = None,
    backward: bool = False,
    rows_per_block: int | None = None,
) -> DataFrame:
    """Forward (or backward) fill of one column along a unique order column."""
    keys = keys or []
    oc, c = F.col(ident(order)), F.col(ident(column))
    bounds = block_bounds(df, oc, rows_per_block)
    df = df.withColumn(BLOCK, block_column(oc, bounds))
    w = _block_window(keys, [oc], backward).rowsBetween(Window.unboundedPreceding, 0)
    local = F.last(c, ignorenulls=True).over(w)
    if not bounds:
        return df.withColumn(column, local).drop(BLOCK)
    edge = F.min_by if backward else F.max_by
    carry = (
        df.groupBy(*keys, BLOCK)
        .agg(edge(c, F.when(c.isNotNull(), oc)).alias("__last"))
        .withColumn("__carry", F.last("__last", ignorenulls=True).over(_carry_window(keys, backward)))
        .drop("__last")
    )
    out = _with_carry(df, carry, keys)
    return out.withColumn(column, F.coalesce(local, F.col("__carry"))).drop(BLOCK, "__carry")
