"""Missing-value filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabspark.functions.scalar import dbl, ident
from tabspark.operators.ordered import filled
from tabspark.operators.profile import missing_census
from tabspark.operators.quantiles import exact_quantiles


def fill_missing(df: DataFrame, columns: list[str], method: str = "mean", axis: int = 0,
                 order: str | None = None, keys: list[str] | None = None,
                 rows_per_block: int | None = None) -> DataFrame:
    """``drop``, ``mean``, ``median``, ``ffill`` or ``bfill``; axis 1 works across columns.

    The two averages are always taken down the column, whatever the axis.
    """
    if method == "drop":
        if axis == 1:
            gone = [r["column"] for r in missing_census(df, columns).collect() if r["n_null"]]
            return df.drop(*gone)
        return df.dropna(subset=columns)
    if method in ("mean", "median"):
        if method == "mean":
            row = df.agg(*[F.avg(dbl(c)) for c in columns]).first()
            values = dict(zip(columns, row))
        else:
            values = {c: q[0] for c, q in exact_quantiles(df, {c: dbl(c) for c in columns}, [0.5]).items()}
        return df.withColumns({c: F.coalesce(dbl(c), F.lit(values[c])) for c in columns})
    if method in ("ffill", "bfill"):
        if axis == 1:
            seq = columns if method == "ffill" else columns[::-1]
            return df.withColumns({
                c: F.coalesce(*[F.col(ident(p)) for p in seq[: i + 1][::-1]]) for i, c in enumerate(seq)})
        if order is None:
            raise ValueError("ffill and bfill need an order column")
        for c in columns:
            df = filled(df, c, order, keys, backward=method == "bfill", rows_per_block=rows_per_block)
        return df
    raise ValueError(f"unknown fill method {method!r}")
