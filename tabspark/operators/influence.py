"""Leverage, studentised residuals, Cook's distance and DFITS."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.scalar import dbl, ident
from tabspark.operators.gram import leverage


def _flag(c: Column) -> Column:
    return F.when(c, 1).otherwise(0).cast("bigint")


def leverage_flags(df: DataFrame, features: list[str], target: str, prediction: str,
                   keep: list[str], residuals_cutoff: float = 2.0) -> DataFrame:
    """High leverage (h > 2(p+1)/n), high residual (|r / std| > cutoff) and the category."""
    r = dbl(target) - dbl(prediction)
    n, std = df.agg(F.count(r), F.stddev_pop(r)).first()
    h = leverage(df, features)
    out = df.select(*map(ident, keep),
                    (h > F.lit(2.0 * (len(features) + 1) / n)).alias("__hl"),
                    (F.abs(r / F.lit(std or 1.0)) > residuals_cutoff).alias("__hr"))
    hl, hr = F.col("__hl"), F.col("__hr")
    category = (F.when(hl & hr, "high leverage and residual").when(hl, "high leverage")
                .when(hr, "high residual").otherwise("normal"))
    return out.select(*map(ident, keep), _flag(hl).alias("high_leverage"),
                      _flag(hr).alias("high_residual"), category.alias("category"))


def leverage_summary(flags: DataFrame) -> DataFrame:
    hl, hr = F.col("high_leverage") == 1, F.col("high_residual") == 1
    rows = [("High leverage points", hl), ("High studentized residuals", hr),
            ("High leverage & ~high residuals", hl & ~hr),
            ("High residuals & ~high leverage", hr & ~hl), ("Total", hl | hr)]
    return flags.agg(F.array(*[F.struct(F.lit(d).alias("description"), F.count_if(c).alias("n"))
                               for d, c in rows]).alias("r")).select(F.inline("r"))


def influence_flags(df: DataFrame, features: list[str], target: str, prediction: str,
                    keep: list[str], measure: str = "cook", cook_threshold: float = 3.0,
                    dfits_threshold: float = 2.0, two_sided: bool = False) -> DataFrame:
    """Influential rows; DFITS is read on the upper side only unless ``two_sided``."""
    if measure not in ("cook", "dfits"):
        raise ValueError(f"unknown influence measure {measure!r}")
    r = dbl(target) - dbl(prediction)
    n, mse = df.agg(F.count(r), F.avg(r * r)).first()
    p = len(features)
    base = df.select(*map(ident, keep), r.alias("__r"), leverage(df, features).alias("__h"))
    h, r = F.col("__h"), F.col("__r")
    if measure == "cook":
        cook = r * r / F.lit(mse) / F.lit(float(p)) * (h / ((1.0 - h) * (1.0 - h)))
        cut = base.agg(F.avg(cook)).first()[0] * cook_threshold
        hit = cook > F.lit(cut)
    else:
        dfits = r / (F.lit(math.sqrt(mse)) * F.sqrt(1.0 - h)) * F.sqrt(h / (1.0 - h))
        value = F.abs(dfits) if two_sided else dfits
        hit = value > F.lit(dfits_threshold * math.sqrt(p / n))
    return base.select(*map(ident, keep), _flag(hit).alias("flag"))
