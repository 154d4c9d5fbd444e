"""Distribution fits, histograms, Q-Q points and kernel density on a grid."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.scalar import dbl, equal_width_bin, ident, norm_ppf
from tabspark.functions.special import gamma_shape
from tabspark.operators.ordered import ranked
from tabspark.operators.small import small_table


def fit_norm(df: DataFrame, x: Column) -> dict[str, float]:
    m, s = df.agg(F.avg(x), F.stddev_pop(x)).first()
    return {"loc": m, "scale": s}


def fit_lognorm(df: DataFrame, x: Column) -> dict[str, float]:
    """Location fixed at zero: the moments of ln x."""
    m, s = df.filter(x > 0).agg(F.avg(F.log(x)), F.stddev_pop(F.log(x))).first()
    return {"s": s, "scale": math.exp(m)}


def fit_gamma(df: DataFrame, x: Column) -> dict[str, float]:
    """Location fixed at zero: Newton on mean and mean log."""
    m, ml = df.filter(x > 0).agg(F.avg(x), F.avg(F.log(x))).first()
    k = gamma_shape(m, ml)
    return {"a": k, "scale": m / k}


FITS = {"norm": fit_norm, "lognorm": fit_lognorm, "gamma": fit_gamma}


def fit_table(df: DataFrame, column: str, distribution: str = "norm", apply_transform=None) -> DataFrame:
    """Parameters of a named distribution, after an optional Column -> Column transform."""
    if distribution not in FITS:
        raise ValueError(f"unknown distribution {distribution!r}")
    x = dbl(column)
    got = FITS[distribution](df, apply_transform(x) if apply_transform else x)
    return small_table(df.sparkSession, [(k, float(v)) for k, v in got.items()],
                                           "parameter string, value double")


def fitted_density(x: Column, distribution: str, params: dict[str, float]) -> Column:
    if distribution == "norm":
        z = (x - F.lit(params["loc"])) / F.lit(params["scale"])
        return F.exp(-z * z / 2) / F.lit(params["scale"] * math.sqrt(2 * math.pi))
    if distribution == "lognorm":
        z = F.log(x / F.lit(params["scale"])) / F.lit(params["s"])
        return F.when(x > 0, F.exp(-z * z / 2) / (x * F.lit(params["s"] * math.sqrt(2 * math.pi)))).otherwise(0.0)
    a, b = params["a"], params["scale"]
    log_pdf = F.lit(a - 1) * F.log(x) - x / F.lit(b) - F.lit(math.lgamma(a) + a * math.log(b))
    return F.when(x > 0, F.exp(log_pdf)).otherwise(0.0)


def density_grid(df: DataFrame, column: str, distribution: str, points: int = 1000) -> DataFrame:
    """The fitted density on an even grid over the data range."""
    lo, hi = df.agg(F.min(dbl(column)), F.max(dbl(column))).first()
    params = FITS[distribution](df, dbl(column))
    x = F.lit(lo) + F.col("id") * F.lit((hi - lo) / (points - 1))
    grid = df.sparkSession.range(points).select(x.alias("x"))
    return grid.select("x", fitted_density(F.col("x"), distribution, params).alias("density"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width counts of all bins, empty ones too; all are empty without a value."""
    x = dbl(column)
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return every.withColumn("n", F.lit(0).cast("bigint"))
    counts = (df.filter(x.isNotNull()).groupBy(equal_width_bin(x, lo, hi, bins).alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    return every.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def histogram_by_class(df: DataFrame, features: list[str], target: str, bins: int = 20,
                       log_bins: bool = False, empty: bool = False) -> DataFrame:
    """Counts per (feature, class, bin); log bins use log10 of the positive values.

    With ``empty`` every class has all bins of every feature, so that classes can be drawn
    over each other; a null class is a class, and a feature without values has empty bins only.
    """
    prep = (lambda c: F.when(dbl(c) > 0, F.log10(dbl(c)))) if log_bins else dbl
    row = df.agg(*[F.struct(F.min(prep(c)), F.max(prep(c))) for c in features]).first()
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"), (F.lit(None).cast("int") if lo is None else equal_width_bin(prep(c), lo, hi, bins).cast("int")).alias("bin"))
        for c, (lo, hi) in zip(features, row)])
    found = df.select(F.col(ident(target)).alias("class"), F.explode(cells).alias("e")).select("class", "e.feature", "e.bin")
    if not empty:
        return found.filter("bin IS NOT NULL").groupBy("feature", "class", "bin").agg(F.count(F.lit(1)).alias("n"))
    # one row of counts per feature and class; its bins are unfolded after the shuffle
    counts = [F.count_if(F.col("bin") == i) for i in range(bins)]
    rows = found.groupBy("feature", "class").agg(F.array(*counts).alias("c"))
    return rows.select("feature", "class", F.posexplode("c").alias("bin", "n"))


def grid_size(n_plots: int, n_rows: int) -> int:
    """Columns of a plot grid with the given rows."""
    return math.ceil(n_plots / n_rows)


def qq_points(df: DataFrame, column: str, key: str, rows_per_block: int | None = None) -> DataFrame:
    """(theoretical, observed) pairs at Filliben's plotting positions."""
    x = df.select(ident(key), dbl(column).alias("observed")).filter("observed IS NOT NULL")
    n = x.count()
    r = ranked(x, "__i", "observed", tie_break=[key], rows_per_block=rows_per_block)
    last = 0.5 ** (1.0 / n)
    pos = (F.when(F.col("__i") == 1, 1.0 - last).when(F.col("__i") == n, last)
           .otherwise((F.col("__i") - 0.3175) / (n + 0.365)))
    return r.select(norm_ppf(pos).alias("theoretical"), "observed")


def kde_grid(df: DataFrame, column: str, points: int = 200, per_bandwidth: int = 32) -> DataFrame:
    """Gaussian kernel density with the Scott bandwidth at ``points`` places over the range.

    Values are counted in bins of a fixed share of the bandwidth, so outliers make
    empty bins (which do not exist) and not wider ones. A bin stands at the mean of
    its values and adds to the places
    within ten bandwidths; the sums combine before the one shuffle. Nulls are left
    out; values that are all equal get bandwidth n ** -0.2.
    """
    x = dbl(column)
    lo, hi, std, n = df.agg(F.min(x), F.max(x), F.stddev_samp(x), F.count(x)).first()
    if not n:
        return small_table(df.sparkSession, [], "x double, density double")
    bw = (std or 1.0) * n ** -0.2
    width, step = bw / per_bandwidth, (hi - lo) / max(points - 1, 1)
    bins = df.filter(x.isNotNull()).groupBy(F.floor((x - lo) / width).alias("bin")).agg(F.count("*").alias("n"), F.avg(x).alias("mid"))
    center = F.col("mid") - lo
    if step > 0:
        first, last = F.ceil((center - 10 * bw) / step), F.floor((center + 10 * bw) / step)
        near = bins.withColumns({"first": F.greatest(first, F.lit(0)), "last": F.least(last, F.lit(points - 1))}).filter("first <= last")
    else:
        near = bins.withColumns({"first": F.lit(0), "last": F.lit(0)})
    near = near.withColumn("i", F.explode(F.sequence(F.col("first").cast("int"), F.col("last").cast("int"))))
    z = (F.col("i") * step - center) / bw
    sums = {r["i"]: r["d"] for r in near.groupBy("i").agg(F.sum(F.col("n") * F.exp(-0.5 * z * z)).alias("d")).collect()}
    norm = n * bw * math.sqrt(2 * math.pi)
    count = points if step > 0 else 1
    return small_table(df.sparkSession, [(float(lo + i * step), float(sums.get(i, 0.0) / norm)) for i in range(count)],
                       "x double, density double")
