"""Scaling and distribution transforms as fitted SQL stages with inverses."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Estimator
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, functions as F

from tabspark.functions import scalar as S
from tabspark.functions.scalar import dbl, ident, num
from tabspark.operators.fitted import Fitted, kind
from tabspark.operators.quantiles import exact_quantiles
from tabspark.operators.small import small_table


def _x(c: str) -> str:
    return f"CAST({ident(c)} AS DOUBLE)"


def standard_params(df, columns):
    row = df.agg(*[F.struct(F.avg(dbl(c)), F.stddev_pop(dbl(c))) for c in columns]).first()
    return {c: (m, s or 1.0) for c, (m, s) in zip(columns, row)}


def minmax_params(df, columns):
    row = df.agg(*[F.struct(F.min(dbl(c)), F.max(dbl(c))) for c in columns]).first()
    return {c: (lo, (hi - lo) or 1.0) for c, (lo, hi) in zip(columns, row)}


def robust_params(df, columns):
    qs = exact_quantiles(df, {c: dbl(c) for c in columns}, [0.25, 0.5, 0.75])
    return {c: (m, (hi - lo) or 1.0) for c, (lo, m, hi) in qs.items()}


# Transforms without parameters: (forward, inverse) as SQL builders.
PLAIN = {
    "log": (lambda x: f"log1p({x})", lambda x: f"expm1({x})"),
    "symlog": (S.symlog_sql, S.symexp_sql),
    "symexp": (S.symexp_sql, S.symlog_sql),
    "arcsinh": (S.arcsinh_sql, S.sinh_sql),
    "identity": (lambda x: x, lambda x: x),
}
AFFINE = {"standard": standard_params, "minmax": minmax_params, "robust": robust_params}
POWER = {"yeo-johnson": (S.yeo_johnson_sql, S.yeo_johnson_inverse_sql), "box-cox": (S.box_cox_sql, S.box_cox_inverse_sql)}


def _built(form: tuple) -> tuple:
    """(forward, inverse) SQL builders of a fitted form.

    Forms: ("plain", name), ("affine", centre, scale), ("power", method, lambda) and ("sql", forward, inverse), the last
    two being SQL with ``{x}`` for the value.
    """
    name, *args = form
    if name == "plain":
        return PLAIN[args[0]]
    if name == "affine":
        return (lambda x: f"({x} - {num(args[0])}) / {num(args[1])}", lambda x: f"{x} * {num(args[1])} + {num(args[0])}")
    if name == "power":
        fwd, inv = POWER[args[0]]
        return (lambda x: fwd(x, args[1]), lambda x: inv(x, args[1]))
    return (lambda x: args[0].replace("{x}", x), lambda x: args[1].replace("{x}", x))


def _forms(df: DataFrame, method: str | tuple[str, str], columns: list[str], lambdas: dict[str, float] | None) -> dict[str, tuple]:
    """The fitted form of every column; a pair of SQL texts is the user's own transform and its inverse."""
    if isinstance(method, tuple):
        if len(method) != 2 or any("{x}" not in m for m in method):
            raise ValueError("a transform of one's own is two SQL texts with {x}: forward and inverse")
        return {c: ("sql", *method) for c in columns}
    if method in PLAIN:
        return {c: ("plain", method) for c in columns}
    if method in AFFINE:
        return {c: ("affine", float(a), float(b)) for c, (a, b) in AFFINE[method](df, columns).items()}
    if method in POWER:
        if method == "box-cox":
            low = df.agg(*[F.min(dbl(c)) for c in columns]).first()
            # a given lambda has a value or a limit at 0; only the likelihood of a fitted one has none
            if any(v is not None and (v < 0 or v == 0 and not lambdas) for v in low):
                raise ValueError("box-cox needs values of 0 and more" if lambdas else "box-cox needs strictly positive values")
        lams = lambdas or {r["column"]: r["lambda"] for r in power_lambdas(df, columns, method)}
        return {c: ("power", method, float(lams[c])) for c in columns}
    raise ValueError(f"unknown transform {method!r}")


class Scaler(Estimator):
    """Any per-column transform by name; ``standardize`` adds a standard scaling after it."""

    def __init__(self, method: str | tuple[str, str], columns: list[str], lambdas: dict[str, float] | None = None,
                 standardize: bool = False):
        super().__init__()
        self.method, self.columns = method, list(columns)
        self.lambdas, self.standardize = lambdas, standardize

    def _fit(self, df: DataFrame) -> "ScalerModel":
        steps = [_forms(df, self.method, self.columns, self.lambdas)]
        if self.standardize:
            mid = ScalerModel(steps).transform(df)
            steps.append(_forms(mid, "standard", self.columns, None))
        return ScalerModel(steps)


@kind("scaler")
def _scaler(df, s):
    for step in s["steps"]:
        df = df.withColumns({c: F.expr(_built(form)[0](_x(c))) for c, form in step.items()})
    return df


class ScalerModel(Fitted):
    """Fitted column transforms, in order; ``steps`` has the form of each column."""

    def __init__(self, steps: list[dict[str, tuple]]):
        super().__init__("scaler", {"steps": steps})

    @property
    def steps(self) -> list[dict[str, tuple]]:
        return [{c: _built(form) for c, form in step.items()} for step in self.state["steps"]]

    def forward_sql(self, column: str, x: str | None = None) -> str:
        sql = x or _x(column)
        for step in self.steps:
            if column in step:
                sql = step[column][0](f"({sql})")
        return sql

    def inverse_sql(self, column: str, x: str | None = None) -> str:
        sql = x or _x(column)
        for step in reversed(self.steps):
            if column in step:
                sql = step[column][1](f"({sql})")
        return sql

    @property
    def columns(self) -> list[str]:
        return list(self.steps[0])

    def inverse(self, df: DataFrame) -> DataFrame:
        for step in self.steps[::-1]:
            df = df.withColumns({c: F.expr(pair[1](_x(c))) for c, pair in step.items()})
        return df

    def as_sql_stages(self, columns: list[str]) -> list[SQLTransformer]:
        """The same projection as saveable built-in stages."""
        out = []
        for step in self.steps:
            items = ", ".join(f"{step[c][0](_x(c))} AS {ident(c)}" if c in step else ident(c)
                              for c in columns)
            out.append(SQLTransformer(statement=f"SELECT {items} FROM __THIS__"))
        return out


# --- power-transform likelihood ---------------------------------------------------------

def power_lambdas(df: DataFrame, columns: list[str], method: str = "yeo-johnson",
                  rounds: int = 5, points: int = 17) -> list[dict]:
    """Maximum-likelihood lambda per column by a grid that narrows around the best point.

    Every round is one aggregate over all columns and candidates.
    """
    yj = method == "yeo-johnson"
    jac = "signum({0}) * ln(1D + abs({0}))" if yj else "ln({0})"
    power = S.yeo_johnson_sql if yj else S.box_cox_sql
    lo, hi = {c: -5.0 for c in columns}, {c: 5.0 for c in columns}
    best: dict[str, tuple[float, float]] = {}
    base = df.select(*[dbl(c).alias(c) for c in columns]).persist()
    for _ in range(rounds):
        grids = {c: np.linspace(lo[c], hi[c], points) for c in columns}
        cells = F.array(*[F.struct(F.lit(k).alias("k"), dbl(c).alias("x")) for k, c in enumerate(columns)])
        lams = F.array(*[F.array(*[F.lit(float(v)) for v in grids[c]]) for c in columns])
        rows = (base.select(F.explode(cells).alias("e")).select("e.k", "e.x").filter("x IS NOT NULL")
                .select("k", "x", F.explode(F.get(lams, F.col("k"))).alias("l")))
        t = F.expr(_power_by_column(yj))
        got = rows.groupBy("k", "l").agg(F.var_pop(t).alias("v"), F.sum(F.expr(jac.format("x"))).alias("j"),
                                         F.count(F.lit(1)).alias("n")).collect()
        for k, c in enumerate(columns):
            cand = [(-0.5 * r["n"] * float(np.log(r["v"])) + (r["l"] - 1.0) * r["j"], r["l"])
                    for r in got if r["k"] == k and r["v"] and np.isfinite(r["v"])]
            if not cand:
                best[c] = (0.0, 1.0)
                continue
            best[c] = max(cand)
            step = (hi[c] - lo[c]) / (points - 1)
            lo[c], hi[c] = best[c][1] - step, best[c][1] + step
    base.unpersist()
    return [{"column": c, "lambda": float(best[c][1]), "log_likelihood": float(best[c][0])} for c in columns]


def _power_by_column(yj: bool) -> str:
    """The power transform with lambda taken from column ``l``."""
    if not yj:
        return "CASE WHEN abs(l) < 1e-12D THEN ln(x) ELSE (pow(x, l) - 1D) / l END"
    return ("CASE WHEN x >= 0D THEN CASE WHEN abs(l) < 1e-12D THEN ln(1D + x) "
            "ELSE (pow(1D + x, l) - 1D) / l END "
            "ELSE CASE WHEN abs(2D - l) < 1e-12D THEN -ln(1D - x) "
            "ELSE -(pow(1D - x, 2D - l) - 1D) / (2D - l) END END")


def power_table(df: DataFrame, columns: list[str], method: str = "yeo-johnson") -> DataFrame:
    rows = [(r["column"], r["lambda"], r["log_likelihood"]) for r in power_lambdas(df, columns, method)]
    return small_table(df.sparkSession, rows, "column string, lambda double, log_likelihood double")


# --- quantile transform --------------------------------------------------------------------

def quantile_transform(df: DataFrame, column: str, out: str, output: str = "uniform",
                       n_quantiles: int = 1000) -> DataFrame:
    """Map a column to its interpolated quantile (or the normal score of it)."""
    n = df.select(F.count(dbl(column))).first()[0]
    refs = np.linspace(0, 1, min(n_quantiles, n))
    quants = np.array(exact_quantiles(df, {"x": dbl(column)}, list(refs), counts={"x": n})["x"])

    @F.pandas_udf("double")
    def interp(x: pd.Series) -> pd.Series:
        v = x.to_numpy(dtype=float)
        # The mean of the interpolation from both sides centres runs of ties.
        up = np.interp(v, quants, refs)
        down = -np.interp(-v, -quants[::-1], -refs[::-1])
        u = 0.5 * (up + down)
        u = np.where(v == quants[0], 0.0, np.where(v == quants[-1], 1.0, u))
        return pd.Series(np.where(np.isnan(v), np.nan, u)).where(~x.isna(), None)

    res = df.withColumn(out, interp(dbl(column)))
    if output == "uniform":
        return res
    clip = 1e-7
    p = F.greatest(F.least(F.col(out), F.lit(1 - clip)), F.lit(clip))
    return res.withColumn(out, S.norm_ppf(p))


def normalize_rows(df: DataFrame, array_column: str, out: str) -> DataFrame:
    """Row L2 normalisation of an array column; zero rows are unchanged."""
    a = F.col(ident(array_column))
    norm = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    return df.withColumn("__norm", norm).withColumn(
        out, F.transform(a, lambda v: v.cast("double") / F.when(F.col("__norm") == 0, 1.0)
                         .otherwise(F.col("__norm")))).drop("__norm")
