"""Column functions: every one is a JVM expression, none is a Python UDF.

Functions that end up inside a fitted stage return SQL text, so the stage can be
a plain ``SQLTransformer`` and be saved with its pipeline.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def ident(name: str) -> str:
    """Quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def num(x: float) -> str:
    """A double literal for SQL text."""
    x = float(x)
    if x != x:
        return "CAST('NaN' AS DOUBLE)"
    if x in (float("inf"), float("-inf")):
        return f"CAST('{x}' AS DOUBLE)"
    return f"({x!r}D)"


def text(s: str) -> str:
    """A string literal for SQL text."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def dbl(c: str | Column) -> Column:
    return (F.col(ident(c)) if isinstance(c, str) else c).cast("double")


def no_neg_zero(c: Column) -> Column:
    return c + F.lit(0.0)


# --- symmetric and skew-reducing maps ---------------------------------------

def symlog_sql(x: str) -> str:
    return f"signum({x}) * ln(1D + abs({x}))"


def symexp_sql(x: str) -> str:
    return f"signum({x}) * (exp(abs({x})) - 1D)"


def arcsinh_sql(x: str) -> str:
    # asinh from logs keeps the sign symmetric for large negative values.
    return f"signum({x}) * ln(abs({x}) + sqrt({x} * {x} + 1D))"


def sinh_sql(x: str) -> str:
    return f"sinh({x})"


def yeo_johnson_sql(x: str, lam: float) -> str:
    pos = f"ln(1D + {x})" if lam == 0 else f"(pow(1D + {x}, {num(lam)}) - 1D) / {num(lam)}"
    lam2 = 2.0 - lam
    neg = f"-ln(1D - {x})" if lam2 == 0 else f"-(pow(1D - {x}, {num(lam2)}) - 1D) / {num(lam2)}"
    return f"CASE WHEN {x} >= 0D THEN {pos} ELSE {neg} END"


def yeo_johnson_inverse_sql(x: str, lam: float) -> str:
    pos = f"exp({x}) - 1D" if lam == 0 else f"pow({num(lam)} * {x} + 1D, {num(1 / lam)}) - 1D"
    lam2 = 2.0 - lam
    neg = f"1D - exp(-({x}))" if lam2 == 0 else f"1D - pow(1D - {num(lam2)} * {x}, {num(1 / lam2)})"
    return f"CASE WHEN {x} >= 0D THEN {pos} ELSE {neg} END"


def box_cox_sql(x: str, lam: float) -> str:
    # ln of 0 is null in Spark; the limit is minus infinity
    return (f"CASE WHEN {x} = 0D THEN {num(float('-inf'))} ELSE ln({x}) END" if lam == 0
            else f"(pow({x}, {num(lam)}) - 1D) / {num(lam)}")


def box_cox_inverse_sql(x: str, lam: float) -> str:
    return f"exp({x})" if lam == 0 else f"pow({num(lam)} * {x} + 1D, {num(1 / lam)})"


# --- formatting -------------------------------------------------------------

def format_number(x: Column, decimals: int = 3, precision: int = 3) -> Column:
    """Fixed text, scientific text for small values, zero text below the precision."""
    zero = f"{0:.{decimals}f}"
    small = F.abs(x) < 10.0 ** -decimals
    out = F.when(x == 0, F.lit(zero))
    if precision > 0:
        out = out.when(F.abs(x) < 10.0 ** -precision, F.lit(zero))
    return (
        out.when(small, F.format_string(f"%.{decimals}e", x))
        .otherwise(F.format_string(f"%.{decimals}f", x))
    )


def percent_text(part: Column, total: Column) -> Column:
    return F.format_string("%.2f%%", part * 100.0 / total)


# --- hashing for seeded, engine-independent splits ---------------------------

HASH_RANGE = 1 << 32


def hash32(key: Column, seed: int | str) -> Column:
    """First 8 hex digits of md5('<seed>:<key>') as a BIGINT in [0, 2^32)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


# --- maps -------------------------------------------------------------------

def map_lookup(col: Column, mapping: dict) -> Column:
    """Dictionary lookup as a literal map; a key outside the mapping gives null."""
    pairs = [F.lit(v) for kv in mapping.items() for v in kv]
    return F.element_at(F.create_map(*pairs), col)


def map_invert(m: Column) -> Column:
    return F.map_from_arrays(F.map_values(m), F.map_keys(m))


def map_rename_keys(m: Column, mapping: dict[str, str]) -> Column:
    lookup = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.transform_keys(m, lambda k, _: F.coalesce(F.element_at(lookup, k), k))


def map_key_with_suffix(m: Column, suffix: str) -> Column:
    """First key that ends with the suffix, or null."""
    hits = F.filter(F.map_keys(m), lambda k: k.endswith(suffix))
    return F.get(hits, F.lit(0))


# --- bins and search ----------------------------------------------------------

def equal_width_bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    """0-based equal-width bin; the upper edge belongs to the last bin."""
    width = (hi - lo) / bins if hi > lo else 1.0
    raw = F.floor((x - F.lit(float(lo))) / F.lit(width))
    # least() skips nulls, so a missing value is kept missing explicitly.
    return F.when(x.isNotNull(), F.least(raw, F.lit(bins - 1))).cast("bigint")


def bound_index(x: Column, bounds: list) -> Column:
    """How many of the sorted bounds are <= x, as a balanced CASE tree."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x >= F.lit(bounds[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(bounds)).cast("int")


def digamma(x: Column) -> Column:
    """psi(x) for x >= 1: eight steps up, then the asymptotic series."""
    z = x.cast("double") + 8
    v = 1 / (z * z)
    series = F.log(z) - 0.5 / z - v * (1 / 12 - v * (1 / 120 - v * (1 / 252 - v * (1 / 240 - v / 132))))
    return series - reduce(lambda a, b: a + b, [1 / (x + i) for i in range(8)])


def dot(cols: list[Column], weights) -> Column:
    return reduce(lambda a, b: a + b, [c * F.lit(float(w)) for c, w in zip(cols, weights)])


# --- normal quantile ----------------------------------------------------------

# Coefficients of the published AS241 (PPND16) approximation,
# lowest power first.
_AS241 = {
    "a": (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
          1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
          3.3430575583588128105e4, 2.5090809287301226727e3),
    "b": (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
          2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
          5.2264952788528545610e3),
    "c": (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
          3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
          2.27238449892691845833e-2, 7.74545014278341407640e-4),
    "d": (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
          1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
          1.05075007164441684324e-9),
    "e": (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
          2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
          2.71155556874348757815e-5, 2.01033439929228813265e-7),
    "f": (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
          7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
          2.04426310338993978564e-15),
}


def norm_ppf(p: Column) -> Column:
    """Standard normal quantile as one expression."""
    def poly(key: str, x: Column) -> Column:
        return reduce(lambda acc, k: acc * x + F.lit(k), reversed(_AS241[key][:-1]),
                      F.lit(_AS241[key][-1]))

    q = p - F.lit(0.5)
    r0 = F.lit(0.180625) - q * q
    r = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    near, far = r - F.lit(1.6), r - F.lit(5.0)
    tail = F.when(r <= 5.0, poly("c", near) / poly("d", near)).otherwise(
        poly("e", far) / poly("f", far))
    return F.when(F.abs(q) <= 0.425, q * poly("a", r0) / poly("b", r0)).otherwise(
        F.signum(q) * tail)
