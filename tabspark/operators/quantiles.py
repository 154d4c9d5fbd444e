"""Exact interpolated quantiles that stay distributed.

Up to ``LIMIT`` rows the built-in ``percentile`` is used (its buffer is then
bounded).  Beyond that a sketch brackets each wanted rank, only values inside the
brackets are counted per distinct value, and a blocked running sum finds the
ranks: exact, and no task holds a whole column.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.operators.ordered import running_sum

LIMIT = 250_000
ACCURACY = 10_000
MAX_BRACKETS = 32
#: Every value: NaN is the greatest in the order of Spark.
WHOLE = [(-math.inf, math.nan)]


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column],
    probs: list[float],
    limit: int | None = None,
    rows_per_block: int | None = None,
    counts: dict[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """{name: [linear-interpolated quantile per probability]}; nulls are skipped.

    ``counts`` (non-null rows per name) saves a scan when already known.
    """
    limit = LIMIT if limit is None else limit
    names = list(columns)
    wide = df.select(*[columns[c].cast("double").alias(f"q{i}") for i, c in enumerate(names)])
    probs = [float(p) for p in probs]
    if counts is None:
        row = wide.agg(*[F.count(f"q{i}").alias(f"q{i}") for i in range(len(names))]).first()
        counts = dict(zip(names, row))
    n = [counts[c] for c in names]
    small = [i for i in range(len(names)) if n[i] <= limit]
    out: dict[str, list[float | None]] = {}
    if small:
        got = wide.agg(*[F.percentile(f"q{i}", F.array(*map(F.lit, probs))).alias(f"q{i}")
                         for i in small]).first()
        out.update({names[i]: list(got[k]) if got[k] is not None else [None] * len(probs)
                    for k, i in enumerate(small)})
    large = [i for i in range(len(names)) if n[i] > limit]
    if large:
        out.update(_large(wide, large, names, n, probs, rows_per_block))
    return {c: out[c] for c in names}


def _large(wide, idx, names, n, probs, rows_per_block):
    ranks = {i: sorted({r for p in probs for r in _pair(p, n[i])}) for i in idx}
    spans = _brackets(wide, idx, probs) if len(probs) <= MAX_BRACKETS else {i: WHOLE for i in idx}
    value = _order_statistics(wide, spans, ranks, rows_per_block)
    # A sketch that missed a rank is rare; such columns are read without brackets.
    missed = [i for i in idx if any((i, r) not in value for r in ranks[i])]
    if missed:
        value.update(_order_statistics(wide, {i: WHOLE for i in missed}, ranks, rows_per_block))
    out = {}
    for i in idx:
        res = []
        for p in probs:
            lo, hi = _pair(p, n[i])
            a, b = value[i, lo], value[i, hi]
            res.append(a if lo == hi else a + (b - a) * (p * (n[i] - 1) - lo))
        out[names[i]] = res
    return out


def _order_statistics(wide, spans, ranks, rows_per_block) -> dict[tuple[int, int], float]:
    """{(column, rank): value} for the ranks that fall inside a span.

    Values inside a span are counted one by one; everything between two spans is
    a single row, so only few rows leave the map side.
    """
    cells = []
    for i, parts in spans.items():
        v = F.col(f"q{i}")
        region, low = F, F
        for j, (a, b) in enumerate(parts):
            region = region.when(v < F.lit(a), 2 * j).when(v <= F.lit(b), 2 * j + 1)
            before = parts[j - 1][1] if j else -math.inf
            low = low.when(v < F.lit(a), F.lit(before)).when(v <= F.lit(b), v)
        cells.append(F.struct(F.lit(i).alias("k"), F.when(v.isNotNull(), region.otherwise(2 * len(parts))).alias("r"),
                              low.otherwise(F.lit(parts[-1][1])).alias("v")))
    counts = (wide.select(F.explode(F.array(*cells)).alias("e")).select("e.*").filter("r IS NOT NULL")
              .groupBy("k", "r", "v").agg(F.count(F.lit(1)).alias("m"))).persist()
    cum = running_sum(counts, {"hi": F.col("m")}, "v", ["k"], rows_per_block=rows_per_block, tie_break=["r"])
    lists = F.create_map(*[x for i in spans for x in (F.lit(i), F.array(*[F.lit(int(r)) for r in ranks[i]]))])
    wanted = F.exists(F.element_at(lists, F.col("k")),
                      lambda r: (r >= F.col("hi") - F.col("m")) & (r < F.col("hi")))
    found = cum.filter((F.col("r") % 2 == 1) & wanted).collect()
    counts.unpersist()
    return {(r["k"], rank): r["v"] for r in found for rank in ranks[r["k"]] if r["hi"] - r["m"] <= rank < r["hi"]}


def medians_by(df: DataFrame, group: Column, value: Column, counts: dict, limit: int | None = None,
               rows_per_block: int | None = None) -> dict[object, tuple[float, float]]:
    """{group: the two middle values}, equal at an odd count; ``counts`` has the non-null values of every group.

    A row meets the bracket of its own group only, so the work does not grow with the number of groups.
    """
    names = list(counts)
    number = {g: i for i, g in enumerate(names)}
    known = [x for g, i in number.items() if g is not None for x in (F.lit(g), F.lit(i))]
    k = F.coalesce(F.element_at(F.create_map(*known), group) if known else F.lit(None), F.lit(number.get(None)).cast("int"))
    rows = df.select(k.cast("int").alias("k"), value.cast("double").alias("v")).filter("v IS NOT NULL")
    ranks = {i: sorted(set(_pair(0.5, counts[g]))) for g, i in number.items() if counts[g]}
    if not ranks:
        return {}
    spans = {i: WHOLE[0] for i in ranks}
    if max(counts.values()) > (LIMIT if limit is None else limit):
        eps = 3.0 / ACCURACY
        spans = {r["k"]: tuple(r["q"]) for r in rows.groupBy("k").agg(
            F.percentile_approx("v", [0.5 - eps, 0.5 + eps], ACCURACY).alias("q")).collect()}
    found = _middle(rows, spans, ranks, rows_per_block)
    # a sketch that missed a rank is rare; such groups are read without brackets
    missed = [i for i in ranks if any((i, r) not in found for r in ranks[i])]
    if missed:
        found.update(_middle(rows.filter(F.col("k").isin(missed)), {i: WHOLE[0] for i in missed}, ranks, rows_per_block))
    return {names[i]: (found[i, r[0]], found[i, r[-1]]) for i, r in ranks.items()}


def _middle(rows: DataFrame, spans: dict, ranks: dict, rows_per_block: int | None) -> dict[tuple[int, int], float]:
    """{(group, rank): value} for the ranks inside the span of their group; what lies outside is one row a side."""
    ends = F.create_map(*[x for i, (a, b) in spans.items() for x in (F.lit(i), F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")))])
    v, own = F.col("v"), rows.withColumn("s", F.element_at(ends, F.col("k")))
    a, b = F.col("s.a"), F.col("s.b")
    counts = own.select("k", F.when(v < a, 0).when(v <= b, 1).otherwise(2).alias("r"),
                        F.when(v < a, F.lit(-math.inf)).when(v <= b, v).otherwise(b).alias("v")).groupBy("k", "r", "v").agg(
        F.count(F.lit(1)).alias("m")).persist()
    cum = running_sum(counts, {"hi": F.col("m")}, "v", ["k"], rows_per_block=rows_per_block, tie_break=["r"])
    lists = F.create_map(*[x for i in spans for x in (F.lit(i), F.array(*[F.lit(int(r)) for r in ranks[i]]))])
    wanted = F.exists(F.element_at(lists, F.col("k")), lambda r: (r >= F.col("hi") - F.col("m")) & (r < F.col("hi")))
    found = cum.filter((F.col("r") == 1) & wanted).collect()
    counts.unpersist()
    return {(r["k"], rank): r["v"] for r in found for rank in ranks[r["k"]] if r["hi"] - r["m"] <= rank < r["hi"]}


def _pair(p: float, n: int) -> tuple[int, int]:
    pos = p * (n - 1)
    return math.floor(pos), math.ceil(pos)


def _brackets(wide, idx, probs):
    """Disjoint value ranges per column that should hold every wanted rank."""
    eps = 3.0 / ACCURACY
    points = sorted({min(1.0, max(0.0, p + s)) for p in probs for s in (-eps, eps)})
    row = wide.agg(*[
        F.struct(F.percentile_approx(f"q{i}", points, ACCURACY).alias("q"),
                 F.min(f"q{i}").alias("lo"), F.max(f"q{i}").alias("hi")).alias(f"q{i}")
        for i in idx]).first()
    spans = {}
    for k, i in enumerate(idx):
        at = dict(zip(points, row[k]["q"]))
        at[0.0], at[1.0] = row[k]["lo"], row[k]["hi"]
        spans[i] = _merge([(at[max(0.0, p - eps)], at[min(1.0, p + eps)]) for p in probs])
    return spans


def _rank(v: float) -> tuple[bool, float]:
    """Order of Spark: NaN above all numbers."""
    return v != v, 0.0 if v != v else v


def _merge(spans):
    out = []
    for a, b in sorted(spans, key=lambda s: (_rank(s[0]), _rank(s[1]))):
        if out and _rank(a) <= _rank(out[-1][1]):
            out[-1][1] = max(out[-1][1], b, key=_rank)
        else:
            out.append([a, b])
    return [tuple(s) for s in out]
