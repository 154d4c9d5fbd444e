"""Mutual information of numeric features with a class, by nearest neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabspark.functions.scalar import dbl, digamma, ident
from tabspark.operators.ordered import ranked, running_sum
from tabspark.operators.small import small_table

ROWS_PER_BLOCK = 1_000_000
CELL = ["feature", "class"]


def _points(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Distinct (feature, class, x) with the number of rows ``w``, and ``size``, the rows of the class.

    A row without the class, or with a null or NaN feature, takes no part for this
    feature; a class of one row has no neighbour and takes no part.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), dbl(c).alias("x")) for c in features]))
    long = df.select(F.col(ident(target)).cast("string").alias("class"), cells.alias("e")).select("class", "e.feature", "e.x")
    counted = (long.filter(F.col("class").isNotNull() & F.col("x").isNotNull() & ~F.isnan("x"))
               .groupBy(*CELL, "x").agg(F.count(F.lit(1)).alias("w")))
    sizes = counted.groupBy(*CELL).agg(F.sum("w").alias("size"), F.min("x").alias("least"), F.max("x").alias("most"))
    return counted.join(sizes.filter("size > 1"), CELL)


def _with_reach(points: DataFrame, k: int, rows_per_block: int) -> DataFrame:
    """``lo`` and ``hi``: the open interval around x that ends at its k-th nearest row of the class;
    ``own``, the rows of the class in it.

    The distinct values of a class are numbered and cut into blocks of equal length; a
    block also gets the k values on either side, so a window inside it sees
    every neighbour. ``lo = hi = x`` where k more rows have the same value.
    """
    numbered = ranked(points, "i", "x", CELL, rows_per_block=rows_per_block)
    size = max(rows_per_block, k + 1)
    own, at = F.floor((F.col("i") - 1) / size), (F.col("i") - 1) % size
    blocks = F.array_compact(F.array(own, F.when(at < k, own - 1), F.when(at >= size - k, own + 1)))
    spread = numbered.withColumn("own", own).withColumn("block", F.explode(blocks)).filter("block >= 0")
    w = Window.partitionBy(*CELL, "block").orderBy("x")
    sides = {}
    for step in range(1, k + 1):
        sides |= {f"x_{step}": F.lag("x", step).over(w), f"w_{step}": F.lag("w", step).over(w),
                  f"x{step}": F.lead("x", step).over(w), f"w{step}": F.lead("w", step).over(w)}
    near = spread.withColumns(sides).filter("block = own")
    x = F.col("x")

    def reach(a: int, b: int) -> Column:
        """The distance that covers a values on the left and b on the right, if they hold k other rows."""
        rows = sum((F.col(f"w_{s}") for s in range(1, a + 1)), F.col("w") - 1) + sum((F.col(f"w{s}") for s in range(1, b + 1)), F.lit(0))
        ends = [x - F.col(f"x_{a}")] * (a > 0) + [F.col(f"x{b}") - x] * (b > 0)
        return F.when(rows >= k, F.greatest(F.lit(0.0), *ends) if ends else F.lit(0.0))

    within = F.least(F.lit(None).cast("double"), *[reach(a, b) for a in range(k + 1) for b in range(k + 1 - a)])
    # a class of at most k rows: its farthest row
    near = near.withColumn("r", F.when(F.col("size") <= k, F.greatest(x - F.col("least"), F.col("most") - x)).otherwise(within))
    # an end that is a value of the class is taken as it is, without rounding
    left = F.greatest(F.lit(None).cast("double"), *[F.when(x - F.col(f"x_{s}") == F.col("r"), F.col(f"x_{s}")) for s in range(1, k + 1)])
    right = F.least(F.lit(None).cast("double"), *[F.when(F.col(f"x{s}") - x == F.col("r"), F.col(f"x{s}")) for s in range(1, k + 1)])
    near = near.withColumns({"lo": F.when(F.col("r") == 0, x).otherwise(F.coalesce(left, x - F.col("r"))),
                             "hi": F.when(F.col("r") == 0, x).otherwise(F.coalesce(right, x + F.col("r")))})
    inside = [F.when(F.col(f"x_{s}") > F.col("lo"), F.col(f"w_{s}")) for s in range(1, k + 1)]
    inside += [F.when(F.col(f"x{s}") < F.col("hi"), F.col(f"w{s}")) for s in range(1, k + 1)]
    own_rows = sum((F.coalesce(c, F.lit(0)) for c in inside), F.col("w"))
    return near.select(*CELL, "x", "w", "size", own_rows.alias("own"), "lo", "hi")


def _rows_inside(reached: DataFrame, rows_per_block: int) -> DataFrame:
    """``m`` per (feature, class, x): rows of all classes inside the interval.

    Values and interval ends are merged into one order per feature; a running count
    of rows is read at both ends.
    """
    same = F.col("lo") == F.col("hi")
    # at an equal place ends with turn 0 stand before the values (turn 1), those with turn 2 behind
    low = F.struct(F.col("lo").alias("at"), F.when(same, 0).otherwise(2).alias("turn"), F.lit(-1).alias("sign"))
    high = F.struct(F.col("hi").alias("at"), F.when(same, 2).otherwise(0).alias("turn"), F.lit(1).alias("sign"))
    ends = (reached.select(*CELL, "x", "w", "size", "own", F.explode(F.array(low, high)).alias("e"))
            .select(*CELL, "x", "w", "size", "own", "e.*", F.lit(0).cast("bigint").alias("add")))
    values = reached.groupBy("feature", "x").agg(F.sum("w").alias("add")).select(
        "feature", F.col("x").alias("at"), F.lit(1).alias("turn"), "add")
    merged = ends.unionByName(values, allowMissingColumns=True)
    run = running_sum(merged, {"below": F.col("add")}, "at", ["feature"], rows_per_block=rows_per_block, tie_break=["turn"])
    return (run.filter("turn <> 1").groupBy(*CELL, "x", "w", "size", "own").agg(F.sum(F.col("sign") * F.col("below")).alias("m")))


def neighbour_information(df: DataFrame, features: list[str], target: str, k: int = 3,
                          rows_per_block: int | None = None) -> DataFrame:
    """(feature, score): mutual information in nats of each feature with a class.

    For a row in a class of n_c rows, k' and m are the rows of its class and of all classes
    (itself among both) that are nearer than its min(k, n_c - 1)-th nearest row of the class;
    where that one has the same value, those with the same value. The score is
    psi(n) + mean of psi(k') - psi(n_c) - psi(m), zero at least. Without ties k' is
    min(k, n_c - 1). Features need no scale, and no noise is added to break ties. Rows
    without the class, and for a feature those where it is null or NaN, take no part; nor do
    classes of one row. A feature without any pair of rows in a class has score 0.

    Equal values are one row with a count before anything is sorted. All is windows over
    blocks of about ``rows_per_block`` values; no window covers a class or a feature. The
    counted values and their intervals are persisted, so the table is read once; one row
    per feature comes to the driver.
    """
    if k < 1:
        raise ValueError("k must be 1 at least")
    size = rows_per_block or ROWS_PER_BLOCK
    points = _points(df, features, target).persist()
    reached = _with_reach(points, k, size).persist()
    try:
        w, n = F.col("w"), F.sum("w")
        term = digamma(F.col("own")) - digamma(F.col("size")) - digamma(F.col("m"))
        score = F.greatest(F.lit(0.0), digamma(n) + F.sum(w * term) / n)
        found = {r["feature"]: r["score"] for r in _rows_inside(reached, size).groupBy("feature").agg(score.alias("score")).collect()}
    finally:
        reached.unpersist()
        points.unpersist()
    return small_table(df.sparkSession, [(c, float(found.get(c, 0.0))) for c in dict.fromkeys(features)], "feature string, score double")
