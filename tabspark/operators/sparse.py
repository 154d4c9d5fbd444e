"""One-hot encoding of any cardinality as one sparse vector column, and moments that read it.

The dictionary is a table, sorted and numbered in blocks and written once; a row
finds its places by one join for each encoded column, which Spark broadcasts
where the dictionary is small by its size on disk and splits at hot categories
where it is not. Names, places and moments stay tables; the driver holds one
count for each column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Estimator
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from tabspark.functions.scalar import dbl, ident
from tabspark.operators.encode import category_table
from tabspark.operators.fitted import Fitted, kind
from tabspark.operators.small import small_table
from tabspark.sources.io import scratch_dir

VECTOR = StructType([StructField("v", VectorUDT())])


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """A sparse vector of rising ``indices`` and their ``values``, without Python code."""
    parts = F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), indices.cast("array<int>").alias("indices"),
                     values.cast("array<double>").alias("values"))
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), VECTOR).getField("v")


class SparseOneHot(Estimator):
    """Indicators of sorted categories, the first of each column dropped, in one vector column.

    ``numerical`` columns take the first places of the vector, which replaces the
    read columns and any column of its name. Nulls and unknown
    categories have no place; a null number is 0, which a vector does not store.
    The fitted dictionary is (column, category, position, place) with a null place
    for the dropped category.
    """

    def __init__(self, columns: list[str], output: str = "encoded", numerical: list[str] = (),
                 rows_per_block: int | None = None):
        super().__init__()
        self.columns, self.output, self.numerical = list(columns), output, list(numerical)
        self.rows_per_block = rows_per_block

    def _fit(self, df: DataFrame) -> "SparseOneHotModel":
        spark, first, size = df.sparkSession, {}, len(self.numerical)
        table = None
        if self.columns:
            path = scratch_dir(spark, "categories")
            category_table(df, self.columns, self.rows_per_block).write.partitionBy("column").parquet(path)
            table = spark.read.schema("category string, position bigint, column string").parquet(path)
            counts = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
            for c in self.columns:
                first[c] = size
                size += max(counts.get(c, 0) - 1, 0)
        return SparseOneHotModel(table, first, size, self.output, self.numerical)


class SparseOneHotModel(Fitted):
    def __init__(self, table: DataFrame | None, first: dict[str, int], size: int, output: str, numerical: list[str]):
        super().__init__("sparse_one_hot", {"table": table, "first": first, "size": size, "output": output,
                                            "numerical": list(numerical)})

    @property
    def size(self) -> int:
        return self.state["size"]

    def names(self, spark: SparkSession) -> DataFrame:
        """(place, name) of every place of the vector."""
        s = self.state
        out = small_table(spark, list(enumerate(s["numerical"])), "place bigint, name string")
        if s["table"] is None:
            return out
        return out.unionByName(_places(s).filter("place IS NOT NULL").select(
            "place", F.concat_ws("_", "column", "category").alias("name")))


def _places(s: dict) -> DataFrame:
    start = reduce(lambda acc, item: F.when(F.col("column") == item[0], F.lit(item[1])).otherwise(acc),
                   s["first"].items(), F.lit(None).cast("bigint"))
    return s["table"].withColumn("place", F.when(F.col("position") > 0, start + F.col("position") - 1).cast("bigint"))


@kind("sparse_one_hot")
def _sparse_one_hot(df: DataFrame, s: dict) -> DataFrame:
    gone = {*s["first"], *s["numerical"]}
    own = [f"__place_{i}" for i in range(len(s["first"]))]
    out = df
    for name, c in zip(own, s["first"]):
        mine = _places(s).filter(F.col("column") == c).select(F.col("category").alias(f"{name}_key"), F.col("place").alias(name))
        out = out.join(mine, F.col(ident(c)).cast("string") == F.col(f"{name}_key"), "left")
    cells = [F.struct(F.lit(i).cast("bigint").alias("place"), dbl(c).alias("value")) for i, c in enumerate(s["numerical"])]
    cells += [F.struct(F.col(name).alias("place"), F.lit(1.0).alias("value")) for name in own]
    if cells:
        kept = F.filter(F.array(*cells), lambda e: e["place"].isNotNull() & (F.coalesce(e["value"], F.lit(0.0)) != 0))
        indices, values = F.transform(kept, lambda e: e["place"]), F.transform(kept, lambda e: e["value"])
    else:
        indices = values = F.array().cast("array<double>")
    keep = [F.col(ident(c)) for c in df.columns if c not in gone and c != s["output"]]
    return out.select(*keep, sparse_vector(s["size"], indices, values).alias(s["output"]))


def entries(vector: str) -> Column:
    """(place, value) of the stored entries of a vector that are not 0, read from its own fields."""
    body = F.from_json(F.get_json_object(F.to_json(F.struct(F.col(ident(vector)).alias("v"))), "$.v"),
                       "type int, size int, indices array<int>, values array<double>")
    dense = F.transform(body["values"], lambda v, i: F.struct(i.alias("place"), v.alias("value")))
    sparse = F.zip_with(body["indices"], body["values"], lambda i, v: F.struct(i.alias("place"), v.alias("value")))
    return F.filter(F.when(body["type"] == 0, sparse).otherwise(dense), lambda e: e["value"] != 0)


def sparse_moments(df: DataFrame, vector: str, target: str | None = None) -> DataFrame:
    """(i, j, n, v): sums of products of places i <= j over all rows, the pairs that occur together only.

    A row gives the pairs of its own stored entries, so the work is rows times the
    square of the encoded columns at any number of categories, and the sums combine
    before the one shuffle. Place -2 is 1 in every row, so (-2, -2) holds the rows and
    (-2, j) the plain sums; with a target, place -1 is the target.
    Rows with a null vector, or a null or NaN target, take no part.
    """
    rows = df.filter(F.col(ident(vector)).isNotNull())
    always = [F.struct(F.lit(-2).alias("place"), F.lit(1.0).alias("value"))]
    if target is not None:
        rows = rows.filter(dbl(target).isNotNull() & ~F.isnan(dbl(target)))
        always.append(F.struct(F.lit(-1).alias("place"), dbl(target).alias("value")))
    cells = rows.select(F.concat(F.array(*always), entries(vector)).alias("e"))
    pairs = F.flatten(F.transform("e", lambda a, k: F.transform(
        F.slice(F.col("e"), k + 1, F.size("e")),
        lambda b: F.struct(a["place"].alias("i"), b["place"].alias("j"), (a["value"] * b["value"]).alias("v")))))
    return (cells.select(F.explode(pairs).alias("p")).groupBy("p.i", "p.j")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("p.v").alias("v")))


def correlated_places(moments: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(i, j, r), i < j, of all places whose correlation is at least ``threshold`` in size.

    Places that occur together have an entry in ``moments``. Of two that never do, with
    u = sum^2 / (rows * sum of squares), r is -sqrt(u u' / ((1 - u)(1 - u'))), so one has
    u >= threshold / (1 + threshold); as u is at most the place's share of the rows, at most
    (1 + threshold) / threshold places for each encoded column have it, and these are met
    with all others. Places without variance have no correlation.
    """
    if not 0 < threshold <= 1:
        raise ValueError(f"threshold {threshold} is not in (0, 1]")
    total = moments.filter("i = -2 AND j = -2").first()
    n = float(total["v"]) if total else 0.0
    one = moments.filter("i = -2 AND j >= 0").select(F.col("j").alias("k"), F.col("v").alias("s"))
    square = moments.filter("i = j AND i >= 0").select(F.col("i").alias("k"), F.col("v").alias("q"))
    stats = one.join(square, "k").withColumn("w", F.lit(n) * F.col("q") - F.col("s") * F.col("s")).filter("w > 0")
    together = moments.filter("i >= 0 AND i < j").select("i", "j", F.col("v").alias("p"))

    least = threshold / (1 + threshold) * (1 - 1e-12)
    heavy = stats.filter(F.col("s") * F.col("s") >= F.lit(least * n) * F.col("q")).select("k").collect()
    apart = stats.select("k", F.explode(F.array(*[F.lit(r["k"]) for r in heavy]).cast("array<int>")).alias("o")).filter("k <> o")
    apart = apart.select(F.least("k", "o").alias("i"), F.greatest("k", "o").alias("j")).distinct()
    pairs = together.unionByName(apart.join(together, ["i", "j"], "left_anti").withColumn("p", F.lit(0.0)))

    left, right = (stats.select(F.col("k").alias(x), F.col("s").alias(f"s{x}"), F.col("w").alias(f"w{x}")) for x in "ij")
    r = (F.lit(n) * F.col("p") - F.col("si") * F.col("sj")) / (F.sqrt("wi") * F.sqrt("wj"))
    return pairs.join(left, "i").join(right, "j").select("i", "j", r.alias("r")).filter(F.abs("r") >= threshold - 1e-12)
