"""Driver results (fits, p x p matrices) as tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A local relation: no tasks are needed to produce its rows."""
    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    cols = list(zip(*rows)) if rows else [[] for _ in arrow]
    return spark.createDataFrame(
        pa.table([pa.array(list(c), f.type) for c, f in zip(cols, arrow)], schema=arrow), struct)
