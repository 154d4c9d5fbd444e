"""Table scans, prediction sinks and a named-table store."""

from __future__ import annotations

import logging
import uuid

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tabspark.functions.scalar import ident

log = logging.getLogger(__name__)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``; without that setting, under the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header; without a schema the types are inferred (an extra pass)."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.when(~F.isnan(ident(c)), F.col(ident(c)))
                           for c, t in df.dtypes if t in ("double", "float")})


def prediction_path(root: str, team: str, split: str, task: str) -> str:
    return f"{root.rstrip('/')}/{team}__{split}__{'reg' if task == 'regression' else 'clf'}_pred"


def write_predictions(df: DataFrame, root: str, team: str, split: str, task: str, key: str = "row_id") -> str:
    path = prediction_path(root, team, split, task)
    df.select(ident(key), "prediction").write.mode("overwrite").parquet(path)
    return path


def save_object(obj: DataFrame | Model, path: str, overwrite: bool = True) -> None:
    """Persist a table, a fitted model of the catalogue or a fitted pipeline; ``overwrite=False`` keeps what is there."""
    if isinstance(obj, DataFrame):
        obj.write.mode("overwrite" if overwrite else "ignore").parquet(path)
    elif overwrite or not path_exists(path):
        obj.write().overwrite().save(path)


def path_exists(path: str) -> bool:
    spark = SparkSession.active()
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def load_table(spark: SparkSession, path: str, missing: str = "none") -> DataFrame | None:
    """Stored table; a missing one gives None, a warning or an error."""
    if not path_exists(path):
        if missing == "error":
            raise FileNotFoundError(path)
        if missing == "warn":
            log.warning("not found: %s", path)
        return None
    return spark.read.parquet(path)


def load_model(path: str) -> Model:
    """A saved model or pipeline, of whatever class it is."""
    from tabspark.operators.fitted import load

    return load(path)


def to_json(value: Column) -> Column:
    return F.to_json(value)


def json_field(text: Column, schema: str, field: str) -> Column:
    """Parse, write back as JSON and parse again: the value must survive the round trip."""
    parsed = F.from_json(text, schema)
    return F.from_json(F.to_json(parsed), schema).getField(field)
