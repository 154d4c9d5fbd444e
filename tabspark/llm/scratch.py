"""Tables written to the shared scratch folder, so that long jobs restart from storage and not from lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabspark.sources.io import scratch_dir


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: later steps reread it, so a lost executor costs no recomputation."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove the files behind tables that :func:`cut` wrote and nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for df in tables:
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
