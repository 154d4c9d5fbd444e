from tabspark.operators.encode import OneHot
from tabspark.streaming import score_stream


def test_fitted_projection_runs_on_a_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "row_id long, c string")
    src = str(tmp_path / "in")
    df.write.parquet(src)
    model = OneHot(["c"]).fit(df)
    q = score_stream(spark, src, df.schema, model, str(tmp_path / "ck"), str(tmp_path / "out"))
    q.awaitTermination(60)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("row_id").collect()
    assert [tuple(r) for r in got] == [(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 0.0, 1.0)]
