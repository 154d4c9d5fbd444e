"""Fitted models and steps as data: a Spark ML model of a kind and its state, saved as JSON and Parquet."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml import Model, PipelineModel
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame

from tabspark.operators.small import small_table

#: How each kind adds its columns to a table: a function of (table, state).
KINDS: dict[str, Callable[[DataFrame, dict], DataFrame]] = {}
#: Values of an array in one row of a saved table.
VALUES = 100_000
MARK = "$"


def kind(name: str):
    def add(fn):
        KINDS[name] = fn
        return fn
    return add


class Fitted(Model, MLWritable, MLReadable):
    """A fitted model or step.

    ``state`` holds what the transform needs: JSON values, NumPy arrays, tables, Spark
    pipelines and other fitted models. ``info`` is for the caller and is not saved. A function instead of
    a kind makes a model of the user's own, which cannot be saved.
    """

    def __init__(self, kind: str | Callable[[DataFrame], DataFrame], state: dict | None = None, info: dict | None = None):
        super().__init__()
        if callable(kind):
            kind, state = "function", {"add": kind}
        if kind not in KINDS:
            raise ValueError(f"unknown kind {kind!r}")
        self.kind, self.state, self.info = kind, dict(state or {}), dict(info or {})

    def _transform(self, df: DataFrame) -> DataFrame:
        return KINDS[self.kind](df, self.state)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


@kind("function")
def _function(df, s):
    return s["add"](df)


@kind("sequence")
def _sequence(df, s):
    """Fitted models one after another."""
    for stage in s["stages"]:
        df = stage.transform(df)
    return df


class _Writer(MLWriter):
    def __init__(self, model: Fitted):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        parts: dict[str, list] = {"array": [], "table": [], "model": []}

        def plain(v):
            if isinstance(v, np.ndarray):
                parts["array"].append(v)
                return {MARK: "array", "at": len(parts["array"]) - 1}
            if isinstance(v, DataFrame):
                parts["table"].append(v)
                return {MARK: "table", "at": len(parts["table"]) - 1}
            if isinstance(v, MLWritable):
                parts["model"].append(v)
                return {MARK: "spark" if isinstance(v, PipelineModel) else "model", "at": len(parts["model"]) - 1}
            if isinstance(v, dict):
                if any(not isinstance(k, str) for k in v) or MARK in v:
                    return {MARK: "items", "at": [[plain(k), plain(x)] for k, x in v.items()]}
                return {k: plain(x) for k, x in v.items()}
            if isinstance(v, tuple):
                return {MARK: "tuple", "at": [plain(x) for x in v]}
            if isinstance(v, list):
                return [plain(x) for x in v]
            if isinstance(v, np.generic):
                return v.item()
            if v is None or isinstance(v, (str, int, float, bool)):
                return v
            raise ValueError(f"a {self.model.kind} model with a {type(v).__name__} cannot be saved")

        state = plain(self.model.state)
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata={"kind": self.model.kind, "state": state})
        if parts["array"]:
            rows = [(i, at, a.dtype.str, list(a.shape), [float(x) for x in a.ravel()[at:at + VALUES]])
                    for i, a in enumerate(parts["array"]) for at in range(0, max(a.size, 1), VALUES)]
            small_table(spark, rows, "id int, first bigint, type string, shape array<bigint>, v array<double>").write.parquet(f"{path}/arrays")
        for i, t in enumerate(parts["table"]):
            t.write.parquet(f"{path}/table_{i}")
        for i, m in enumerate(parts["model"]):
            m.write().save(f"{path}/model_{i}")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> Fitted:
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        arrays: dict[int, np.ndarray] = {}

        def read_arrays():
            rows = sorted(spark.read.parquet(f"{path}/arrays").collect(), key=lambda r: (r["id"], r["first"]))
            for i in {r["id"] for r in rows}:
                own = [r for r in rows if r["id"] == i]
                values = np.array([x for r in own for x in r["v"]])
                arrays[i] = values.astype(np.dtype(own[0]["type"])).reshape(own[0]["shape"])

        def whole(v):
            if isinstance(v, list):
                return [whole(x) for x in v]
            if not isinstance(v, dict):
                return v
            if MARK not in v:
                return {k: whole(x) for k, x in v.items()}
            what, at = v[MARK], v["at"]
            if what == "array":
                if not arrays:
                    read_arrays()
                return arrays[at]
            if what == "table":
                return spark.read.parquet(f"{path}/table_{at}")
            if what == "spark":
                return PipelineModel.load(f"{path}/model_{at}")
            if what == "model":
                return DefaultParamsReader.loadParamsInstance(f"{path}/model_{at}", spark)
            return tuple(map(whole, at)) if what == "tuple" else {whole(k): whole(x) for k, x in at}

        # the kinds register where their fits live
        from tabspark.operators import models, pipelines, sparse, twopart  # noqa: F401

        model = self.cls.__new__(self.cls)
        Model.__init__(model)
        model.kind, model.state, model.info = meta["kind"], whole(meta["state"]), {}
        return model._resetUid(meta["uid"])


def load(path: str) -> Fitted:
    """A saved model of any class."""
    from pyspark.sql import SparkSession

    return DefaultParamsReader.loadParamsInstance(path, SparkSession.active())
