"""Skew-aware preprocessing as saveable pipelines, and training-table preparation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, functions as F

from tabspark.functions.scalar import ident
from tabspark.operators.encode import OneHot
from tabspark.operators.gram import correlated_columns
from tabspark.operators.profile import assert_no_missing, low_variance_columns
from tabspark.operators.project import drop_columns, map_values
from tabspark.operators.roles import infer_roles
from tabspark.operators.select import skew_sets
from tabspark.operators.sparse import SparseOneHot, correlated_places, sparse_moments
from tabspark.operators.split import hash_split, stratified_split
from tabspark.operators.transforms import Scaler
from tabspark.sources.io import scratch_dir


def _select(items: list[tuple[str, str]]) -> SQLTransformer:
    cols = ", ".join(f"{sql} AS {ident(name)}" for sql, name in items)
    return SQLTransformer(statement=f"SELECT {cols} FROM __THIS__")


def fit_preprocess(df: DataFrame, keep: list[str], drop: list[str] = (), scaler: str | None = "standard",
                   skew_transformer: str | None = "yeo-johnson", scale_all: bool = False,
                   variance_threshold: float | None = None, **role_flags) -> PipelineModel:
    """Drop columns, power-transform the skewed ones, scale, optionally prune constant ones.

    ``scale_all`` also scales the categorical columns.  With
    ``skew_transformer=None`` the columns are not split by role at all.
    """
    stages: list[SQLTransformer] = []
    work = drop_columns(df, [c for c in drop if c in df.columns])
    inputs = [c for c in work.columns if c not in keep]
    passed = [(ident(c), c) for c in keep]

    def push(items):
        nonlocal work
        stage = _select(passed + items)
        stages.append(stage)
        work = stage.transform(work)
        return [name for _, name in items]

    if skew_transformer is None:
        names = push([(f"CAST({ident(c)} AS DOUBLE)", c) for c in inputs])
        scaled = names
    else:
        roles = infer_roles(work.select(*map(ident, inputs)), **role_flags)
        skewed, plain, _ = skew_sets(work, list(roles.numerical))
        items = [(ident(c), f"categorical__{c}") for c in roles.categorical]
        items += [(f"CAST({ident(c)} AS DOUBLE)", f"numerical__non_skewed__{c}") for c in plain]
        if skewed:
            power = Scaler(skew_transformer, skewed).fit(work)
            items += [(power.forward_sql(c), f"numerical__skewed__{c}") for c in skewed]
        names = push(items)
        scaled = names if scale_all else [c for c in names if c.startswith("numerical__")]
    if scaler and scaled:
        model = Scaler(scaler, scaled).fit(work)
        names = push([(model.forward_sql(c) if c in scaled else ident(c), c) for c in names])
    if variance_threshold is not None:
        low = set(low_variance_columns(work, names, variance_threshold))
        push([(ident(c), c) for c in names if c not in low])
    return PipelineModel(stages)


def preprocess_v1(df: DataFrame, keep: list[str], drop: list[str] = (), scaler: str | None = "standard",
                  **role_flags) -> PipelineModel:
    """Categorical columns pass through; numerical ones are unskewed, then scaled."""
    return fit_preprocess(df, keep, drop, scaler, **role_flags)


def preprocess_v2(df: DataFrame, keep: list[str], drop: list[str] = (), scaler: str | None = "standard",
                  skew_transformer: str | None = "yeo-johnson", **role_flags) -> PipelineModel:
    """Scaling over every column, then a variance threshold of 0.01."""
    return fit_preprocess(df, keep, drop, scaler, skew_transformer, scale_all=True,
                          variance_threshold=0.01, **role_flags)


def extend_pipeline(base: Pipeline, *stages) -> Pipeline:
    return Pipeline(stages=[*base.getStages(), *stages])


def prepare_train(df: DataFrame, target: str, key: str = "row_id", remove: list[str] = (),
                  threshold: float = 0.9, prune: bool = True, encode_first: bool = True,
                  target_mapping: dict | None = None, test_size: float = 0.2, seed: int = 42,
                  stratify: bool = False, sparse: bool = False, **role_flags):
    """Drop, check nulls, encode, find correlated columns, map the target, split.

    Returns (table with a split column, encoder, correlated columns).  The flagged
    columns stay in the table when encoding comes first; otherwise the un-encoded
    table loses them before encoding.  With ``sparse`` the inputs become the one
    vector column ``encoded`` at any number of categories, and the correlated
    places are a table (place, name), of which only un-encoded columns can be lost.
    """
    df = drop_columns(df, [c for c in remove if c in df.columns])
    assert_no_missing(df)
    inputs = [c for c in df.columns if c not in (key, target)]
    roles = infer_roles(df.select(*map(ident, inputs)), **role_flags)
    if sparse:
        encoded, encoder, flagged = _sparse_inputs(df, list(roles.categorical), inputs, threshold, prune)
        if not encode_first and prune:
            plain = [c for c in inputs if c not in roles.categorical]
            lost = {r["name"] for r in flagged.filter(F.col("name").isin(plain)).collect()}
            if lost:
                kept = [c for c in inputs if c not in lost]
                encoded, encoder, _ = _sparse_inputs(df.drop(*lost), list(roles.categorical), kept, threshold, False)
        return _mapped_split(encoded, target, key, target_mapping, test_size, seed, stratify), encoder, flagged
    encoder = OneHot(list(roles.categorical)).fit(df)
    encoded = encoder.transform(df)
    flagged: list[str] = []
    if prune:
        cols = [c for c in encoded.columns if c not in (key, target)]
        flagged = [r["column"] for r in correlated_columns(encoded, cols, threshold).collect()]
    if not encode_first and flagged:
        df = df.drop(*[c for c in flagged if c in df.columns])
        encoder = OneHot([c for c in roles.categorical if c in df.columns]).fit(df)
        encoded = encoder.transform(df)
    return _mapped_split(encoded, target, key, target_mapping, test_size, seed, stratify), encoder, flagged


def _mapped_split(encoded: DataFrame, target: str, key: str, target_mapping: dict | None, test_size: float, seed: int,
                  stratify: bool) -> DataFrame:
    if target_mapping:
        encoded = map_values(encoded, target, target_mapping)
    return stratified_split(encoded, target, key, test_size, seed) if stratify else hash_split(encoded, key, test_size, seed)


def _sparse_inputs(df: DataFrame, categorical: list[str], inputs: list[str], threshold: float, prune: bool):
    """The table with its inputs in one vector, the encoder and the (place, name) a greater place is correlated with."""
    encoder = SparseOneHot(categorical, numerical=[c for c in inputs if c not in categorical]).fit(df)
    encoded, names = encoder.transform(df), encoder.names(df.sparkSession)
    if not prune:
        return encoded, encoder, names.limit(0)
    path = scratch_dir(df.sparkSession, "moments")
    sparse_moments(encoded, "encoded").write.parquet(path)
    pairs = correlated_places(df.sparkSession.read.parquet(path), threshold)
    return encoded, encoder, pairs.select(F.col("j").cast("bigint").alias("place")).distinct().join(names, "place")
