"""Column roles by dtype, value pattern and cardinality."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F, types as T

from tabspark.functions.scalar import ident
from tabspark.operators.small import small_table

ROLE_SCHEMA = "column string, role string, reason string, n_distinct bigint"


@dataclass(frozen=True)
class Roles:
    categorical: tuple[str, ...]
    numerical: tuple[str, ...]

    def restricted_to(self, columns: list[str]) -> "Roles":
        keep = set(columns)
        return Roles(tuple(c for c in self.categorical if c in keep),
                     tuple(c for c in self.numerical if c in keep))


def _kind(t: T.DataType) -> str:
    if isinstance(t, T.IntegralType):
        return "int"
    if isinstance(t, (T.FractionalType, T.DecimalType)):
        return "float"
    if isinstance(t, T.BooleanType):
        return "bool"
    if isinstance(t, T.StringType):
        return "string"
    raise TypeError(f"no role for type {t.simpleString()}")


def role_statistics(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> tuple[dict, dict]:
    """(column kinds, statistics) from one aggregate over the table.

    Distinct counts are needed, and computed, for integral columns only.
    ``exact=False`` counts them with a sketch instead of a shuffle of the values.
    """
    kinds = {f.name: _kind(f.dataType) for f in df.schema if columns is None or f.name in columns}
    distinct = F.count_distinct if exact else (lambda c: F.approx_count_distinct(c, 0.01))
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, (c, kind) in enumerate(kinds.items()):
        col = F.col(ident(c))
        if kind == "int":
            aggs += [F.min(col).alias(f"lo{i}"), F.max(col).alias(f"hi{i}"),
                     distinct(col).alias(f"nd{i}")]
        elif kind == "float":
            aggs += [F.min(col).alias(f"lo{i}"), F.max(col).alias(f"hi{i}"),
                     F.count_if((col != 0) & (col != 1)).alias(f"off{i}")]
        elif kind == "bool":
            aggs += [F.min(col).alias(f"lo{i}"), F.max(col).alias(f"hi{i}")]
    return kinds, df.agg(*aggs).first().asDict()


def apply_rules(
    kinds: dict,
    s: dict,
    dummy_is_categorical: bool = True,
    consecutive_is_categorical: bool = True,
    low_unique_is_categorical: bool = True,
    max_unique_ratio: float = 0.001,
) -> list[tuple[str, str, str, int | None]]:
    """(column, role, reason, n_distinct) per column."""
    out = []
    for i, (c, kind) in enumerate(kinds.items()):
        if kind == "string":
            out.append((c, "categorical", "string", None))
            continue
        lo, hi = s[f"lo{i}"], s[f"hi{i}"]
        nd = s.get(f"nd{i}")
        binary = lo == 0 and hi == 1 and (
            kind == "bool" or (kind == "int" and nd == 2) or (kind == "float" and s[f"off{i}"] == 0))
        if binary:
            role, reason = ("categorical" if dummy_is_categorical else "numerical"), "binary"
        elif kind == "bool":
            role, reason = "categorical", "boolean"
        elif (kind == "int" and consecutive_is_categorical and nd > 1 and lo in (0, 1)
              and hi - lo + 1 == nd):
            role, reason = "categorical", "consecutive"
        else:
            role, reason = "numerical", "numeric"
        if (low_unique_is_categorical and kind == "int" and role == "numerical" and s["n"] > 0
                and nd / s["n"] <= max_unique_ratio):
            role, reason = "categorical", "low_cardinality"
        out.append((c, role, reason, nd))
    return out


def role_rows(df: DataFrame, columns: list[str] | None = None, exact: bool = True, **rules):
    return apply_rules(*role_statistics(df, columns, exact), **rules)


def column_roles(df: DataFrame, **flags) -> DataFrame:
    return small_table(df.sparkSession, role_rows(df, **flags), ROLE_SCHEMA)


def infer_roles(df: DataFrame, **flags) -> Roles:
    rows = role_rows(df, **flags)
    roles = Roles(tuple(r[0] for r in rows if r[1] == "categorical"),
                  tuple(r[0] for r in rows if r[1] == "numerical"))
    assert not set(roles.categorical) & set(roles.numerical)
    return roles


def likely_categorical(df: DataFrame, max_unique_ratio: float = 0.001, exact: bool = True) -> DataFrame:
    """Integral columns with their distinct ratio and the low-cardinality flag."""
    cols = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    distinct = F.count_distinct if exact else (lambda c: F.approx_count_distinct(c, 0.01))
    ratio = lambda nd: nd / F.count(F.lit(1))
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), distinct(F.col(ident(c))).alias("n_distinct"),
                 ratio(distinct(F.col(ident(c)))).alias("ratio"),
                 F.when(ratio(distinct(F.col(ident(c)))) <= max_unique_ratio, 1).otherwise(0)
                 .cast("bigint").alias("flag"))
        for c in cols])
    return df.agg(rows.alias("r")).select(F.inline("r"))


@dataclass(frozen=True)
class TabularDataset:
    """A table, its roles and the transforms already applied; never mutated."""

    df: DataFrame
    roles: Roles
    target: str | None = None
    key: str = "row_id"
    encoder: object | None = None
    transforms: tuple[tuple[str, object], ...] = ()

    @classmethod
    def of(cls, df: DataFrame, target: str | None = None, key: str = "row_id", **flags) -> "TabularDataset":
        cols = [c for c in df.columns if c not in (key, target)]
        return cls(df, infer_roles(df.select(*map(ident, cols)), **flags), target, key)

    def drop(self, *columns: str) -> "TabularDataset":
        kept = [c for c in self.df.columns if c not in columns]
        return replace(self, df=self.df.select(*map(ident, kept)), roles=self.roles.restricted_to(kept))

    def without_target(self) -> DataFrame:
        return self.df.drop(self.target) if self.target else self.df

    def encode_categorical(self, omit: tuple[str, ...] = ()) -> "TabularDataset":
        """One-hot the categorical columns once; a second call changes nothing."""
        from tabspark.operators.encode import OneHot

        if self.encoder is not None:
            return self
        cols = [c for c in self.roles.categorical if c not in omit]
        model = OneHot(cols).fit(self.df)
        made = tuple(model.output_columns)
        kept = tuple(c for c in self.roles.categorical if c in omit)
        return replace(self, df=model.transform(self.df), encoder=model,
                       roles=Roles(kept + made, self.roles.numerical))

    def transform_numerical(self, method: str, omit: tuple[str, ...] = ()) -> "TabularDataset":
        """Transform the numerical columns that have no transform yet, never the target."""
        from tabspark.operators.transforms import Scaler

        done = {c for cols, _ in self.transforms for c in cols.split("\x1f")}
        cols = [c for c in self.roles.numerical if c not in omit and c not in done]
        if not cols:
            raise ValueError("every numerical column already has a transform")
        model = Scaler(method, cols).fit(self.df)
        return replace(self, df=model.transform(self.df),
                       transforms=self.transforms + (("\x1f".join(cols), model),))

    def apply_transform(self, column: str, method: str) -> "TabularDataset":
        if column == self.target:
            raise ValueError("the target is not transformed in place")
        if any(column in cols.split("\x1f") for cols, _ in self.transforms):
            raise ValueError(f"{column} already has a transform")
        from tabspark.operators.transforms import Scaler

        model = Scaler(method, [column]).fit(self.df)
        return replace(self, df=model.transform(self.df), transforms=self.transforms + ((column, model),))

    def inverse_transform(self) -> DataFrame:
        df = self.df
        for _, model in reversed(self.transforms):
            df = model.inverse(df)
        return df

    def describe(self) -> DataFrame:
        from tabspark.operators.profile import describe_columns

        return describe_columns(self.df, self.roles)

    def __str__(self) -> str:
        return (f"TabularDataset({len(self.df.columns)} columns, categorical={list(self.roles.categorical)}, "
                f"numerical={list(self.roles.numerical)}, target={self.target})")
