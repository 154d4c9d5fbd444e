"""Scorers as aggregates: several metrics of many predictions from one pass."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tabspark.functions.scalar import ident


@dataclass(frozen=True)
class Scorer:
    """A metric from aggregates, as SQL text, over the columns ``y``, ``prediction`` and ``score``.

    ``value`` takes their results by name and gives the number; ``minimise`` says which way is better.
    """

    name: str
    aggregates: dict[str, str]
    value: Callable[[dict], float | None]
    minimise: bool = False


CELLS = {name: f"count_if(y = {y} AND prediction = {p})" for name, y, p in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))}


def _ratio(a: float, b: float) -> float | None:
    return a / b if b else None


def cost_gain(tp: float = 0.0, fp: float = -1.0, fn: float = -1.0, tn: float = 0.0, name: str = "cost_gain") -> Scorer:
    """Gain summed over rows by the cell of the confusion matrix a row falls into."""
    return Scorer(name, CELLS, lambda c: tp * c["tp"] + fp * c["fp"] + fn * c["fn"] + tn * c["tn"])


FALSE_POSITIVE_RATE = Scorer("fpr", CELLS, lambda c: _ratio(c["fp"], c["fp"] + c["tn"]), minimise=True)
POSITIVE_PRECISION = Scorer("positive_precision", CELLS, lambda c: _ratio(c["tp"], c["tp"] + c["fp"]))
POSITIVE_RECALL = Scorer("positive_recall", CELLS, lambda c: _ratio(c["tp"], c["tp"] + c["fn"]))


def scores_by(df: DataFrame, label: str, by: str, scorers: list[Scorer]) -> list[tuple[str, str, float]]:
    """(group, metric, value) of every scorer in one aggregate; aggregates that scorers share are computed once."""
    if not scorers:
        return []
    texts = list(dict.fromkeys(c for s in scorers for c in s.aggregates.values()))
    base = df.withColumn("y", F.col(ident(label)).cast("double"))
    out = []
    for r in base.groupBy(F.col(ident(by)).alias("g")).agg(*[F.expr(c).alias(f"a{i}") for i, c in enumerate(texts)]).collect():
        for s in scorers:
            v = s.value({a: r[f"a{texts.index(c)}"] for a, c in s.aggregates.items()})
            out.append((r["g"], s.name, math.nan if v is None else float(v)))
    return out
