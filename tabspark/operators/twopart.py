"""Two-part models for zero-inflated targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.scalar import dbl, ident
from tabspark.operators.fitted import Fitted, kind
from tabspark.operators.models import estimator

# Estimators a hurdle model accepts, by part.
HURDLE_PARTS = (
    "LinearRegression", "LogisticRegression", "LGBMRegressor", "LGBMClassifier",
    "GradientBoostingRegressor", "TweedieRegressor", "XGBRegressor", "PassiveAggressiveRegressor",
    "SVR", "SVC", "LinearSVR", "LinearSVC", "Ridge", "Lasso",
)
HURDLE_DEFAULTS = {n: {"n_estimators": 50} for n in ("LGBMRegressor", "LGBMClassifier", "GradientBoostingRegressor")}


class HurdleRegression:
    """A classifier for y > 0 and a regressor fitted on the positive rows."""

    def __init__(self, features: list[str], label: str, clf_name: str = "LogisticRegression",
                 reg_name: str = "LinearRegression", clf_params: dict | None = None,
                 reg_params: dict | None = None):
        for name in (clf_name, reg_name):
            if name not in HURDLE_PARTS:
                raise ValueError(f"estimator {name} not supported: choose from {HURDLE_PARTS}")
        if len(features) < 2:
            raise ValueError("a hurdle model needs at least two features")
        self.features, self.label = list(features), label
        self.clf_name, self.reg_name = clf_name, reg_name
        self.clf_params = {**HURDLE_DEFAULTS.get(clf_name, {}), **(clf_params or {})}
        self.reg_params = {**HURDLE_DEFAULTS.get(reg_name, {}), **(reg_params or {})}

    def fit(self, df: DataFrame) -> "HurdleModel":
        flagged = df.withColumn("__pos", F.when(dbl(self.label) > 0, 1.0).otherwise(0.0))
        clf = estimator(self.clf_name, self.features, "__pos", self.clf_params).fit(flagged)
        reg = estimator(self.reg_name, self.features, self.label, self.reg_params).fit(
            df.filter(dbl(self.label) > 0))
        return HurdleModel(clf, reg)


class HurdleModel(Fitted):
    """Both parts of a fitted hurdle model."""

    def __init__(self, clf: Fitted, reg: Fitted):
        super().__init__("hurdle", {"clf": clf, "reg": reg})

    def expected_value(self, df: DataFrame) -> DataFrame:
        """prediction = P(y > 0) * value."""
        return _hurdle(df, self.state, "__score")


@kind("hurdle")
def _hurdle(df, s, weight: str = "__class"):
    """prediction = class * value."""
    a = s["clf"].transform(df).withColumnsRenamed({"prediction": "__class", "score": "__score"})
    b = s["reg"].transform(a).withColumnRenamed("prediction", "__value")
    return b.withColumn("prediction", F.col(weight) * F.col("__value")).drop("__class", "__score", "__value")


def compose(is_zero_class: Column, value: Column) -> Column:
    """Two fitted parts: class 1 means zero, otherwise the regressor's value."""
    return F.when(is_zero_class == 0, value).otherwise(0.0)


class ZeroInflatedModel(Fitted):
    """Composition of an already fitted zero classifier and an already fitted regressor."""

    def __init__(self, classifier: Fitted, regressor: Fitted):
        super().__init__("zero_inflated", {"clf": classifier, "reg": regressor})


@kind("zero_inflated")
def _zero_inflated(df, s):
    a = s["clf"].transform(df).withColumnRenamed("prediction", "__zero").drop("score")
    b = s["reg"].transform(a).withColumnRenamed("prediction", "__value").drop("score")
    return b.withColumn("prediction", compose(F.col("__zero"), F.col("__value"))).drop("__zero", "__value")


def keep_prediction(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*map(ident, keep), F.col("prediction").cast("double").alias("prediction"))
