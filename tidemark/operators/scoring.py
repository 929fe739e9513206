"""Batch scoring: served-schema contract, probability, level and flag."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import half_even
from tidemark.schemas import (
    MODEL_FEATURES,
    NON_FEATURE_COLUMNS,
    NULLABLE_SERVED_FEATURES,
    SERVED_ROW_BOUNDS,
)


@dataclass(frozen=True)
class LinearScorer:
    """A logistic score with fixed weights, as one Catalyst expression."""

    version: str
    intercept: float
    weights: Mapping[str, float] = field(default_factory=dict)

    def probability(self) -> Column:
        z = F.lit(float(self.intercept))
        for name, weight in self.weights.items():
            z = z + F.lit(float(weight)) * F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


LINEAR_V1 = LinearScorer(
    "v0001",
    0.9,
    {
        "days_since_last_order": 0.012,
        "purchase_frequency_90d": -0.35,
        "total_orders": -0.09,
        "avg_days_between_orders": 0.006,
        "product_category_diversity": -0.1,
    },
)
LINEAR_V2 = LinearScorer(
    "v0002",
    0.4,
    {
        "days_since_last_order": 0.015,
        "purchase_frequency_30d": -0.5,
        "total_orders": -0.06,
        "avg_days_between_orders": 0.004,
        "cart_abandonment_rate": 0.3,
    },
)


#: Largest model that is sent to every worker.
MAX_MODEL_BYTES = 512 << 20


@dataclass(frozen=True)
class OutsideModel:
    """A fitted model of another library, as bytes.

    ``load`` makes of the bytes an object with ``predict_proba(frame)``, which gets the named features in order,
    missing ones as 0, and returns one column a class; the last is the probability of leaving. The bytes are broadcast
    once, and each Python worker loads them once.
    """

    version: str
    payload: bytes
    features: tuple[str, ...]
    load: Callable[[bytes], object] = pickle.loads

    def __post_init__(self) -> None:
        if len(self.payload) > MAX_MODEL_BYTES:
            raise ValueError(f"a model of {len(self.payload)} bytes is too large to send to every worker (limit {MAX_MODEL_BYTES})")

    @classmethod
    def of(cls, model: object, version: str, features: Sequence[str]) -> OutsideModel:
        """Of an object that can be pickled, its class with it where workers can't import that."""
        return cls(version, cloudpickle.dumps(model), tuple(features))

    def probability(self, df: DataFrame) -> Column:
        check_served_schema(df, self.features)
        sent = df.sparkSession.sparkContext.broadcast(self.payload)
        digest, load, names = hashlib.sha256(self.payload).hexdigest(), self.load, list(self.features)

        @F.pandas_udf("double")
        def predict(frames: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            model = _loaded(digest, load, sent)
            for frame in frames:
                frame.columns = names
                yield pd.Series(np.asarray(model.predict_proba(frame))[:, -1].astype(float))

        served = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names]
        return predict(F.struct(*served))


_MODELS: dict[str, object] = {}


def _loaded(digest: str, load: Callable[[bytes], object], sent) -> object:
    """The model of a worker process: the last one only, so that workers do not fill up."""
    if digest not in _MODELS:
        _MODELS.clear()
        _MODELS[digest] = load(sent.value)
    return _MODELS[digest]


class ServedSchemaError(ValueError):
    """The served features are not those of training, in the same order."""


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns of a feature table that may enter a model."""
    from pyspark.sql.types import NumericType

    return [
        f.name
        for f in df.schema.fields
        if f.name not in NON_FEATURE_COLUMNS and isinstance(f.dataType, NumericType)
    ]


def check_served_schema(df: DataFrame, expected: Sequence[str]) -> None:
    served = [c for c in df.columns if c in set(expected)]
    if served != list(expected):
        missing = [c for c in expected if c not in df.columns]
        raise ServedSchemaError(f"served {served}, expected {list(expected)}, missing {missing}")


def fill_missing(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value).cast(t)) for c, t in df.dtypes if c in columns})


def risk_level(proba: Column, high: float = 0.7, medium: float = 0.4) -> Column:
    """Scoring levels; a limit belongs to the level above it."""
    return F.when(proba >= high, "eleve").when(proba >= medium, "moyen").otherwise("faible")


def legacy_risk_level(proba: Column, high: float = 0.7, medium: float = 0.4) -> Column:
    """Older levels; a limit belongs to the level under it."""
    return F.when(proba > high, "high").when(proba > medium, "medium").otherwise("low")


def positive_probability(df: DataFrame, model: LinearScorer | OutsideModel | Transformer | Column) -> DataFrame:
    """Add ``_p``, the probability of leaving.

    Any fitted Spark ML classifier, a linear scorer, a model of another library (``OutsideModel``) or a
    plain column will do.
    """
    if isinstance(model, OutsideModel):
        return df.withColumn("_p", model.probability(df))
    if isinstance(model, LinearScorer):
        return df.withColumn("_p", model.probability())
    if isinstance(model, Column):
        return df.withColumn("_p", model)
    out = model.transform(df)
    return out.withColumn("_p", vector_to_array("probability")[1])


def score_batch(
    features: DataFrame,
    model: LinearScorer | OutsideModel | Transformer | Column,
    threshold: float,
    scored_at: Column,
    model_version: str | None = None,
    feature_names: Sequence[str] | None = None,
    high: float = 0.7,
    medium: float = 0.4,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Score rows. Levels and flags use the unrounded probability.

    The order of served features is checked on the schema, without a job. The
    value checks (no infinity, no negative age) are in the scoring contract.
    """
    if feature_names is not None:
        check_served_schema(features, feature_names)
    version = model_version or getattr(model, "version", None)
    if version is None:
        raise ValueError("a model version is needed")
    scored = positive_probability(features, model)
    p = F.col("_p")
    return scored.select(
        "customer_id",
        half_even(p, 4).alias("churn_proba"),
        risk_level(p, high, medium).alias("risk_level"),
        (p >= threshold).cast("int").alias("predicted_churn"),
        F.lit(version).alias("model_version"),
        F.lit(float(threshold)).alias("decision_threshold"),
        scored_at.alias("scored_at"),
        *keep,
    )


def score_models(
    features: DataFrame,
    models: Sequence[LinearScorer],
    threshold: float,
    scored_at: Column,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Scores of several linear models over the same rows, in one pass over them."""
    scores = F.array(
        *[F.struct(F.lit(m.version).alias("_version"), m.probability().alias("_p")) for m in models]
    )
    each = features.select("*", F.inline(scores))
    p = F.col("_p")
    return each.select(
        "customer_id",
        half_even(p, 4).alias("churn_proba"),
        risk_level(p).alias("risk_level"),
        (p >= threshold).cast("int").alias("predicted_churn"),
        F.col("_version").alias("model_version"),
        F.lit(float(threshold)).alias("decision_threshold"),
        scored_at.alias("scored_at"),
        *keep,
    )


def served_row_problems(df: DataFrame, names: Sequence[str] = MODEL_FEATURES) -> Column:
    """Array of the contract rules a served row breaks; empty when it may be scored."""
    rules = []
    for name in names:
        if name not in df.columns:
            if name not in NULLABLE_SERVED_FEATURES:
                rules.append(F.lit(f"{name}: missing"))
            continue
        value = F.col(name).cast("double")
        low, high = SERVED_ROW_BOUNDS.get(name, (None, None))
        if name not in NULLABLE_SERVED_FEATURES:
            rules.append(F.when(value.isNull(), F.lit(f"{name}: null")))
        if low is not None:
            rules.append(F.when(value < low, F.lit(f"{name}: under {low}")))
        if high is not None:
            rules.append(F.when(value > high, F.lit(f"{name}: over {high}")))
    return F.array_compact(F.array(*rules))


def scoring_summary(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts per level, above the threshold, and the mean score, in one aggregate."""
    level = F.col("risk_level")
    return scores.groupBy(*by).agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("predicted_churn") == 1).alias("above_threshold"),
        F.count_if(level == "eleve").alias("high_risk"),
        F.count_if(level == "moyen").alias("medium_risk"),
        F.count_if(level == "faible").alias("low_risk"),
        half_even(
            F.try_divide(
                F.sum(F.round(F.col("churn_proba") * 10000).cast("bigint")).cast("double") / 10000.0,
                F.count("churn_proba").cast("double"),
            ),
            4,
        ).alias("mean_score"),
    )
