"""Drift, matured performance and the retraining decision, in one report row."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.frames import side_by_side
from tidemark.operators import consent, drift, metrics, retention
from tidemark.operators.decisions import RetrainingPolicy, retraining_decision
from tidemark.operators.journal import verify
from tidemark.schemas import MODEL_FEATURES


class CohortNotMatureError(RuntimeError):
    """No scored row is old enough for its outcome to be known."""


def evaluation_cohort(
    scores: DataFrame,
    outcomes: DataFrame,
    as_of: dt.datetime,
    outcome_days: int = 30,
    keys: Sequence[str] = ("customer_id",),
    require: bool = False,
) -> DataFrame:
    """Matured scores with their outcomes.

    Both sides have one row per key, so a hot customer is at most one row per
    scoring date. ``require`` raises when nothing is mature, at the price of a job.
    """
    cutoff = as_of - dt.timedelta(days=outcome_days)
    mature = scores.filter(F.col("scored_at") <= F.lit(cutoff.isoformat(sep=" ")).cast("timestamp_ntz"))
    cohort = mature.join(outcomes.select(*keys, "churn"), list(keys))
    if require and cohort.isEmpty():
        raise CohortNotMatureError(f"no matured cohort at {as_of:%Y-%m-%d}")
    return cohort


def monitoring_report(
    reference: DataFrame,
    current: DataFrame,
    reference_scores: DataFrame,
    current_scores: DataFrame,
    cohort: DataFrame,
    model_age_days: int,
    baseline_f1: float,
    threshold: float,
    erasures: DataFrame | None,
    features: Sequence[str] = MODEL_FEATURES,
    policy: RetrainingPolicy = RetrainingPolicy(),
) -> DataFrame:
    """Signals of the three sensors joined on the model, and the decision on them.

    One row for each model version of the cohort; what does not depend on the model is the same on all.
    """
    by_feature = drift.feature_drift(reference, current, features)
    data = drift.drift_summary(by_feature)
    predictions = drift.prediction_drift(reference_scores, current_scores).select(
        F.col("psi").alias("psi_predictions"), F.col("drift_detected").alias("predictions_drifted")
    )
    performance = metrics.evaluate(cohort, ["model_version"], threshold, baseline_f1)
    pending = retention.pending_erasures(erasures)

    shared = side_by_side(data, predictions, pending.select(F.col("pending").alias("erasure_requests")))
    values = shared.first().asDict()
    signals = (
        performance.select("model_version", "rows", "f1", F.col("f1_delta").alias("performance_delta"))
        .withColumns({c: F.lit(values[c]).cast(t) for c, t in shared.dtypes})
        .withColumn("model_age_days", F.lit(model_age_days))
    )
    return retraining_decision(signals, policy)


def as_document(report: DataFrame) -> DataFrame:
    """The report as one JSON text per row."""
    return report.select(F.to_json(F.struct(*report.columns)).alias("document"))


def compliance_checks(
    journal: DataFrame, registry: DataFrame, requests: DataFrame | None, as_of: dt.datetime
) -> DataFrame:
    """Journal state, pending erasures and consent figures as (check, value) rows."""
    checked = verify(journal).agg(
        F.count_if(~F.col("intact")).alias("broken_journals"), F.sum("entries").alias("journal_entries")
    )
    pending = retention.pending_erasures(requests)
    people = consent.summary(registry, as_of)

    def rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
        return df.select(
            F.inline(
                F.array(
                    *[F.struct(F.lit(n).alias("check"), F.col(n).cast("bigint").alias("value")) for n in names]
                )
            )
        )

    per_purpose = people.select(
        F.concat(F.lit("valid_opt_ins_"), F.col("purpose")).alias("check"),
        F.col("valid_opt_ins").cast("bigint").alias("value"),
    ).unionByName(
        people.select(
            F.concat(F.lit("objections_"), F.col("purpose")).alias("check"),
            F.col("objections").cast("bigint").alias("value"),
        )
    )
    return (
        rows(checked, ["broken_journals", "journal_entries"])
        .unionByName(rows(pending.withColumnRenamed("pending", "pending_erasures"), ["pending_erasures"]))
        .unionByName(per_purpose)
    )
