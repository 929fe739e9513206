"""Score a population, derive the contact list, write both."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import contracts, scoring, targeting
from tidemark.session import materialize
from tidemark.sources.files import write_csv, write_scores


@dataclass
class ScoringRun:
    scores: DataFrame
    targeting: DataFrame
    summary: DataFrame
    trace: DataFrame
    journal_entry: DataFrame


def run_scoring(
    features: DataFrame,
    model,
    feature_names: Sequence[str],
    threshold: float,
    registry: DataFrame,
    as_of: dt.datetime,
    model_version: str | None = None,
    purpose: str = "marketing_email",
    max_contacts: int | None = None,
    output_dir: str | None = None,
) -> ScoringRun:
    """Contract, score once to a table, then list, summarise and journal from it."""
    scoring.check_served_schema(features, feature_names)
    contracts.raise_if_failed(contracts.contract_scoring(features, feature_names), "scoring input")
    at = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    version = model_version or model.version
    scores = materialize(
        scoring.score_batch(features, model, threshold, at, version, feature_names), "scores"
    )
    contacts = targeting.targeting_list(scores, registry, purpose, as_of, max_contacts)
    trace = targeting.targeting_trace(scores, registry, purpose, as_of, max_contacts)
    summary = scoring.scoring_summary(scores)
    if output_dir:
        write_scores(scores, f"{output_dir}/scores")
        write_csv(contacts, f"{output_dir}/targeting_{as_of:%Y%m%d}")
    entry = trace.select(
        F.lit("scoring").alias("journal_id"),
        F.lit(as_of.isoformat()).alias("timestamp"),
        F.lit("score_batch").alias("event"),
        F.lit("churn_scoring").alias("purpose"),
        F.lit("success").alias("outcome"),
        F.lit(version).alias("model_version"),
        "scored",
        "targeted",
        "excluded_without_consent",
        F.lit(threshold).alias("threshold"),
    )
    return ScoringRun(scores, contacts, summary, trace, entry)
