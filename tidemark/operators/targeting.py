"""From scores to a contact list: consent first, then rank, then cap."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import half_even, ratio
from tidemark.operators.consent import ConsentPolicy, eligible_for_targeting
from tidemark.schemas import CONSENT_BASIS


def targeting_list(
    scores: DataFrame,
    registry: DataFrame,
    purpose: str,
    as_of: dt.datetime,
    max_contacts: int | None = None,
    policy: ConsentPolicy = ConsentPolicy(),
) -> DataFrame:
    """Contactable customers, highest score first.

    The cap is the campaign's budget. With it the plan keeps a bounded heap per
    task; without it the list is sorted by range.
    """
    allowed = eligible_for_targeting(scores, registry, purpose, as_of, policy)
    ranked = allowed.orderBy(F.desc("churn_proba"), F.asc("customer_id"))
    if max_contacts is not None:
        ranked = ranked.limit(max_contacts)
    return ranked.withColumns({"canal": F.lit(purpose), "base_legale": F.lit(CONSENT_BASIS)})


def targeting_trace(
    scores: DataFrame,
    registry: DataFrame,
    purpose: str,
    as_of: dt.datetime,
    max_contacts: int | None = None,
) -> DataFrame:
    """Scored, consenting and targeted counts, and the contactable share.

    One row per scored customer is assumed, as a scoring run gives.
    """
    allowed = eligible_for_targeting(scores, registry, purpose, as_of)
    counted = (
        scores.select(F.lit(1).cast("bigint").alias("s"), F.lit(0).cast("bigint").alias("c"))
        .unionByName(allowed.select(F.lit(0).cast("bigint").alias("s"), F.lit(1).cast("bigint").alias("c")))
        .agg(
            F.coalesce(F.sum("s"), F.lit(0)).alias("scored"),
            F.coalesce(F.sum("c"), F.lit(0)).alias("consenting"),
        )
    )
    cap = F.lit(max_contacts).cast("bigint")
    return counted.select(
        F.lit(purpose).alias("purpose"),
        "scored",
        "consenting",
        F.least("consenting", cap).alias("targeted"),
        (F.col("scored") - F.col("consenting")).alias("excluded_without_consent"),
        F.coalesce(F.col("consenting") > cap, F.lit(False)).alias("capped"),
        half_even(ratio(F.col("consenting"), F.col("scored")), 4).alias("contactable_rate"),
    )
