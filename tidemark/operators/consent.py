"""Consent registry rules as predicates, semi-joins and anti-joins.

No join here carries a broadcast hint: the registry grows with the customers.
The optimiser broadcasts a side when its measured size allows, and splits the
partitions of a customer with very many rows on the left side otherwise.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import half_even, ratio
from tidemark.functions.temporal import naive_utc
from tidemark.schemas import CONSENT, CONSENT_BASIS, CONSENT_MAX_AGE_DAYS, LEGAL_BASIS


@dataclass(frozen=True)
class ConsentPolicy:
    max_age_days: int = CONSENT_MAX_AGE_DAYS
    wording_version: str | None = None


class NotConsentBasedError(ValueError):
    """Targeting was asked for a purpose that does not rest on consent."""


class IncompleteRegistryError(ValueError):
    """The registry lacks a column of its schema."""


def _at(as_of: dt.datetime) -> Column:
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def normalise(registry: DataFrame) -> DataFrame:
    """Check the columns and bring dates to UTC wall clock and flags to their type."""
    missing = sorted(set(CONSENT.fieldNames()) - set(registry.columns))
    if missing:
        raise IncompleteRegistryError(f"registry columns missing: {missing}")
    types = dict(registry.dtypes)
    dates = {c: naive_utc(F.col(c), types[c]) for c in ("consent_date", "withdrawn_at", "objection_at")}
    return registry.withColumns(
        {**dates, "opt_in": F.col("opt_in").cast("boolean"), "purpose": F.col("purpose").cast("string")}
    )


def objected(registry: DataFrame, as_of: dt.datetime, purpose: str | None = None) -> DataFrame:
    """(purpose, customer) with an objection by ``as_of``; one row is enough."""
    rows = registry if purpose is None else registry.filter(F.col("purpose") == purpose)
    return rows.filter(F.col("objection_at") <= _at(as_of)).select("purpose", "customer_id").distinct()


def is_valid_opt_in(as_of: dt.datetime, policy: ConsentPolicy = ConsentPolicy()) -> Column:
    at = _at(as_of)
    given = F.col("consent_date")
    rule = (
        F.col("opt_in")
        & (given <= at)
        & (given >= at - F.make_dt_interval(F.lit(policy.max_age_days)))
        & (F.col("withdrawn_at").isNull() | (F.col("withdrawn_at") > at))
        & (F.col("objection_at").isNull() | (F.col("objection_at") > at))
    )
    if policy.wording_version is not None:
        rule = rule & (F.col("consent_wording_version") == policy.wording_version)
    return rule


def valid_opt_ins(
    registry: DataFrame,
    as_of: dt.datetime,
    purpose: str | None = None,
    policy: ConsentPolicy = ConsentPolicy(),
) -> DataFrame:
    """(purpose, customer) with at least one valid consent row."""
    rows = registry if purpose is None else registry.filter(F.col("purpose") == purpose)
    return rows.filter(is_valid_opt_in(as_of, policy)).select("purpose", "customer_id").distinct()


def eligible_for_scoring(df: DataFrame, registry: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Legitimate interest: everyone but those who objected; unknown customers stay."""
    out = registry.filter(
        (F.col("purpose") == "churn_scoring") & (F.col("objection_at") <= _at(as_of))
    ).select("customer_id")
    return df.join(out, "customer_id", "left_anti")


def eligible_for_targeting(
    df: DataFrame,
    registry: DataFrame,
    purpose: str,
    as_of: dt.datetime,
    policy: ConsentPolicy = ConsentPolicy(),
) -> DataFrame:
    """Consent: only valid opt-ins; unknown customers are never contacted."""
    if LEGAL_BASIS[purpose] != CONSENT_BASIS:
        raise NotConsentBasedError(f"{purpose} rests on {LEGAL_BASIS[purpose]}")
    allowed = registry.filter((F.col("purpose") == purpose) & is_valid_opt_in(as_of, policy)).select(
        "customer_id"
    )
    return df.join(allowed, "customer_id", "left_semi")


def legal_basis_filter(
    df: DataFrame, registry: DataFrame, purpose: str, as_of: dt.datetime
) -> DataFrame:
    """Rows that may be processed for a purpose, by its legal basis."""
    if LEGAL_BASIS[purpose] == CONSENT_BASIS:
        return eligible_for_targeting(df, registry, purpose, as_of)
    return eligible_for_scoring(df, registry, as_of)


def legal_basis_trace(
    df: DataFrame, registry: DataFrame, purposes: Sequence[str], as_of: dt.datetime
) -> DataFrame:
    """Customers before and after the filter of each purpose.

    The table is reduced to its distinct customers once, before any join.
    """
    people = df.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
    out = None
    for purpose in purposes:
        kept = legal_basis_filter(people, registry, purpose, as_of).select(
            F.lit(0).cast("bigint").alias("b"), F.lit(1).cast("bigint").alias("a")
        )
        every = people.select(F.lit(1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("a"))
        one = (
            every.unionByName(kept)
            .agg(
                F.coalesce(F.sum("b"), F.lit(0)).alias("customers_before"),
                F.coalesce(F.sum("a"), F.lit(0)).alias("customers_after"),
            )
            .select(
                F.lit(purpose).alias("purpose"),
                F.lit(LEGAL_BASIS[purpose]).alias("legal_basis"),
                "customers_before",
                "customers_after",
                (F.col("customers_before") - F.col("customers_after")).alias("customers_excluded"),
                half_even(
                    ratio(F.col("customers_before") - F.col("customers_after"), F.col("customers_before")), 4
                ).alias("exclusion_rate"),
            )
        )
        out = one if out is None else out.unionByName(one)
    return out


def summary(
    registry: DataFrame, as_of: dt.datetime, policy: ConsentPolicy = ConsentPolicy()
) -> DataFrame:
    """Persons, valid opt-ins and objections per declared purpose.

    Rows are reduced to one per (purpose, customer) first, so the three distinct
    counts become plain conditional counts.
    """
    person = registry.groupBy("purpose", "customer_id").agg(
        F.coalesce(F.bool_or(is_valid_opt_in(as_of, policy)), F.lit(False)).alias("valid"),
        F.coalesce(F.bool_or(F.col("objection_at") <= _at(as_of)), F.lit(False)).alias("objects"),
    )
    basis = F.when(F.col("purpose") == "churn_scoring", LEGAL_BASIS["churn_scoring"]).otherwise(
        CONSENT_BASIS
    )
    return (
        person.filter(F.col("purpose").isin(*LEGAL_BASIS) & F.col("customer_id").isNotNull())
        .groupBy("purpose")
        .agg(
            F.count(F.lit(1)).alias("persons"),
            F.count_if("valid").alias("valid_opt_ins"),
            F.count_if("objects").alias("objections"),
        )
        .select(
            "purpose",
            basis.alias("legal_basis"),
            "persons",
            "valid_opt_ins",
            "objections",
            half_even(F.col("valid_opt_ins") / F.col("persons"), 3).alias("opt_in_rate"),
        )
    )


def apply_events(registry: DataFrame, events: DataFrame) -> DataFrame:
    """Registry after a table of objection and withdrawal events.

    ``events`` is (customer_id, purpose, kind, at) with kind ``objection`` or
    ``withdrawal``; the latest one of each kind wins. An objection for an
    unknown (customer, purpose) adds a row, a withdrawal for one does nothing.
    Events are combined per key before the join.
    """
    kind, at = F.col("kind"), F.col("at")
    latest = events.groupBy("customer_id", "purpose").agg(
        F.max(F.when(kind == "objection", at)).alias("_objection"),
        F.max(F.when(kind == "withdrawal", at)).alias("_withdrawal"),
    )
    joined = registry.withColumn("_known", F.lit(True)).join(
        latest, ["customer_id", "purpose"], "full_outer"
    )
    known = F.coalesce("_known", F.lit(False))
    withdrawn = known & F.col("_withdrawal").isNotNull()
    return joined.filter(known | F.col("_objection").isNotNull()).select(
        "customer_id",
        "purpose",
        (F.coalesce("opt_in", F.lit(False)) & ~withdrawn).alias("opt_in"),
        "consent_date",
        F.when(known, F.col("consent_source")).otherwise("demande_personne_concernee").alias("consent_source"),
        "consent_wording_version",
        F.when(withdrawn, F.col("_withdrawal")).otherwise(F.col("withdrawn_at")).alias("withdrawn_at"),
        F.coalesce("_objection", "objection_at").alias("objection_at"),
    )
