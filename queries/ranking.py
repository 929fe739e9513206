"""Sorts, limits and top-k."""

from __future__ import annotations

from queries import common as c
from tidemark.operators import drift, insights, metrics, targeting
from tidemark.plans.feature_build import reference_and_current
from tidemark.schemas import MODEL_FEATURES
from tidemark.session import materialize
from tidemark.sources import star

from queries.aggregations import BY, _both_models, _CORR, _DRIFT_ROWS, _MODELS, drift_sql

BUDGET = 200


def targeting_list(spark, sf):
    return targeting.targeting_list(
        c.scores(spark, sf, "latest").drop("churn", "snapshot_date"),
        star.consent_registry(spark, sf),
        "marketing_email",
        c.as_of(spark, sf),
        max_contacts=BUDGET,
    )


def targeting_trace(spark, sf):
    return targeting.targeting_trace(
        c.scores(spark, sf, "latest"), star.consent_registry(spark, sf), "marketing_email", c.as_of(spark, sf), BUDGET
    )


def lift_at_k(spark, sf):
    """Ties of the score break by customer, then by snapshot."""
    return metrics.lift_at(c.scores(spark, sf, "latest"))


def threshold_sweep(spark, sf):
    return metrics.threshold_sweep(_both_models(spark, sf), BY, max_contact_rate=1.0)


def best_threshold(spark, sf):
    return metrics.best_threshold(_both_models(spark, sf), BY)


def top_features(spark, sf):
    return insights.top_features(insights.feature_correlation(c.features(spark, sf), MODEL_FEATURES), n=10)


def top_drifts(spark, sf):
    reference, current = reference_and_current(materialize(c.features(spark, sf, "ends"), "ends"))
    return insights.top_features(drift.feature_drift(reference, current, MODEL_FEATURES), by="psi", n=5)


QUERIES = {
    f.__name__: f
    for f in (
        targeting_list,
        targeting_trace,
        lift_at_k,
        threshold_sweep,
        best_threshold,
        top_features,
        top_drifts,
    )
}

H = c.half_even
_LAST_SCORES = [*c.BASE, c.FEATS_LAST, c.scores_sql(c.V1), c.CONSENT, c.OPTED_IN]
_EMAIL = "customer_id IN (SELECT customer_id FROM opted_in WHERE purpose = 'marketing_email')"
_NET = "tp * 0.3::DOUBLE * 1000.0::DOUBLE * 0.25::DOUBLE - n * 27.0::DOUBLE"


def sweep_sql(rate: float) -> str:
    return f"""SELECT model_version, {H('th', 2)} AS threshold, n AS contacted, {H('n / total', 4)} AS contact_rate,
       {H('tp / n', 4)} AS precision, {H(_NET, 2)} AS net_value
FROM (SELECT model_version, th, count(*) AS n, count(*) FILTER (churn = 1) AS tp
      FROM both_scores JOIN (SELECT 0.05::DOUBLE + i * ((0.05::DOUBLE + 0.01::DOUBLE) - 0.05::DOUBLE) AS th FROM (SELECT unnest(range(0, 91)) AS i))
        ON churn_proba >= th GROUP BY ALL)
JOIN (SELECT model_version, count(*) AS total FROM both_scores GROUP BY 1) USING (model_version)
WHERE n / total <= {rate}::DOUBLE"""


ORACLES = {
    "targeting_list": c.sql(
        *_LAST_SCORES,
        select=f"""SELECT * EXCLUDE (churn, snapshot_date), 'marketing_email' AS canal, 'consentement' AS base_legale
FROM scores WHERE {_EMAIL} ORDER BY churn_proba DESC, customer_id LIMIT {BUDGET}""",
    ),
    "targeting_trace": c.sql(
        *_LAST_SCORES,
        select=f"""SELECT 'marketing_email' AS purpose, s AS scored, k AS consenting, least(k, {BUDGET}) AS targeted,
       s - k AS excluded_without_consent, k > {BUDGET} AS capped, {H('k / s', 4)} AS contactable_rate
FROM (SELECT count(*) AS s, count(*) FILTER ({_EMAIL}) AS k FROM scores)""",
    ),
    "lift_at_k": c.sql(
        *c.BASE,
        c.FEATS_LAST,
        c.scores_sql(c.V1),
        "ranked AS (SELECT churn, row_number() OVER (ORDER BY churn_proba DESC, customer_id) AS rn FROM scores)",
        "cuts AS (SELECT pct, greatest(1, CAST(floor(n * f) AS BIGINT)) AS k, base FROM (SELECT unnest([10, 20, 30]) AS pct, unnest([0.1, 0.2, 0.3]::DOUBLE[]) AS f), (SELECT count(*) AS n, sum(churn) / count(*) AS base FROM scores))",
        select=f"""SELECT CAST(pct AS INT) AS top_percent, k, {H('sum(churn) / k', 4)} AS precision_at_k,
       {H('CASE WHEN base = 0 THEN 0 ELSE (sum(churn) / k) / base END', 4)} AS lift_at_k, {H('base', 4)} AS base_rate
FROM cuts JOIN ranked ON rn <= k GROUP BY pct, k, base""",
    ),
    "threshold_sweep": c.sql(*_MODELS, select=sweep_sql(1.0)),
    "best_threshold": c.sql(
        *_MODELS,
        select=f"""SELECT model_version, coalesce(threshold, 0.5) AS threshold, threshold IS NULL AS fallback, contact_rate, precision, net_value
FROM (SELECT DISTINCT model_version FROM both_scores) LEFT JOIN (
  SELECT * FROM ({sweep_sql(0.35)}) QUALIFY row_number() OVER (PARTITION BY model_version ORDER BY net_value DESC, threshold) = 1)
USING (model_version)""",
    ),
    "top_features": c.sql(
        *c.BASE,
        c.FEATS,
        select=f"""SELECT * FROM (SELECT *, abs(correlation) AS strength FROM ({_CORR})) WHERE strength IS NOT NULL
ORDER BY strength DESC, feature LIMIT 10""",
    ),
    "top_drifts": c.sql(
        *c.BASE,
        c.FEATS_ENDS,
        drift_sql(MODEL_FEATURES),
        select=f"SELECT * FROM ({_DRIFT_ROWS}) WHERE psi IS NOT NULL ORDER BY psi DESC, feature LIMIT 5",
    ),
}
