"""Joins: as-of, interval, semi and anti forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import common as c
from queries.projections import REF, REF_SQL
from tidemark.operators import consent, features as feat, retention, snapshots
from tidemark.plans.monitoring import evaluation_cohort as mature_cohort
from tidemark.sources import star


def feature_left_joins(spark, sf):
    """All customers known at one date: the one-grouping form of ten left joins."""
    return feat.features_at(c.tx(spark, sf), REF, c.CFG)


def snapshot_expand_join(spark, sf):
    return snapshots.snapshot_orders(c.tx(spark, sf), c.dates(spark, sf), c.CFG)


def asof_last_order(spark, sf):
    return snapshots.asof_last_order(c.tx(spark, sf), c.dates(spark, sf))


def returned_interval_semi(spark, sf):
    return snapshots.returned_customers(c.tx(spark, sf), c.dates(spark, sf), c.CFG)


def churn_label(spark, sf):
    return snapshots.churn_labels(c.tx(spark, sf), c.dates(spark, sf), c.CFG)


def legacy_churn_label(spark, sf):
    tx = c.tx(spark, sf)
    base = feat.customer_base(tx, REF).select("customer_id", "days_since_first_order")
    return (
        feat.single_date_labels(tx, REF)
        .join(base, "customer_id")
        .filter(F.col("days_since_first_order") >= 60)
        .select("customer_id", "churn")
    )


def population_semi_join(spark, sf):
    """Features of everyone known, kept where the customer is in the active population."""
    known = feat.features_at(c.tx(spark, sf), REF, c.CFG).select("customer_id", "total_orders", "total_revenue")
    active = snapshots.eligible_population(c.tx(spark, sf), [REF], c.CFG)
    return known.join(active, "customer_id", "left_semi")


def objection_anti_join(spark, sf):
    people = star.table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"))
    return consent.eligible_for_scoring(people, star.consent_registry(spark, sf), c.as_of(spark, sf))


def optin_semi_join(spark, sf):
    people = star.table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"))
    return consent.eligible_for_targeting(
        people, star.consent_registry(spark, sf), "marketing_email", c.as_of(spark, sf)
    )


def legal_basis_filter(spark, sf):
    """Transactions that may be processed for scoring."""
    return consent.legal_basis_filter(
        c.tx(spark, sf), star.consent_registry(spark, sf), "churn_scoring", c.as_of(spark, sf)
    ).select("customer_id", "order_id", "order_value")


def legal_basis_trace(spark, sf):
    return consent.legal_basis_trace(
        c.tx(spark, sf),
        star.consent_registry(spark, sf),
        ["churn_scoring", "marketing_email", "marketing_sms"],
        c.as_of(spark, sf),
    )


def evaluation_cohort(spark, sf):
    """Scores of all snapshots against their outcomes, those matured by the last order."""
    scores = c.scores(spark, sf).drop("churn")
    labels = snapshots.churn_labels(c.tx(spark, sf), c.dates(spark, sf), c.CFG)
    return mature_cohort(
        scores, labels, c.as_of(spark, sf), keys=["customer_id", "snapshot_date"]
    ).select("customer_id", "snapshot_date", "churn_proba", "churn")


def erase_customers(spark, sf):
    tx = c.tx(spark, sf).select("customer_id", "order_id")
    return retention.erase_customers({"tx": tx}, star.erasure_requests(spark, sf))["tx"]


def erasure_trace(spark, sf):
    frames = {
        "transactions": c.tx(spark, sf),
        "consent": star.consent_registry(spark, sf),
        "parts": star.table(spark, sf, "part"),
    }
    return retention.erasure_trace(frames, star.erasure_requests(spark, sf))


QUERIES = {
    f.__name__: f
    for f in (
        feature_left_joins,
        snapshot_expand_join,
        asof_last_order,
        returned_interval_semi,
        churn_label,
        legacy_churn_label,
        population_semi_join,
        objection_anti_join,
        optin_semi_join,
        legal_basis_filter,
        legal_basis_trace,
        evaluation_cohort,
        erase_customers,
        erasure_trace,
    )
}

_LEFT_JOINS = f"""
SELECT b.customer_id, first_order_date, last_order_date,
       CAST(date_sub('day', first_order_date, {REF_SQL}) AS INT) AS days_since_first_order,
       CAST(date_sub('day', last_order_date, {REF_SQL}) AS INT) AS days_since_last_order,
       CAST(coalesce(f30.n, 0) AS DOUBLE) AS purchase_frequency_30d,
       CAST(coalesce(f90.n, 0) AS DOUBLE) AS purchase_frequency_90d,
       coalesce(f30.v, 0) AS avg_basket_value, CAST(coalesce(f90.k, 0) AS DOUBLE) AS product_category_diversity,
       g.gap AS avg_days_between_orders, m.total AS total_revenue, m.total / m.n AS avg_order_value,
       m.biggest AS max_order_value, CAST(m.n AS INT) AS total_orders,
       coalesce(f30.email, 0) AS email_open_rate_30d, CAST(coalesce(f30.visits, 0) AS DOUBLE) AS website_visits_30d,
       coalesce(f30.cart, 0) AS cart_abandonment_rate,
       CAST(month({REF_SQL}) AS INT) AS month, CAST(isodow({REF_SQL}) - 1 AS INT) AS day_of_week,
       CAST(month({REF_SQL}) IN (11, 12) AS INT) AS is_holiday_season
FROM (SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date FROM obs GROUP BY 1) b
LEFT JOIN (SELECT customer_id, count(*) AS n, CAST(sum(CAST(order_value AS DECIMAL(18,2))) AS DOUBLE) / count(order_value) AS v,
                  sum(email_opened) / count(email_opened) AS email, sum(website_visit) AS visits,
                  sum(cart_abandoned) / count(cart_abandoned) AS cart
           FROM obs WHERE order_date >= {REF_SQL} - INTERVAL 30 DAY GROUP BY 1) f30 USING (customer_id)
LEFT JOIN (SELECT customer_id, count(*) AS n, count(DISTINCT product_category) AS k
           FROM obs WHERE order_date >= {REF_SQL} - INTERVAL 90 DAY GROUP BY 1) f90 USING (customer_id)
LEFT JOIN (SELECT customer_id, avg(gap) AS gap FROM (
             SELECT customer_id, date_sub('day', lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date), order_date) AS gap
             FROM obs) GROUP BY 1) g USING (customer_id)
LEFT JOIN (SELECT customer_id, CAST(sum(CAST(order_value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(order_value) AS n,
                  max(order_value) AS biggest FROM obs GROUP BY 1) m USING (customer_id)"""

_OBS = f"obs AS (SELECT * FROM tx WHERE order_date <= {REF_SQL})"
_PEOPLE = "people AS (SELECT c_custkey AS customer_id FROM customer)"


def _trace(purpose: str, basis: str, kept: str) -> str:
    return f"""SELECT '{purpose}' AS purpose, '{basis}' AS legal_basis, b AS customers_before, a AS customers_after,
       b - a AS customers_excluded, {c.half_even('CASE WHEN b = 0 THEN 0 ELSE (b - a) / b END', 4)} AS exclusion_rate
FROM (SELECT (SELECT count(DISTINCT customer_id) FROM tx) AS b, (SELECT count(DISTINCT customer_id) FROM tx WHERE {kept}) AS a)"""


ORACLES = {
    "feature_left_joins": c.sql(c.TX, _OBS, select=_LEFT_JOINS),
    "snapshot_expand_join": c.sql(
        *c.BASE,
        select="""SELECT customer_id, t AS snapshot_date, count(*) AS orders_in_window,
       coalesce(CAST(sum(CAST(order_value AS DECIMAL(18,2))) AS DOUBLE), 0) AS value_in_window
FROM tx JOIN snap ON order_date > t - INTERVAL 180 DAY AND order_date <= t GROUP BY ALL""",
    ),
    "asof_last_order": c.sql(
        *c.BASE,
        select="""SELECT customer_id, t AS snapshot_date, max(order_date) AS last_order_date,
       CAST(date_sub('day', max(order_date), t) AS INT) AS days_since_last_order
FROM tx JOIN snap ON order_date <= t GROUP BY customer_id, t""",
    ),
    "returned_interval_semi": c.sql(
        *c.BASE,
        select="""SELECT DISTINCT customer_id, t AS snapshot_date FROM tx JOIN snap
ON order_date > t AND order_date <= t + INTERVAL 30 DAY""",
    ),
    "churn_label": c.sql(
        *c.BASE,
        select="""SELECT p.customer_id, p.t AS snapshot_date,
       CAST(NOT EXISTS (SELECT 1 FROM tx f WHERE f.customer_id = p.customer_id AND f.order_date > p.t
                        AND f.order_date <= p.t + INTERVAL 30 DAY) AS INT) AS churn
FROM (SELECT DISTINCT customer_id, t FROM tx JOIN snap ON order_date > t - INTERVAL 180 DAY AND order_date <= t) p""",
    ),
    "legacy_churn_label": c.sql(
        c.TX,
        select=f"""SELECT l.customer_id,
       CAST(NOT EXISTS (SELECT 1 FROM tx f WHERE f.customer_id = l.customer_id AND f.order_date > l.last_date
            AND f.order_date <= least(l.last_date + INTERVAL 30 DAY, {REF_SQL} + INTERVAL 30 DAY)) AS INT) AS churn
FROM (SELECT customer_id, max(order_date) AS last_date, min(order_date) AS first_date FROM tx
      WHERE order_date <= {REF_SQL} GROUP BY 1) l
WHERE date_sub('day', first_date, {REF_SQL}) >= 60""",
    ),
    "population_semi_join": c.sql(
        c.TX,
        select=f"""SELECT customer_id, CAST(count(order_value) AS INT) AS total_orders,
       CAST(sum(CAST(order_value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM tx WHERE order_date <= {REF_SQL}
  AND customer_id IN (SELECT customer_id FROM tx WHERE order_date > {REF_SQL} - INTERVAL 180 DAY AND order_date <= {REF_SQL})
GROUP BY customer_id""",
    ),
    "objection_anti_join": c.sql(
        c.CONSENT,
        c.OBJECTED,
        _PEOPLE,
        select="SELECT customer_id FROM people WHERE customer_id NOT IN (SELECT customer_id FROM objected WHERE purpose = 'churn_scoring')",
    ),
    "optin_semi_join": c.sql(
        c.CONSENT,
        c.OPTED_IN,
        _PEOPLE,
        select="SELECT customer_id FROM people WHERE customer_id IN (SELECT customer_id FROM opted_in WHERE purpose = 'marketing_email')",
    ),
    "legal_basis_filter": c.sql(
        c.TX,
        c.CONSENT,
        c.OBJECTED,
        select="""SELECT customer_id, order_id, order_value FROM tx
WHERE customer_id NOT IN (SELECT customer_id FROM objected WHERE purpose = 'churn_scoring')""",
    ),
    "legal_basis_trace": c.sql(
        c.TX,
        c.CONSENT,
        c.OBJECTED,
        c.OPTED_IN,
        select=" UNION ALL ".join(
            [
                _trace(
                    "churn_scoring",
                    "interet_legitime",
                    "customer_id NOT IN (SELECT customer_id FROM objected WHERE purpose = 'churn_scoring')",
                ),
                *[
                    _trace(p, "consentement", f"customer_id IN (SELECT customer_id FROM opted_in WHERE purpose = '{p}')")
                    for p in ("marketing_email", "marketing_sms")
                ],
            ]
        ),
    ),
    "evaluation_cohort": c.sql(
        *c.BASE,
        c.FEATS,
        c.scores_sql(c.V1),
        select="""SELECT customer_id, snapshot_date, churn_proba, churn FROM scores
WHERE scored_at <= (SELECT hi FROM bounds) - INTERVAL 30 DAY""",
    ),
    "erase_customers": c.sql(
        c.TX,
        select="SELECT customer_id, order_id FROM tx WHERE customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 97 = 0)",
    ),
    "erasure_trace": c.sql(
        c.TX,
        c.CONSENT,
        "gone AS (SELECT c_custkey AS customer_id FROM customer WHERE c_custkey % 97 = 0)",
        select="""SELECT 'transactions' AS dataset, count(*) AS rows_removed FROM tx SEMI JOIN gone USING (customer_id)
UNION ALL SELECT 'consent', count(*) FROM consent SEMI JOIN gone USING (customer_id)
UNION ALL SELECT 'parts', 0""",
    ),
}
