"""Inputs shared by the queries, and the same inputs as SQL for the oracles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import features as feat
from tidemark.operators import scoring
from tidemark.operators import snapshots as snap
from tidemark.sources import star

CFG = snap.SnapshotConfig()
#: Two fixed logistic scorers; see tidemark.operators.scoring.
V1, V2 = scoring.LINEAR_V1, scoring.LINEAR_V2
THRESHOLD = 0.6


def ntz(at: dt.datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def tx(spark: SparkSession, sf: str) -> DataFrame:
    return star.transactions(spark, sf)


def dates(spark: SparkSession, sf: str) -> list[dt.datetime]:
    return snap.snapshot_dates(tx(spark, sf), CFG)


def as_of(spark: SparkSession, sf: str) -> dt.datetime:
    """The compliance date: the last order date of the history."""
    return snap.date_bounds(tx(spark, sf))[1]


def features(spark: SparkSession, sf: str, only: str = "all") -> DataFrame:
    """Feature table over all snapshots, the latest one, or the first and last."""
    at = dates(spark, sf)
    if only == "latest":
        at = at[-1:]
    elif only == "ends":
        at = [at[0], at[-1]]
    return feat.snapshot_dataset(tx(spark, sf), at, CFG)


def scores(spark: SparkSession, sf: str, only: str = "all", model=None) -> DataFrame:
    """Scored feature rows; keeps the label and the snapshot date."""
    return scoring.score_batch(
        features(spark, sf, only),
        model or V1,
        threshold=THRESHOLD,
        scored_at=F.col("snapshot_date"),
        keep=["churn", "snapshot_date"],
    )


# ----------------------------------------------------------------------- SQL

TX = """tx AS (
  SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderdate AS order_date,
         o_totalprice AS order_value, o_orderpriority AS product_category,
         CAST(o_orderkey % 5 < 2 AS INT) AS email_opened,
         CAST(o_orderkey % 7 < 4 AS INT) AS website_visit,
         CAST(o_orderkey % 10 < 2 AS INT) AS cart_abandoned
  FROM orders)"""

TX_LINES = """txl AS (
  SELECT o_custkey AS customer_id, o_orderdate AS order_date,
         CAST(round(CAST(CAST(l_extendedprice AS DECIMAL(12,2))
              * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(18,4)), 2) AS DOUBLE) AS order_value,
         p_type AS product_category, l_returnflag = 'R' AS is_refund
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

TX_EVENTS = """txe AS (
  SELECT user_id AS customer_id, ts AS order_date, CASE WHEN event_type = 'purchase' THEN value END AS order_value,
         event_type AS product_category, CAST(event_type = 'click' AS INT) AS email_opened,
         CAST(event_type = 'view' AS INT) AS website_visit, CAST(event_type = 'error' AS INT) AS cart_abandoned
  FROM events)"""

SNAP = """bounds AS (SELECT min(order_date) AS lo, max(order_date) AS hi FROM tx),
snap AS (
  SELECT t FROM (
    SELECT unnest(generate_series(
             CASE WHEN day(lo + INTERVAL 180 DAY) = 1 THEN lo + INTERVAL 180 DAY
                  ELSE date_trunc('month', lo + INTERVAL 180 DAY) + INTERVAL 1 MONTH
                       + ((lo + INTERVAL 180 DAY) - date_trunc('day', lo + INTERVAL 180 DAY)) END,
             hi - INTERVAL 30 DAY, INTERVAL 1 MONTH)) AS t
    FROM bounds))"""


def feats_sql(
    tx: str = "tx", snap: str = "snap", name: str = "feats",
    activity: int = 180, short: int = 30, long: int = 90, outcome: int = 30, refunds: bool = False,
) -> str:
    """Feature table as one grouping over an explicit range join."""
    dec = "CAST(order_value AS DECIMAL(18,2))"
    refund = (
        "coalesce(avg(CAST(is_refund AS INT)), 0) AS refund_rate," if refunds else ""
    )
    flags = "" if refunds else f"""
    coalesce(sum(email_opened) FILTER (s) / nullif(count(email_opened) FILTER (s), 0), 0) AS email_open_rate_30d,
    CAST(coalesce(sum(website_visit) FILTER (s), 0) AS DOUBLE) AS website_visits_30d,
    coalesce(sum(cart_abandoned) FILTER (s) / nullif(count(cart_abandoned) FILTER (s), 0), 0) AS cart_abandonment_rate,"""
    return f"""{name}_g AS (
  SELECT *, date_sub('day', lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date), order_date) AS gap
  FROM {tx}),
{name}_j AS (
  SELECT g.*, t, order_date >= t - INTERVAL {short} DAY AS s, order_date >= t - INTERVAL {long} DAY AS l
  FROM {name}_g g JOIN {snap} ON order_date <= t),
{name}_r AS (
  SELECT DISTINCT customer_id, t FROM {tx} JOIN {snap} ON order_date > t AND order_date <= t + INTERVAL {outcome} DAY),
{name}_a AS (
  SELECT customer_id, t,
    min(order_date) AS first_order_date, max(order_date) AS last_order_date,
    CAST(date_sub('day', min(order_date), t) AS INT) AS days_since_first_order,
    CAST(date_sub('day', max(order_date), t) AS INT) AS days_since_last_order,
    CAST(count(*) FILTER (s) AS DOUBLE) AS purchase_frequency_30d,
    CAST(count(*) FILTER (l) AS DOUBLE) AS purchase_frequency_90d,
    coalesce(CAST(sum({dec}) FILTER (s) AS DOUBLE) / nullif(count(order_value) FILTER (s), 0), 0) AS avg_basket_value,
    CAST(count(DISTINCT product_category) FILTER (l) AS DOUBLE) AS product_category_diversity,
    avg(gap) AS avg_days_between_orders,
    coalesce(CAST(sum({dec}) AS DOUBLE), 0) AS total_revenue,
    coalesce(CAST(sum({dec}) AS DOUBLE), 0) / nullif(count(order_value), 0) AS avg_order_value,
    max(order_value) AS max_order_value,
    CAST(count(order_value) AS INT) AS total_orders,{refund}{flags}
    CAST(month(t) AS INT) AS month, CAST(isodow(t) - 1 AS INT) AS day_of_week,
    CAST(month(t) IN (11, 12) AS INT) AS is_holiday_season
  FROM {name}_j GROUP BY customer_id, t HAVING max(order_date) > t - INTERVAL {activity} DAY),
{name} AS (
  SELECT a.* EXCLUDE (t), CAST(r.customer_id IS NULL AS INT) AS churn, a.t AS snapshot_date
  FROM {name}_a a LEFT JOIN {name}_r r ON a.customer_id = r.customer_id AND a.t = r.t)"""


FEATS = feats_sql()
#: Restrictions of the feature table; the windows of a snapshot look only at that snapshot.
LAST = "last_snap AS (SELECT max(t) AS t FROM snap)"
ENDS = "end_snaps AS (SELECT min(t) AS t FROM snap UNION SELECT max(t) FROM snap)"
FEATS_LAST = LAST + ",\n" + feats_sql(snap="last_snap")
FEATS_ENDS = ENDS + ",\n" + feats_sql(snap="end_snaps")

CONSENT = """seen AS (SELECT o_custkey AS customer_id, max(o_orderdate) AS last_seen FROM orders GROUP BY o_custkey),
purposes AS (SELECT unnest(['churn_scoring', 'marketing_email', 'marketing_sms']) AS purpose),
opted AS (
  SELECT customer_id, purpose, last_seen,
         CASE purpose WHEN 'marketing_email' THEN (customer_id * 7919) % 101 < 63
                      WHEN 'marketing_sms' THEN (customer_id * 104729) % 103 < 29 ELSE false END AS opt_in
  FROM seen CROSS JOIN purposes),
dated AS (
  SELECT customer_id, purpose, opt_in,
         CASE WHEN opt_in THEN last_seen - CAST(customer_id % 900 AS INT) * INTERVAL 1 DAY END AS consent_date,
         CASE WHEN purpose = 'churn_scoring' AND (customer_id * 15485863) % 89 < 3
              THEN last_seen - CAST(customer_id % 200 AS INT) * INTERVAL 1 DAY END AS objection_at
  FROM opted),
consent AS (
  SELECT customer_id, purpose, opt_in, consent_date,
         CASE WHEN opt_in THEN 'formulaire_web' ELSE 'aucun' END AS consent_source,
         CASE WHEN opt_in THEN 'v' || CAST(1 + customer_id % 2 AS VARCHAR) END AS consent_wording_version,
         CASE WHEN opt_in AND (customer_id * 1299709) % 97 < 8
              THEN consent_date + CAST(30 + customer_id % 370 AS INT) * INTERVAL 1 DAY END AS withdrawn_at,
         objection_at
  FROM dated)"""

#: Valid opt-ins at the compliance date, for any purpose.
OPTED_IN = """compliance AS (SELECT max(o_orderdate) AS ref_date FROM orders),
opted_in AS (
  SELECT DISTINCT purpose, customer_id FROM consent, compliance
  WHERE opt_in AND consent_date <= ref_date AND consent_date >= ref_date - INTERVAL 750 DAY
    AND (withdrawn_at IS NULL OR withdrawn_at > ref_date) AND (objection_at IS NULL OR objection_at > ref_date))"""

OBJECTED = """objected AS (
  SELECT DISTINCT purpose, customer_id FROM consent, (SELECT max(o_orderdate) AS ref_date FROM orders)
  WHERE objection_at <= ref_date)"""


def half_even(expr: str, digits: int) -> str:
    scale = f"CAST(1e{digits} AS DOUBLE)"
    return f"(round_even(CAST({expr} AS DOUBLE) * {scale}, 0) / {scale})"


def linear_sql(model) -> str:
    terms = [repr(float(model.intercept)) + "::DOUBLE"]
    terms += [f"({float(w)!r}::DOUBLE * coalesce(CAST({c} AS DOUBLE), 0))" for c, w in model.weights.items()]
    return " + ".join(terms)


def scores_sql(model, feats: str = "feats", name: str = "scores", threshold: float = THRESHOLD) -> str:
    """Scores of a feature table with a fixed linear model."""
    return f"""{name}_p AS (
  SELECT customer_id, churn, snapshot_date, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({linear_sql(model)}))) AS p FROM {feats}),
{name} AS (
  SELECT customer_id, {half_even('p', 4)} AS churn_proba,
         CASE WHEN p >= 0.7 THEN 'eleve' WHEN p >= 0.4 THEN 'moyen' ELSE 'faible' END AS risk_level,
         CAST(p >= {threshold!r} AS INT) AS predicted_churn, '{model.version}' AS model_version,
         {threshold!r}::DOUBLE AS decision_threshold, snapshot_date AS scored_at, churn, snapshot_date
  FROM {name}_p)"""


def sql(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()


BASE = (TX, SNAP)
