"""Aggregations: feature families, metrics, drift and descriptive tables."""

from __future__ import annotations


from pyspark.sql import functions as F

from queries import common as c
from queries.projections import REF, REF_SQL
from queries.sources import CALIBRATION
from tidemark.operators import consent, drift, features as feat, insights, metrics, privacy, roi as returns, scoring, snapshots
from tidemark.plans import feature_build
from tidemark.schemas import MODEL_FEATURES
from tidemark.session import materialize
from tidemark.sources import star

BY = ["model_version"]


def customer_base(spark, sf):
    return feat.customer_base(c.tx(spark, sf))


def behavioral_features(spark, sf):
    return feat.features_at(c.tx(spark, sf), REF, c.CFG).select(
        "customer_id",
        "purchase_frequency_30d",
        "purchase_frequency_90d",
        "avg_basket_value",
        "product_category_diversity",
        "avg_days_between_orders",
    )


def transactional_features(spark, sf):
    """Line-grain transactions, so that the refund rate is present."""
    return feat.features_at(star.line_transactions(spark, sf), REF, c.CFG).select(
        "customer_id", "total_revenue", "avg_order_value", "max_order_value", "total_orders", "refund_rate"
    )


def engagement_features(spark, sf):
    return feat.features_at(c.tx(spark, sf), REF, c.CFG).select(
        "customer_id", "email_open_rate_30d", "website_visits_30d", "cart_abandonment_rate"
    )


def compute_all_features(spark, sf):
    """Single-date table with its label and the minimum-history rule."""
    return feat.features_at(c.tx(spark, sf), REF, c.CFG, with_target=True)


def snapshot_dataset(spark, sf):
    return c.features(spark, sf)


def snapshot_dataset_lines(spark, sf):
    """Replay at line grain: many rows per instant, no row key, a refund rate."""
    tx = star.line_transactions(spark, sf)
    lines = star.table(spark, sf, "lineitem").count()
    return feat.snapshot_dataset(tx, snapshots.snapshot_dates(tx, c.CFG), c.CFG, rows=lines)


EVENT_CFG = snapshots.SnapshotConfig(
    outcome_days=5, activity_days=15, min_history_days=10, short_days=5, long_days=15, frequency="week"
)


def snapshot_dataset_events(spark, sf):
    """Replay over microsecond events at weekly snapshots, with missing values."""
    tx = star.event_transactions(spark, sf)
    return feat.snapshot_dataset(tx, snapshots.snapshot_dates(tx, EVENT_CFG), EVENT_CFG)


def snapshot_report(spark, sf):
    return feature_build.snapshot_report(c.features(spark, sf))


def snapshot_totals(spark, sf):
    return feature_build.snapshot_totals(c.features(spark, sf))


def ingest_summary(spark, sf):
    return feature_build.ingest_summary(c.tx(spark, sf))


def scoring_summary(spark, sf):
    return scoring.scoring_summary(c.scores(spark, sf), ["snapshot_date"])


def consent_summary(spark, sf):
    return consent.summary(star.consent_registry(spark, sf), c.as_of(spark, sf))


def k_anonymity(spark, sf):
    return privacy.k_anonymity(star.table(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"], 5)


def _both_models(spark, sf):
    """Both fixed models over the same feature rows."""
    return scoring.score_models(
        c.features(spark, sf), [c.V1, c.V2], c.THRESHOLD, F.col("snapshot_date"), keep=["churn"]
    )


def classification_metrics(spark, sf):
    return metrics.classification_metrics(_both_models(spark, sf), BY, c.THRESHOLD)


def roc_auc(spark, sf):
    return metrics.roc_auc(_both_models(spark, sf), BY)


def brier(spark, sf):
    return metrics.brier(_both_models(spark, sf), BY)


def evaluate_cohort(spark, sf):
    return metrics.evaluate(_both_models(spark, sf), BY, c.THRESHOLD, baseline_f1=0.9)


def calibration_table(spark, sf):
    return metrics.calibration_table(c.scores(spark, sf))


def _ends(spark, sf):
    """First and last snapshot, written once: several plans read them."""
    return feature_build.reference_and_current(materialize(c.features(spark, sf, "ends"), "ends"))


def psi(spark, sf):
    reference, current = _ends(spark, sf)
    out = drift.psi(reference, current, MODEL_FEATURES)
    return out.select("feature", c_half(F.col("psi"), 6).alias("psi"), "rows_ref", "rows_cur")


def c_half(value, digits):
    from tidemark.functions import half_even

    return half_even(value, digits)


def feature_drift(spark, sf):
    reference, current = _ends(spark, sf)
    return drift.feature_drift(reference, current, MODEL_FEATURES)


def drift_summary(spark, sf):
    reference, current = _ends(spark, sf)
    return drift.drift_summary(drift.feature_drift(reference, current, MODEL_FEATURES))


def ks_two_sample(spark, sf):
    reference, current = _ends(spark, sf)
    out = drift.ks_distance(reference, current, MODEL_FEATURES)
    return out.select(
        "feature",
        "rows_ref",
        "rows_cur",
        c_half(F.col("ks_distance"), 9).alias("ks_distance"),
        c_half(F.col("ks_pvalue"), 6).alias("ks_pvalue"),
    )


def prediction_drift(spark, sf):
    reference, current = _ends(spark, sf)
    score = lambda df: scoring.score_batch(df, c.V1, c.THRESHOLD, F.col("snapshot_date"))
    return drift.prediction_drift(score(reference), score(current))


def churn_by_recency(spark, sf):
    return insights.churn_by_recency(c.features(spark, sf))


def churn_by_frequency(spark, sf):
    return insights.churn_by_frequency(c.features(spark, sf))


def recency_histogram(spark, sf):
    return insights.recency_histogram(c.features(spark, sf))


def risk_segment_counts(spark, sf):
    return insights.risk_segment_counts(c.features(spark, sf))


def segment_profile(spark, sf):
    latest = c.features(spark, sf, "latest")
    return insights.segment_profile(insights.rfm_segments(insights.rfm_scores(latest)))


def monthly_churn(spark, sf):
    return insights.monthly_churn(c.features(spark, sf, "latest"))


def overview_kpis(spark, sf):
    return insights.overview_kpis(c.features(spark, sf, "latest"))


def feature_correlation(spark, sf):
    return insights.feature_correlation(c.features(spark, sf), MODEL_FEATURES)


def category_importance(spark, sf):
    return insights.category_importance(insights.feature_correlation(c.features(spark, sf), MODEL_FEATURES))


def describe_features(spark, sf):
    return insights.describe_features(c.features(spark, sf), MODEL_FEATURES)


def scale_pos_weight(spark, sf):
    train = c.features(spark, sf).filter(F.col("snapshot_date") < c.ntz(c.dates(spark, sf)[-3]))
    return metrics.class_weight(train)


def roi(spark, sf):
    return returns.roi(c.scores(spark, sf, "latest"))


QUERIES = {
    f.__name__: f
    for f in (
        customer_base,
        behavioral_features,
        transactional_features,
        engagement_features,
        compute_all_features,
        snapshot_dataset,
        snapshot_dataset_lines,
        snapshot_dataset_events,
        snapshot_report,
        snapshot_totals,
        ingest_summary,
        scoring_summary,
        consent_summary,
        k_anonymity,
        classification_metrics,
        roc_auc,
        brier,
        evaluate_cohort,
        calibration_table,
        psi,
        feature_drift,
        drift_summary,
        ks_two_sample,
        prediction_drift,
        churn_by_recency,
        churn_by_frequency,
        recency_histogram,
        risk_segment_counts,
        segment_profile,
        monthly_churn,
        overview_kpis,
        feature_correlation,
        category_importance,
        describe_features,
        scale_pos_weight,
        roi,
    )
}

H = c.half_even
_AT = f"at_snap AS (SELECT {REF_SQL} AS t)"
_FEATS_AT = _AT + ",\n" + c.feats_sql(snap="at_snap", activity=100000)
_MODELS = [
    *c.BASE,
    c.FEATS,
    c.scores_sql(c.V1, name="s1"),
    c.scores_sql(c.V2, name="s2"),
    "both_scores AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2)",
]
_CONFUSION = f"""SELECT model_version, count(*) AS n,
  count(*) FILTER (churn_proba >= {c.THRESHOLD} AND churn = 1) AS tp, count(*) FILTER (churn_proba >= {c.THRESHOLD} AND churn = 0) AS fp,
  count(*) FILTER (churn_proba < {c.THRESHOLD} AND churn = 1) AS fn, avg(pow(churn_proba - churn, 2)) AS br,
  sum(churn) / count(*) AS obs, CAST(sum(CAST(churn_proba AS DECIMAL(9,4))) AS DOUBLE) / count(*) AS ms
  FROM both_scores GROUP BY model_version"""
_F1 = "CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END"
_AUC = f"""SELECT model_version, {H('CASE WHEN p = 0 OR n = 0 THEN 0 ELSE CAST(u2 AS DOUBLE) / (CAST(p AS DOUBLE) * CAST(n AS DOUBLE) * 2) END', 4)} AS roc_auc
FROM (SELECT model_version, sum(pos * (2 * below - neg)) AS u2, sum(pos) AS p, sum(neg) AS n FROM (
  SELECT model_version, CAST(pos AS HUGEINT) AS pos, neg, sum(neg) OVER (PARTITION BY model_version ORDER BY churn_proba) AS below FROM (
    SELECT model_version, churn_proba, count(*) FILTER (churn = 1) AS pos, count(*) FILTER (churn = 0) AS neg
    FROM both_scores GROUP BY ALL)) GROUP BY model_version)"""

_LONG = """longs AS (
  SELECT feature, CAST(value AS DOUBLE) AS value, snapshot_date = (SELECT min(t) FROM snap) AS is_ref FROM (
    UNPIVOT (SELECT snapshot_date, {cols} FROM {src}) ON COLUMNS(* EXCLUDE (snapshot_date)) INTO NAME feature VALUE value))"""


def drift_sql(features, src: str = "feats") -> str:
    cols = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in features)
    levels = ", ".join(repr(i * 0.1) for i in range(10)) + ", 1.0"
    return (
        _LONG.format(cols=cols, src=src)
        + f""",
sides AS (SELECT feature, count(*) FILTER (is_ref) AS rows_ref, count(*) FILTER (NOT is_ref) AS rows_cur,
                 avg(value) FILTER (is_ref) AS mean_ref, avg(value) FILTER (NOT is_ref) AS mean_cur FROM longs GROUP BY feature),
ordered AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS i FROM longs WHERE is_ref),
levels AS (SELECT feature, (rows_ref - 1) * CAST(q AS DOUBLE) AS h FROM sides, (SELECT unnest([{levels}]::DOUBLE[]) AS q) WHERE rows_ref > 0),
edges AS (SELECT DISTINCT l.feature, lo.value + (hi.value - lo.value) * (h - floor(h)) AS edge FROM levels l
          JOIN ordered lo ON lo.feature = l.feature AND lo.i = floor(h) JOIN ordered hi ON hi.feature = l.feature AND hi.i = ceil(h)),
inner_edges AS (SELECT feature, list(edge) FILTER (r > 1 AND r < n) AS e, max(n) AS n FROM (
          SELECT feature, edge, row_number() OVER (PARTITION BY feature ORDER BY edge) AS r, count(*) OVER (PARTITION BY feature) AS n FROM edges)
          GROUP BY feature),
hist AS (SELECT v.feature, len(list_filter(e, lambda x: x <= value)) AS bin, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c
         FROM longs v JOIN inner_edges USING (feature) WHERE n >= 3 GROUP BY ALL),
shares AS (SELECT feature, greatest(r / rows_ref, 1e-6::DOUBLE) AS e, greatest(c / rows_cur, 1e-6::DOUBLE) AS a FROM hist JOIN sides USING (feature)),
psi AS (SELECT s.*, CASE WHEN rows_ref = 0 OR rows_cur = 0 THEN NULL
                WHEN coalesce(n, 0) < 3 THEN CASE WHEN abs(mean_ref - mean_cur) <= 1e-8::DOUBLE + 1e-5::DOUBLE * abs(mean_cur) THEN 0.0 ELSE 1.0 END
                ELSE p END AS psi
        FROM sides s LEFT JOIN inner_edges USING (feature)
        LEFT JOIN (SELECT feature, sum((a - e) * ln(a / e)) AS p FROM shares GROUP BY feature) USING (feature)),
cdf AS (SELECT feature, value, sum(CAST(is_ref AS INT)) OVER w AS a, sum(CAST(NOT is_ref AS INT)) OVER w AS b FROM longs WINDOW w AS (PARTITION BY feature ORDER BY value)),
ks AS (SELECT *, sqrt(CAST(rows_ref AS DOUBLE) * rows_cur / (rows_ref + rows_cur)) * d AS x FROM (
       SELECT feature, rows_ref, rows_cur, max(abs(a / rows_ref - b / rows_cur)) AS d FROM cdf JOIN sides USING (feature) GROUP BY ALL)),"""
        + f"""
slices AS (SELECT count(*) FILTER (snapshot_date = (SELECT min(t) FROM snap)) AS reference_rows,
                  count(*) FILTER (snapshot_date <> (SELECT min(t) FROM snap)) AS current_rows FROM {src})"""
    )


_LEVEL = """CASE WHEN psi IS NULL THEN 'indeterminé' WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'dérive modérée'
     ELSE 'dérive significative' END"""
_KS_SERIES = " + ".join(f"({2.0 * (-1) ** (k - 1)!r} * exp({-2.0 * k * k!r} * x * x))" for k in range(1, 101))
_KS_P = H(f"CASE WHEN rows_ref > 20 AND rows_cur > 20 THEN CASE WHEN x < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, {_KS_SERIES})) END END", 6)
_DRIFT_ROWS = f"""SELECT feature, {H('psi', 4)} AS psi, {_LEVEL} AS interpretation,
       coalesce({H('psi', 4)}, 0) >= 0.2 AS drifted, ks_pvalue, {H('mean_ref', 4)} AS mean_ref, {H('mean_cur', 4)} AS mean_cur,
       reference_rows, current_rows
FROM psi JOIN (SELECT feature, {_KS_P} AS ks_pvalue FROM ks) USING (feature), slices"""
_BINNED = """SELECT bin, count(*) AS customers, {rate} AS churn_rate, CAST(sum(churn) AS BIGINT) AS leavers,
       CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_revenue
FROM (SELECT *, CASE {case} END AS bin FROM feats) WHERE bin IS NOT NULL GROUP BY bin"""
_RATE = H("CAST(sum(churn) AS DOUBLE) / count(*)", 6)
_DEC = "CAST(total_revenue AS DECIMAL(18,2))"
_CORR = " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, CASE WHEN min(x) < max(x) AND min(y) < max(y) THEN {H('corr(x, y)', 6)} END AS correlation
FROM (SELECT CAST({f} AS DOUBLE) AS x, CAST(churn AS DOUBLE) AS y FROM feats WHERE {f} IS NOT NULL)"""
    for f in MODEL_FEATURES
)
RFM = """rfm AS (
  SELECT *, CASE WHEN r <= m + x THEN 3 WHEN r <= 2 * m + x THEN 2 ELSE 1 END AS R_score,
         CASE WHEN f <= m + x THEN 1 WHEN f <= 2 * m + x THEN 2 ELSE 3 END AS F_score,
         CASE WHEN v <= m + x THEN 1 WHEN v <= 2 * m + x THEN 2 ELSE 3 END AS M_score
  FROM (SELECT *, row_number() OVER (ORDER BY days_since_last_order, customer_id) AS r,
               row_number() OVER (ORDER BY purchase_frequency_30d, customer_id) AS f,
               row_number() OVER (ORDER BY total_revenue, customer_id) AS v,
               count(*) OVER () // 3 AS m, CAST(count(*) OVER () % 3 = 2 AS INT) AS x FROM feats)),
segments AS (
  SELECT *, CASE WHEN code IN ('333', '332', '323', '322') THEN 'Champions'
                 WHEN code IN ('313', '312', '311', '223', '222', '221') THEN 'Clients fidèles'
                 WHEN code IN ('133', '132', '123', '122') THEN 'À risque'
                 WHEN code IN ('111', '112', '121', '131') THEN 'Perdus' ELSE 'Autres' END AS segment_name
  FROM (SELECT *, R_score || '' || F_score || '' || M_score AS code FROM rfm))"""
ECONOMICS = f"""SELECT {{extra}}n AS total_customers, k AS at_risk_customers, saved AS saved_customers,
       saved * 1000.0::DOUBLE AS revenue_saved, k * 15.0::DOUBLE AS campaign_cost,
       saved * 1000.0::DOUBLE - k * 15.0::DOUBLE - 25000.0::DOUBLE AS net_benefit,
       {H('(saved * 1000.0::DOUBLE - k * 15.0::DOUBLE - 25000.0::DOUBLE) / 25000.0::DOUBLE * 100', 4)} AS roi_percentage,
       {H('0.18::DOUBLE - 0.18::DOUBLE * (saved / n)', 6)} AS new_churn_rate, {H('0.18::DOUBLE * (saved / n)', 6)} AS churn_reduction,
       {H('coalesce(saved * 1000.0::DOUBLE / nullif(k * 15.0::DOUBLE, 0), 0)', 4)} AS campaign_roi,
       {H('CASE WHEN saved * 1000.0::DOUBLE - k * 15.0::DOUBLE > 0 THEN 25000.0::DOUBLE / ((saved * 1000.0::DOUBLE - k * 15.0::DOUBLE) / 12.0::DOUBLE) END', 4)} AS payback_months
FROM (SELECT *, CAST(floor(k * success) AS BIGINT) AS saved FROM (
  SELECT count(*) AS n, count(*) FILTER (churn_proba >= 0.7) AS k FROM scores), {{cases}})"""


def _feats_cols(cols: str) -> str:
    return c.sql(c.TX, _FEATS_AT, select=f"SELECT {cols} FROM feats")


ORACLES = {
    "customer_base": c.sql(
        c.TX,
        select="""SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
       CAST(date_sub('day', min(order_date), max(order_date)) AS INT) AS customer_lifetime_days FROM tx GROUP BY customer_id""",
    ),
    "behavioral_features": _feats_cols(
        "customer_id, purchase_frequency_30d, purchase_frequency_90d, avg_basket_value, product_category_diversity, avg_days_between_orders"
    ),
    "transactional_features": c.sql(
        c.TX_LINES,
        _AT,
        c.feats_sql(tx="txl", snap="at_snap", activity=100000, refunds=True),
        select="SELECT customer_id, total_revenue, avg_order_value, max_order_value, total_orders, refund_rate FROM feats",
    ),
    "engagement_features": _feats_cols("customer_id, email_open_rate_30d, website_visits_30d, cart_abandonment_rate"),
    "compute_all_features": c.sql(
        c.TX,
        _FEATS_AT,
        f"""lab AS (SELECT l.customer_id, CAST(NOT EXISTS (SELECT 1 FROM tx f WHERE f.customer_id = l.customer_id
            AND f.order_date > l.d AND f.order_date <= least(l.d, {REF_SQL}) + INTERVAL 30 DAY) AS INT) AS churn
            FROM (SELECT customer_id, max(order_date) AS d FROM tx WHERE order_date <= {REF_SQL} GROUP BY 1) l)""",
        select="""SELECT f.* EXCLUDE (churn, snapshot_date), lab.churn FROM feats f JOIN lab USING (customer_id)
WHERE days_since_first_order >= 60""",
    ),
    "snapshot_dataset": c.sql(*c.BASE, c.FEATS, select="SELECT * FROM feats"),
    "snapshot_dataset_lines": c.sql(
        c.TX_LINES,
        c.SNAP.replace("FROM tx)", "FROM txl)", 1),
        c.feats_sql(tx="txl", refunds=True),
        select="SELECT * FROM feats",
    ),
    "snapshot_dataset_events": c.sql(
        c.TX_EVENTS,
        """snap AS (SELECT unnest(generate_series(lo + INTERVAL 10 DAY, hi - INTERVAL 5 DAY, INTERVAL 7 DAY)) AS t
  FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM txe))""",
        c.feats_sql(tx="txe", activity=15, short=5, long=15, outcome=5),
        select="SELECT * FROM feats",
    ),
    "snapshot_report": c.sql(
        *c.BASE,
        c.FEATS,
        select=f"""SELECT snapshot_date, count(*) AS population, CAST(sum(churn) AS BIGINT) AS leavers,
       {H('sum(churn) / count(*)', 4)} AS churn_rate FROM feats GROUP BY ROLLUP (snapshot_date)""",
    ),
    "snapshot_totals": c.sql(
        *c.BASE,
        c.FEATS,
        select=f"""SELECT count(*) AS snapshots, max(n) AS rows, max(r) AS churn_rate, min(rate) AS min_rate, max(rate) AS max_rate, max(p) AS customers
FROM (SELECT {H('sum(churn) / count(*)', 4)} AS rate FROM feats GROUP BY snapshot_date),
     (SELECT count(*) AS n, {H('sum(churn) / count(*)', 4)} AS r, count(DISTINCT customer_id) AS p FROM feats)""",
    ),
    "ingest_summary": c.sql(
        c.TX, select="SELECT count(*) AS transactions, count(DISTINCT customer_id) AS customers FROM tx"
    ),
    "scoring_summary": c.sql(
        *c.BASE,
        c.FEATS,
        c.scores_sql(c.V1),
        select=f"""SELECT snapshot_date, count(*) AS customers, count(*) FILTER (predicted_churn = 1) AS above_threshold,
       count(*) FILTER (risk_level = 'eleve') AS high_risk, count(*) FILTER (risk_level = 'moyen') AS medium_risk,
       count(*) FILTER (risk_level = 'faible') AS low_risk,
       {H('CAST(sum(CAST(churn_proba AS DECIMAL(9,4))) AS DOUBLE) / count(*)', 4)} AS mean_score FROM scores GROUP BY snapshot_date""",
    ),
    "consent_summary": c.sql(
        c.CONSENT,
        c.OPTED_IN,
        c.OBJECTED,
        select=f"""SELECT purpose, CASE purpose WHEN 'churn_scoring' THEN 'interet_legitime' ELSE 'consentement' END AS legal_basis,
       persons, valid_opt_ins, objections, {H('valid_opt_ins / persons', 3)} AS opt_in_rate
FROM (SELECT purpose, count(DISTINCT customer_id) AS persons,
             (SELECT count(*) FROM opted_in o WHERE o.purpose = c.purpose) AS valid_opt_ins,
             (SELECT count(*) FROM objected o WHERE o.purpose = c.purpose) AS objections FROM consent c GROUP BY purpose)""",
    ),
    "k_anonymity": """SELECT true AS applicable, 5 AS k_required, min(n) AS k_observed, count(*) FILTER (n < 5) AS groups_under_k,
       count(*) FILTER (n < 5) = 0 AS compliant, CAST(coalesce(sum(n) FILTER (n < 5), 0) AS BIGINT) AS persons_exposed
FROM (SELECT count(*) AS n FROM customer GROUP BY c_mktsegment, c_nationkey)""",
    "classification_metrics": c.sql(
        *_MODELS,
        select=f"""SELECT model_version, n AS rows, {H(_F1, 4)} AS f1, {H('CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END', 4)} AS precision,
       {H('CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END', 4)} AS recall FROM ({_CONFUSION})""",
    ),
    "roc_auc": c.sql(*_MODELS, select=_AUC),
    "brier": c.sql(*_MODELS, select=f"SELECT model_version, {H('br', 4)} AS brier FROM ({_CONFUSION})"),
    "evaluate_cohort": c.sql(
        *_MODELS,
        select=f"""SELECT model_version, n AS rows, {H(_F1, 4)} AS f1, {H('tp / nullif(tp + fp, 0)', 4)} AS precision,
       {H('tp / nullif(tp + fn, 0)', 4)} AS recall, {H('br', 4)} AS brier, {H('obs', 4)} AS observed_rate, {H('ms', 4)} AS mean_score,
       roc_auc, {H(H(_F1, 4) + ' - 0.9::DOUBLE', 4)} AS f1_delta FROM ({_CONFUSION}) JOIN ({_AUC}) USING (model_version)""",
    ),
    "calibration_table": c.sql(*c.BASE, c.FEATS, c.scores_sql(c.V1), select=CALIBRATION),
    "psi": c.sql(
        *c.BASE, c.FEATS_ENDS, drift_sql(MODEL_FEATURES),
        select=f"SELECT feature, {H('psi', 6)} AS psi, rows_ref, rows_cur FROM psi",
    ),
    "feature_drift": c.sql(*c.BASE, c.FEATS_ENDS, drift_sql(MODEL_FEATURES), select=_DRIFT_ROWS),
    "drift_summary": c.sql(
        *c.BASE,
        c.FEATS_ENDS,
        drift_sql(MODEL_FEATURES),
        select=f"""SELECT count(*) AS features_analysed, count(*) FILTER (drifted) AS features_drifted, bool_or(drifted) AS drift_detected,
       max(psi) AS psi_max FROM ({_DRIFT_ROWS})""",
    ),
    "ks_two_sample": c.sql(
        *c.BASE,
        c.FEATS_ENDS,
        drift_sql(MODEL_FEATURES),
        select=f"SELECT feature, rows_ref, rows_cur, {H('d', 9)} AS ks_distance, {_KS_P} AS ks_pvalue FROM ks",
    ),
    "prediction_drift": c.sql(
        *c.BASE,
        c.FEATS_ENDS,
        c.scores_sql(c.V1),
        drift_sql(["churn_proba"], "scores"),
        select=f"""SELECT {H('psi', 4)} AS psi, {_LEVEL} AS interpretation, coalesce(psi >= 0.2, false) AS drift_detected,
       {H('mean_ref', 4)} AS mean_ref, {H('mean_cur', 4)} AS mean_cur,
       {H('(SELECT avg(CAST(value > 0.7 AS DOUBLE)) FROM longs WHERE is_ref)', 4)} AS high_share_ref,
       {H('(SELECT avg(CAST(value > 0.7 AS DOUBLE)) FROM longs WHERE NOT is_ref)', 4)} AS high_share_cur FROM psi""",
    ),
    "churn_by_recency": c.sql(
        *c.BASE,
        c.FEATS,
        select=_BINNED.format(
            rate=_RATE,
            case="""WHEN days_since_last_order <= -1 THEN NULL WHEN days_since_last_order <= 30 THEN '<30j' WHEN days_since_last_order <= 60 THEN '30-60j'
 WHEN days_since_last_order <= 90 THEN '60-90j' WHEN days_since_last_order <= 180 THEN '90-180j' ELSE '>180j'""",
        ),
    ),
    "churn_by_frequency": c.sql(
        *c.BASE,
        c.FEATS,
        select=_BINNED.format(
            rate=_RATE,
            case="""WHEN purchase_frequency_30d <= 0 THEN NULL WHEN purchase_frequency_30d <= 1 THEN '0-1' WHEN purchase_frequency_30d <= 3 THEN '2-3'
 WHEN purchase_frequency_30d <= 5 THEN '4-5' WHEN purchase_frequency_30d <= 10 THEN '6-10' ELSE '>10'""",
        ),
    ),
    "recency_histogram": c.sql(
        *c.BASE,
        c.FEATS,
        "lim AS (SELECT CAST(min(days_since_last_order) AS DOUBLE) AS lo, (CAST(max(days_since_last_order) AS DOUBLE) - min(days_since_last_order)) / 30 AS w FROM feats)",
        select=f"""SELECT churn, CAST(b + 1 AS INT) AS bin, count(*) AS customers, {H('lo + b * w', 6)} AS bin_start
FROM (SELECT churn, lo, w, CAST(least(floor((days_since_last_order - lo) / w), 29) AS INT) AS b FROM feats, lim) GROUP BY ALL""",
    ),
    "risk_segment_counts": c.sql(
        *c.BASE,
        c.FEATS,
        select="""SELECT CASE WHEN days_since_last_order <= 30 THEN 'Actif (<30j)' WHEN days_since_last_order <= 60 THEN 'Modéré (30-60j)'
 WHEN days_since_last_order <= 90 THEN 'Inactif (60-90j)' ELSE 'Très inactif (>90j)' END AS risk_segment, count(*) AS customers
FROM feats WHERE days_since_last_order > -1 GROUP BY 1""",
    ),
    "segment_profile": c.sql(
        *c.BASE,
        c.FEATS_LAST,
        RFM,
        select=f"""SELECT segment_name, {H('CAST(sum(churn) AS DOUBLE) / count(*)', 2)} AS churn_rate,
       {H(f'CAST(sum({_DEC}) AS DOUBLE) / count(*)', 2)} AS mean_revenue, count(customer_id) AS customers FROM segments GROUP BY segment_name""",
    ),
    "monthly_churn": c.sql(
        *c.BASE,
        c.FEATS_LAST,
        select=f"SELECT strftime(last_order_date, '%Y-%m') AS month, count(*) AS customers, {_RATE} AS churn_rate FROM feats GROUP BY 1",
    ),
    "overview_kpis": c.sql(
        *c.BASE,
        c.FEATS_LAST,
        select=f"""SELECT count(*) AS customers, {_RATE} AS churn_rate, CAST(sum({_DEC}) AS DOUBLE) / count(*) AS mean_revenue,
       count(*) FILTER (churn = 0) AS stayers, count(*) FILTER (churn = 1) AS leavers,
       CAST(sum({_DEC}) FILTER (churn = 0) AS DOUBLE) / nullif(count(*) FILTER (churn = 0), 0) AS mean_revenue_stayers,
       CAST(sum({_DEC}) FILTER (churn = 1) AS DOUBLE) / nullif(count(*) FILTER (churn = 1), 0) AS mean_revenue_leavers,
       coalesce(CAST(sum({_DEC}) FILTER (churn = 1) AS DOUBLE), 0) AS revenue_at_risk FROM feats""",
    ),
    "feature_correlation": c.sql(
        *c.BASE, c.FEATS, select=f"SELECT *, abs(correlation) AS strength FROM ({_CORR})"
    ),
    "category_importance": c.sql(
        *c.BASE,
        c.FEATS,
        f"led AS (SELECT feature, abs(correlation) AS strength FROM ({_CORR}) WHERE correlation IS NOT NULL ORDER BY strength DESC, feature LIMIT 10)",
        "fam AS ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS family, unnest({list(members)!r}) AS feature"
            for name, members in insights.FEATURE_FAMILIES.items()
        )
        + ")",
        select=f"SELECT family, {H('coalesce(sum(strength), 0)', 6)} AS importance FROM fam LEFT JOIN led USING (feature) GROUP BY family",
    ),
    "describe_features": c.sql(
        *c.BASE,
        c.FEATS,
        select=" UNION ALL ".join(
            f"""SELECT '{f}' AS feature, count({f}) AS count, {H(f'avg({f})', 4)} AS mean, {H(f'stddev_samp({f})', 4)} AS std,
       {H(f'min({f})', 4)} AS min, {H(f'max({f})', 4)} AS max, {H(f'quantile_cont(CAST({f} AS DOUBLE), 0.25)', 4)} AS q25,
       {H(f'quantile_cont(CAST({f} AS DOUBLE), 0.5)', 4)} AS q50, {H(f'quantile_cont(CAST({f} AS DOUBLE), 0.75)', 4)} AS q75 FROM feats"""
            for f in MODEL_FEATURES
        ),
    ),
    "scale_pos_weight": c.sql(
        *c.BASE,
        c.FEATS,
        select=f"""SELECT count(*) FILTER (churn = 1) AS positives, count(*) FILTER (churn = 0) AS negatives,
       {H('count(*) FILTER (churn = 0) / count(*) FILTER (churn = 1)', 3)} AS scale_pos_weight
FROM feats WHERE snapshot_date < (SELECT t FROM snap ORDER BY t DESC LIMIT 1 OFFSET 2)""",
    ),
    "roi": c.sql(
        *c.BASE,
        c.FEATS_LAST,
        c.scores_sql(c.V1),
        select=ECONOMICS.format(extra="", cases="(SELECT 0.65::DOUBLE AS success)"),
    ),
}
