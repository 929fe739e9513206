"""Projections, filters and predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from queries import common as c
from tidemark.functions.temporal import naive_utc
from tidemark.operators import contracts, drift, features as feat, insights, privacy, retention, scoring, snapshots
from tidemark.plans.feature_build import latest_snapshot as take_latest
from tidemark.plans.feature_build import reference_and_current
from tidemark.schemas import MODEL_FEATURES, RETENTION_DAYS
from tidemark.sources import star

REF = dt.datetime(1999, 7, 1)
REF_SQL = "TIMESTAMP '1999-07-01'"


def observation_cutoff(spark, sf):
    return c.tx(spark, sf).filter(F.col("order_date") <= c.ntz(REF)).select(
        "customer_id", "order_id", "order_date", "order_value"
    )


def lookback_filter(spark, sf):
    """Both closed windows from one scan."""
    when = F.col("order_date")

    def inside(days):
        return (when >= c.ntz(REF - dt.timedelta(days=days))) & (when <= c.ntz(REF))

    cents = F.round(F.col("order_value") * 100).cast("bigint")
    return (
        c.tx(spark, sf)
        .filter(inside(90))
        .groupBy("customer_id")
        .agg(
            F.count_if(inside(30)).alias("orders_30d"),
            F.count(F.lit(1)).alias("orders_90d"),
            (F.coalesce(F.sum(F.when(inside(30), cents)), F.lit(0)).cast("double") / 100.0).alias("value_30d"),
        )
    )


def eligible_population(spark, sf):
    return snapshots.eligible_population(c.tx(spark, sf), c.dates(spark, sf), c.CFG)


def retention_purge(spark, sf):
    return retention.retention_purge(
        c.tx(spark, sf), "order_date", RETENTION_DAYS["transactions"], c.as_of(spark, sf)
    ).select("customer_id", "order_id", "order_date")


def retention_trace(spark, sf):
    return retention.retention_trace(
        c.tx(spark, sf), "order_date", RETENTION_DAYS["transactions"], c.as_of(spark, sf), "transactions"
    )


def normalize_utc(spark, sf):
    """Order dates written as text: with an offset in hours and minutes, in hours, a region, none, and unreadable."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    text = (
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(day, F.lit("-03")))
        .when(F.col("o_orderkey") % 7 == 1, F.concat(F.regexp_replace(day, " ", "T"), F.lit("z")))
        .when(F.col("o_orderkey") % 7 == 2, F.concat(day, F.lit(" Asia/Tokyo")))
        .when(F.col("o_orderstatus") == "O", F.concat(day, F.lit("+02:00")))
        .when(F.col("o_orderstatus") == "F", day)
        .otherwise(F.lit("not a date"))
    )
    return star.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), naive_utc(text, "string").alias("order_date")
    )


def coerce_numeric(spark, sf):
    """Numbers inside the text of event properties; what is no number leaves the table."""
    text = F.get_json_object("props", "$.k")
    frame = star.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", "n/a").otherwise(text).alias("k")
    )
    return drift.coerce_numeric(frame, ["k"]).filter(F.col("k").isNotNull())


def latest_snapshot(spark, sf):
    return take_latest(c.features(spark, sf))


def reference_vs_current(spark, sf):
    reference, current = reference_and_current(c.features(spark, sf, "ends"))
    side = lambda df, name: df.select(F.lit(name).alias("slice"), "customer_id", "total_orders", "churn")
    return side(reference, "reference").unionByName(side(current, "current"))


def drop_direct_identifiers(spark, sf):
    """Customer names are joined on as an identifier, then removed again with its trace."""
    named = star.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("Full_Name"),
        F.col("c_mktsegment").alias("segment"),
    )
    out, dropped = privacy.drop_direct_identifiers(named)
    return out.withColumn("dropped", F.lit(",".join(dropped)))


def forbid_special_categories(spark, sf):
    customers = privacy.forbid_special_categories(star.table(spark, sf, "customer"))
    return customers.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


def feature_columns(spark, sf):
    """Non-null share of every column the model may use."""
    df = c.features(spark, sf)
    names = scoring.feature_columns(df)
    wide = df.agg(
        F.array(
            *[
                F.struct(F.lit(i + 1).alias("position"), F.lit(n).alias("feature"), F.count(n).alias("values"))
                for i, n in enumerate(names)
            ]
        ).alias("r")
    )
    return wide.select(F.inline("r"))


def fill_missing_zero(spark, sf):
    df = c.features(spark, sf)
    return scoring.fill_missing(df, scoring.feature_columns(df)).select(
        "customer_id", "snapshot_date", "avg_days_between_orders", "avg_basket_value", "max_order_value"
    )


def temporal_features(spark, sf):
    when = F.col("order_date")
    return c.tx(spark, sf).select("order_id", *feat.temporal_features(when))


def risk_level(spark, sf):
    p = F.col("churn_proba")
    return c.scores(spark, sf).select(
        "customer_id",
        "snapshot_date",
        scoring.risk_level(p).alias("level"),
        scoring.legacy_risk_level(p).alias("legacy_level"),
    )


def predicted_flag(spark, sf):
    return c.scores(spark, sf).select("customer_id", "snapshot_date", "predicted_churn", "decision_threshold")


def min_history_filter(spark, sf):
    base = feat.customer_base(c.tx(spark, sf), REF)
    return base.filter(F.col("days_since_first_order") >= 60).select(
        "customer_id", "first_order_date", "days_since_first_order"
    )


def row_contract(spark, sf):
    """Served rows, some with an impossible rate or no category count, split into good and bad."""
    rows = (
        c.features(spark, sf)
        .withColumn(
            "email_open_rate_30d",
            F.when(F.col("total_orders") > 20, F.lit(1.5)).otherwise(F.col("email_open_rate_30d")),
        )
        .withColumn(
            "product_category_diversity",
            F.when(F.col("purchase_frequency_90d") > 0, F.col("product_category_diversity")),
        )
    )
    problems = F.concat_ws("; ", scoring.served_row_problems(rows, MODEL_FEATURES))
    return rows.select("customer_id", "snapshot_date", problems.alias("problems")).withColumn(
        "status", F.when(F.col("problems") == "", "scorable").otherwise("quarantined")
    )


def bounded_sample(spark, sf):
    return insights.bounded_sample(c.features(spark, sf), 1000, ["customer_id", "snapshot_date"])


def quality_warnings(spark, sf):
    return contracts.quality_warnings(c.tx(spark, sf), dt.datetime(2001, 6, 1))


QUERIES = {
    f.__name__: f
    for f in (
        observation_cutoff,
        lookback_filter,
        eligible_population,
        retention_purge,
        retention_trace,
        normalize_utc,
        coerce_numeric,
        latest_snapshot,
        reference_vs_current,
        drop_direct_identifiers,
        forbid_special_categories,
        feature_columns,
        fill_missing_zero,
        temporal_features,
        risk_level,
        predicted_flag,
        min_history_filter,
        row_contract,
        bounded_sample,
        quality_warnings,
    )
}

_RULES = []
for _name in MODEL_FEATURES:
    from tidemark.schemas import NULLABLE_SERVED_FEATURES as _OPTIONAL
    from tidemark.schemas import SERVED_ROW_BOUNDS as _BOUNDS

    _lo, _hi = _BOUNDS.get(_name, (None, None))
    if _name not in _OPTIONAL:
        _RULES.append(f"CASE WHEN {_name} IS NULL THEN '{_name}: null' END")
    if _lo is not None:
        _RULES.append(f"CASE WHEN {_name} < {_lo} THEN '{_name}: under {_lo}' END")
    if _hi is not None:
        _RULES.append(f"CASE WHEN {_name} > {_hi} THEN '{_name}: over {_hi}' END")

ORACLES = {
    "observation_cutoff": c.sql(
        c.TX, select=f"SELECT customer_id, order_id, order_date, order_value FROM tx WHERE order_date <= {REF_SQL}"
    ),
    "lookback_filter": c.sql(
        c.TX,
        select=f"""SELECT customer_id, count(*) FILTER (order_date >= {REF_SQL} - INTERVAL 30 DAY) AS orders_30d,
       count(*) AS orders_90d,
       coalesce(CAST(sum(CAST(order_value AS DECIMAL(18,2))) FILTER (order_date >= {REF_SQL} - INTERVAL 30 DAY) AS DOUBLE), 0) AS value_30d
FROM tx WHERE order_date BETWEEN {REF_SQL} - INTERVAL 90 DAY AND {REF_SQL} GROUP BY customer_id""",
    ),
    "eligible_population": c.sql(
        *c.BASE,
        select="""SELECT DISTINCT customer_id, t AS snapshot_date FROM tx JOIN snap
ON order_date > t - INTERVAL 180 DAY AND order_date <= t""",
    ),
    "retention_purge": c.sql(
        c.TX,
        select="""SELECT customer_id, order_id, order_date FROM tx
WHERE order_date IS NULL OR order_date >= (SELECT max(order_date) FROM tx) - INTERVAL 1095 DAY""",
    ),
    "retention_trace": c.sql(
        c.TX,
        select="""SELECT 'transactions' AS dataset, 1095 AS retention_days, count(*) AS rows_before,
       count(*) FILTER (keep) AS rows_after, count(*) FILTER (NOT keep) AS rows_purged
FROM (SELECT order_date >= (SELECT max(order_date) FROM tx) - INTERVAL 1095 DAY AS keep FROM tx)""",
    ),
    "normalize_utc": """SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL 3 HOUR WHEN o_orderkey % 7 = 1 THEN o_orderdate WHEN o_orderkey % 7 = 2 THEN o_orderdate - INTERVAL 9 HOUR
            WHEN o_orderstatus = 'O' THEN o_orderdate - INTERVAL 2 HOUR WHEN o_orderstatus = 'F' THEN o_orderdate END AS order_date
FROM orders""",
    "coerce_numeric": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events
WHERE event_type <> 'error' AND json_extract_string(props, '$.k') IS NOT NULL""",
    "latest_snapshot": c.sql(*c.BASE, c.FEATS_LAST, select="SELECT * EXCLUDE (snapshot_date) FROM feats"),
    "reference_vs_current": c.sql(
        *c.BASE,
        c.FEATS_ENDS,
        select="""SELECT CASE WHEN snapshot_date = (SELECT min(t) FROM snap) THEN 'reference' ELSE 'current' END AS slice,
       customer_id, total_orders, churn FROM feats""",
    ),
    "drop_direct_identifiers": "SELECT c_custkey AS customer_id, c_mktsegment AS segment, 'Full_Name' AS dropped FROM customer",
    "forbid_special_categories": "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment",
    "feature_columns": c.sql(
        *c.BASE,
        c.FEATS,
        select=" UNION ALL ".join(
            f"SELECT {i + 1} AS position, '{n}' AS feature, count({n}) AS values FROM feats"
            for i, n in enumerate(MODEL_FEATURES)
        ),
    ),
    "fill_missing_zero": c.sql(
        *c.BASE,
        c.FEATS,
        select="""SELECT customer_id, snapshot_date, coalesce(avg_days_between_orders, 0) AS avg_days_between_orders,
       coalesce(avg_basket_value, 0) AS avg_basket_value, coalesce(max_order_value, 0) AS max_order_value FROM feats""",
    ),
    "temporal_features": c.sql(
        c.TX,
        select="""SELECT order_id, CAST(month(order_date) AS INT) AS month, CAST(isodow(order_date) - 1 AS INT) AS day_of_week,
       CAST(month(order_date) IN (11, 12) AS INT) AS is_holiday_season FROM tx""",
    ),
    "risk_level": c.sql(
        *c.BASE,
        c.FEATS,
        c.scores_sql(c.V1),
        select="""SELECT customer_id, snapshot_date,
       CASE WHEN churn_proba >= 0.7 THEN 'eleve' WHEN churn_proba >= 0.4 THEN 'moyen' ELSE 'faible' END AS level,
       CASE WHEN churn_proba > 0.7 THEN 'high' WHEN churn_proba > 0.4 THEN 'medium' ELSE 'low' END AS legacy_level
FROM scores""",
    ),
    "predicted_flag": c.sql(
        *c.BASE,
        c.FEATS,
        c.scores_sql(c.V1),
        select="SELECT customer_id, snapshot_date, predicted_churn, decision_threshold FROM scores",
    ),
    "min_history_filter": c.sql(
        c.TX,
        select=f"""SELECT * FROM (SELECT customer_id, min(order_date) AS first_order_date,
       CAST(date_sub('day', min(order_date), {REF_SQL}) AS INT) AS days_since_first_order
FROM tx WHERE order_date <= {REF_SQL} GROUP BY customer_id) WHERE days_since_first_order >= 60""",
    ),
    "row_contract": c.sql(
        *c.BASE,
        c.FEATS,
        "served AS (SELECT * REPLACE (CASE WHEN total_orders > 20 THEN 1.5 ELSE email_open_rate_30d END AS email_open_rate_30d, "
        "CASE WHEN purchase_frequency_90d > 0 THEN product_category_diversity END AS product_category_diversity) FROM feats)",
        select=f"""SELECT customer_id, snapshot_date, problems,
       CASE WHEN problems = '' THEN 'scorable' ELSE 'quarantined' END AS status
FROM (SELECT customer_id, snapshot_date, concat_ws('; ', {', '.join(_RULES)}) AS problems FROM served)""",
    ),
    "bounded_sample": c.sql(
        *c.BASE,
        c.FEATS,
        select="""SELECT * FROM feats ORDER BY md5(customer_id || '|' || snapshot_date), customer_id, snapshot_date LIMIT 1000""",
    ),
    "quality_warnings": c.sql(
        c.TX,
        select="""SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates, CAST(sum(neg) AS BIGINT) AS negative_values,
       CAST(coalesce(sum(n) FILTER (order_date > TIMESTAMP '2001-06-01'), 0) AS BIGINT) AS future_dates
FROM (SELECT customer_id, order_date, count(*) AS n, count(*) FILTER (order_value < 0) AS neg FROM tx GROUP BY ALL)""",
    ),
}
