"""Data contracts and leak checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from queries import common as c
from tidemark.operators import contracts, features as feat
from tidemark.schemas import MODEL_FEATURES
from tidemark.session import materialize

TODAY = dt.datetime(2001, 6, 1)


def contract_transactions(spark, sf):
    """Checked as of a day before the last orders, so one warning fails."""
    return contracts.contract_transactions(c.tx(spark, sf), TODAY)


def contract_features(spark, sf):
    return contracts.contract_features(materialize(c.features(spark, sf), "features"), MODEL_FEATURES)


def contract_status(spark, sf):
    return contracts.report_status(contracts.contract_transactions(c.tx(spark, sf), TODAY))


def contract_scoring(spark, sf):
    """Served rows in the trained order, then with two columns swapped."""
    df = c.features(spark, sf, "latest")
    swapped = [*MODEL_FEATURES[1::-1], *MODEL_FEATURES[2:]]
    good = contracts.contract_scoring(df, MODEL_FEATURES).withColumn("served", F.lit("as trained"))
    bad = contracts.contract_scoring(df.select("customer_id", *swapped), MODEL_FEATURES)
    return good.unionByName(bad.withColumn("served", F.lit("swapped")))


def temporal_leak_guard(spark, sf):
    return contracts.temporal_leak_guard(c.features(spark, sf))


def leak_invariance(spark, sf):
    """Features of one date computed with and without the later orders; no row may differ."""
    dates = c.dates(spark, sf)
    at = dates[len(dates) // 2]
    tx = c.tx(spark, sf)
    columns = ["customer_id", *MODEL_FEATURES]
    whole = feat.snapshot_dataset(tx, [at], c.CFG).select(*columns)
    known = feat.snapshot_dataset(tx.filter(F.col("order_date") <= c.ntz(at)), [at], c.CFG).select(*columns)
    return (
        whole.exceptAll(known)
        .unionAll(known.exceptAll(whole))
        .agg(F.count(F.lit(1)).alias("differing_rows"))
    )


QUERIES = {
    f.__name__: f
    for f in (
        contract_transactions,
        contract_features,
        contract_status,
        contract_scoring,
        temporal_leak_guard,
        leak_invariance,
    )
}


def _rows(checks: list[tuple[str, bool, str]], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS name, {str(blocking).lower()} AS blocking, {rule} AS passed, CAST(NULL AS VARCHAR) AS error FROM {source}"
        for name, blocking, rule in checks
    )


_TX_CHECKS = [
    ("required_columns", True, "count(*) >= 0"),
    ("not_empty", True, "count(*) > 0"),
    ("customer_id_present", True, "count(*) = count(customer_id)"),
    ("dates_parse", True, "count(*) = count(order_date)"),
    ("amounts_not_negative", True, "count(*) = count(*) FILTER (order_value >= 0)"),
    ("no_future_order", False, "max(order_date) <= TIMESTAMP '2001-06-02'"),
    ("few_duplicates", False, "1 - (SELECT count(*) FROM (SELECT DISTINCT * FROM tx)) / count(*) < 0.01"),
]
_RATE = "(SELECT max(r) - min(r) FROM (SELECT avg(churn) AS r FROM feats GROUP BY snapshot_date))"
_COLUMNS = [
    "customer_id", "first_order_date", "last_order_date", *MODEL_FEATURES, "churn", "snapshot_date",
]
_NULLS = ", ".join(f"1 - count({n}) / count(*)" for n in _COLUMNS)
_FEATURE_CHECKS = [
    ("not_empty", True, "count(*) > 0"),
    ("unique_key", True, "count(*) >= 0 AND (SELECT max(n) FROM (SELECT count(*) AS n FROM feats GROUP BY customer_id, snapshot_date)) <= 1"),
    ("several_snapshots", True, "count(DISTINCT snapshot_date) >= 3"),
    ("stable_rate_between_snapshots", True, f"count(*) >= 0 AND {_RATE} < 0.25"),
    ("label_present", True, "count(*) >= 0"),
    ("label_binary", True, "count(*) FILTER (churn NOT IN (0, 1)) = 0"),
    ("two_classes", True, "count(DISTINCT churn) = 2"),
    ("recency_not_negative", True, "min(days_since_last_order) >= 0"),
    ("first_order_before_last", True, "count(*) FILTER (days_since_first_order < days_since_last_order) = 0"),
    ("revenue_not_negative", True, "min(total_revenue) >= 0"),
    ("reasonable_balance", False, "avg(churn) BETWEEN 0.02 AND 0.98"),
    ("few_missing_values", False, f"greatest({_NULLS}) < 0.5"),
    ("stable_schema", True, "count(*) >= 0"),
]
_SCORING_CHECKS = [
    ("no_infinite_value", True, "count(*) FILTER (isinf(avg_days_between_orders) OR isinf(total_revenue)) = 0"),
    ("recency_not_negative", True, "min(days_since_last_order) >= 0"),
]

ORACLES = {
    "contract_transactions": c.sql(c.TX, select=_rows(_TX_CHECKS, "tx")),
    "contract_features": c.sql(*c.BASE, c.FEATS, select=_rows(_FEATURE_CHECKS, "feats")),
    "contract_status": c.sql(
        c.TX,
        select=f"""SELECT count(*) AS expectations, count(*) FILTER (passed) AS passed,
       count(*) FILTER (NOT passed AND blocking) AS blocking_failures, count(*) FILTER (NOT passed AND NOT blocking) AS warnings,
       CASE WHEN count(*) FILTER (NOT passed AND blocking) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM ({_rows(_TX_CHECKS, 'tx')})""",
    ),
    "contract_scoring": c.sql(
        *c.BASE,
        c.FEATS_LAST,
        select=" UNION ALL ".join(
            f"""SELECT *, '{kind}' AS served FROM ({_rows([('schema_as_trained', True, f'count(*) >= 0 AND {same}'), *_SCORING_CHECKS], 'feats')})"""
            for kind, same in (("as trained", "true"), ("swapped", "false"))
        ),
    ),
    "temporal_leak_guard": c.sql(
        *c.BASE,
        c.FEATS,
        select="""SELECT count(*) FILTER (days_since_last_order < 0) AS negative_days_since_last_order,
       count(*) FILTER (days_since_first_order < 0) AS negative_days_since_first_order FROM feats""",
    ),
    "leak_invariance": c.sql(
        *c.BASE,
        "one AS (SELECT t FROM snap ORDER BY t LIMIT 1 OFFSET (SELECT count(*) // 2 FROM snap))",
        "known AS (SELECT * FROM tx WHERE order_date <= (SELECT t FROM one))",
        c.feats_sql(snap="one", name="a"),
        c.feats_sql(tx="known", snap="one", name="b"),
        select="""SELECT count(*) AS differing_rows FROM (
  (SELECT * EXCLUDE (churn) FROM a EXCEPT ALL SELECT * EXCLUDE (churn) FROM b)
  UNION ALL (SELECT * EXCLUDE (churn) FROM b EXCEPT ALL SELECT * EXCLUDE (churn) FROM a))""",
    ),
}
