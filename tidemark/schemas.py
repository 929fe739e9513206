"""Table schemas and the fixed vocabulary shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------- fixed values
# Names, labels and limits that results are compared on.

PURPOSES = ("churn_scoring", "marketing_email", "marketing_sms")

LEGAL_BASIS = {
    "churn_scoring": "interet_legitime",
    "marketing_email": "consentement",
    "marketing_sms": "consentement",
}
CONSENT_BASIS = "consentement"

DIRECT_IDENTIFIERS = (
    "email",
    "phone",
    "first_name",
    "last_name",
    "full_name",
    "address",
    "postal_address",
    "ip_address",
)

SPECIAL_CATEGORIES = (
    "health",
    "religion",
    "political_opinion",
    "trade_union",
    "sexual_orientation",
    "ethnic_origin",
    "biometric",
    "genetic",
)

JOURNAL_FORBIDDEN_KEYS = (
    "customer_id",
    "email",
    "phone",
    "first_name",
    "last_name",
    "address",
    "ip_address",
)

NON_FEATURE_COLUMNS = (
    "customer_id",
    "snapshot_date",
    "first_order_date",
    "last_order_date",
    "churn",
    "days_bin",
    "freq_bin",
    "RFM_segment",
    "segment_name",
    "R_score",
    "F_score",
    "M_score",
    "risk_segment",
)

RETENTION_DAYS = {
    "transactions": 1095,
    "consent_proof": 1825,
    "scores": 390,
    "journal": 2190,
}

CONSENT_MAX_AGE_DAYS = 750

JOURNAL_SEED = "0" * 64

# ------------------------------------------------------------------- schemas

_NTZ = T.TimestampNTZType()

TRANSACTIONS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_date", _NTZ),
        T.StructField("order_value", T.DoubleType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("email_opened", T.IntegerType()),
        T.StructField("website_visit", T.IntegerType()),
        T.StructField("cart_abandoned", T.IntegerType()),
    ]
)

REQUIRED_TRANSACTION_COLUMNS = (
    "customer_id",
    "order_date",
    "order_value",
    "product_category",
)

CONSENT = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("purpose", T.StringType()),
        T.StructField("opt_in", T.BooleanType()),
        T.StructField("consent_date", _NTZ),
        T.StructField("consent_source", T.StringType()),
        T.StructField("consent_wording_version", T.StringType()),
        T.StructField("withdrawn_at", _NTZ),
        T.StructField("objection_at", _NTZ),
    ]
)

ERASURE_REQUESTS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("processed_in_model_version", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", _NTZ),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

JOURNAL_ENTRY = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("purpose", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("pid", T.LongType()),
        T.StructField("previous_hash", T.StringType()),
        T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    ]
)

#: Model inputs in their served order.
MODEL_FEATURES = (
    "days_since_first_order",
    "days_since_last_order",
    "purchase_frequency_30d",
    "purchase_frequency_90d",
    "avg_basket_value",
    "product_category_diversity",
    "avg_days_between_orders",
    "total_revenue",
    "avg_order_value",
    "max_order_value",
    "total_orders",
    "email_open_rate_30d",
    "website_visits_30d",
    "cart_abandonment_rate",
    "month",
    "day_of_week",
    "is_holiday_season",
)

#: (low, high) limits of a served row; a feature not listed is unbounded.
SERVED_ROW_BOUNDS = {
    "days_since_first_order": (0, None),
    "days_since_last_order": (0, None),
    "purchase_frequency_30d": (0, None),
    "purchase_frequency_90d": (0, None),
    "avg_basket_value": (0, None),
    "product_category_diversity": (0, None),
    "total_revenue": (0, None),
    "avg_order_value": (0, None),
    "max_order_value": (0, None),
    "total_orders": (0, None),
    "email_open_rate_30d": (0, 1),
    "website_visits_30d": (0, None),
    "cart_abandonment_rate": (0, 1),
    "month": (1, 12),
    "day_of_week": (0, 6),
    "is_holiday_season": (0, 1),
}

#: Served features that may be absent or null; the others must have a value.
NULLABLE_SERVED_FEATURES = (
    "avg_days_between_orders",
    "email_open_rate_30d",
    "website_visits_30d",
    "cart_abandonment_rate",
)
