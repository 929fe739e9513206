"""Adapters from the star-schema test tables to the library's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with engagement flags derived from the order key."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        key.alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("order_value"),
        F.col("o_orderpriority").alias("product_category"),
        (key % 5 < 2).cast("int").alias("email_opened"),
        (key % 7 < 4).cast("int").alias("website_visit"),
        (key % 10 < 2).cast("int").alias("cart_abandoned"),
    )


def line_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, with a refund flag; many rows share an instant."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    net = (
        F.col("l_extendedprice").cast("decimal(12,2)")
        * (F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)"))
    ).cast("decimal(18,4)")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            F.round(net, 2).cast("double").alias("order_value"),
            F.col("p_type").alias("product_category"),
            (F.col("l_returnflag") == "R").alias("is_refund"),
        )
    )


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with sub-day instants; only purchases carry a value."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("order_date"),
        F.when(kind == "purchase", F.col("value")).alias("order_value"),
        kind.alias("product_category"),
        (kind == "click").cast("int").alias("email_opened"),
        (kind == "view").cast("int").alias("website_visit"),
        (kind == "error").cast("int").alias("cart_abandoned"),
    )


def consent_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry row per (customer, purpose), derived from the orders table."""
    cust = F.col("customer_id")
    purpose = F.col("purpose")
    seen = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.max("o_orderdate").alias("last_seen")
    )
    purposes = F.array(*[F.lit(p) for p in ("churn_scoring", "marketing_email", "marketing_sms")])
    opted = (
        F.when(purpose == "marketing_email", (cust * 7919) % 101 < 63)
        .when(purpose == "marketing_sms", (cust * 104729) % 103 < 29)
        .otherwise(F.lit(False))
    )

    def back(modulus: int):
        return F.col("last_seen") - F.make_dt_interval((cust % modulus).cast("int"))

    rows = (
        seen.select("customer_id", "last_seen", F.explode(purposes).alias("purpose"))
        .withColumn("opt_in", opted)
        .withColumn("consent_date", F.when(F.col("opt_in"), back(900)))
        .withColumn(
            "objection_at",
            F.when((purpose == "churn_scoring") & ((cust * 15485863) % 89 < 3), back(200)),
        )
    )
    return rows.select(
        "customer_id",
        "purpose",
        "opt_in",
        "consent_date",
        F.when(F.col("opt_in"), "formulaire_web").otherwise("aucun").alias("consent_source"),
        F.when(F.col("opt_in"), F.concat(F.lit("v"), (1 + cust % 2).cast("string"))).alias(
            "consent_wording_version"
        ),
        F.when(
            F.col("opt_in") & ((cust * 1299709) % 97 < 8),
            F.col("consent_date") + F.make_dt_interval((30 + cust % 370).cast("int")),
        ).alias("withdrawn_at"),
        "objection_at",
    )


def erasure_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers asking for erasure; odd keys are already handled by a model version."""
    cust = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .filter(cust % 97 == 0)
        .select(
            cust.alias("customer_id"),
            F.when(cust % 2 != 0, "v0001").alias("processed_in_model_version"),
        )
    )
