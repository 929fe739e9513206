"""Scans, sources and sinks: each query writes and reads back through the connector."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from queries import common as c
from tidemark.operators import contracts, journal, metrics, retention
from tidemark.plans.feature_build import snapshot_report
from tidemark.schemas import CONSENT, TRANSACTIONS
from tidemark.session import scratch_path
from tidemark.sources import files, star

_NUMERIC_ID = T.StructField("customer_id", T.LongType())


def _with_numeric_id(schema: T.StructType) -> T.StructType:
    return T.StructType([_NUMERIC_ID, *[f for f in schema.fields if f.name != "customer_id"]])


def scan_transactions(spark, sf):
    path = scratch_path(spark, "transactions")
    schema = _with_numeric_id(TRANSACTIONS)
    files.write_csv(c.tx(spark, sf).select(*schema.fieldNames()), path)
    return files.read_transactions(spark, path, schema, fmt="csv")


def check_required_columns(spark, sf):
    tx = contracts.check_required_columns(c.tx(spark, sf))
    return tx.groupBy("product_category").agg(F.count(F.lit(1)).alias("rows"))


def stage_daily_parquet(spark, sf):
    path = scratch_path(spark, "staging")
    tx = c.tx(spark, sf).select("customer_id", "order_date", "order_value")
    for day in (dt.date(2001, 8, 1), dt.date(2001, 8, 2), dt.date(2001, 8, 2)):
        files.stage_daily(tx, path, day)
    return spark.read.parquet(path).filter(F.col("ds") == F.lit("2001-08-02").cast("date"))


def features_sink(spark, sf):
    path = scratch_path(spark, "features")
    files.write_features(c.features(spark, sf), path)
    return files.read_features(spark, path)


def scan_consent(spark, sf):
    path = scratch_path(spark, "consent")
    files.write_csv(star.consent_registry(spark, sf), path)
    return files.read_consent(spark, path, schema=_with_numeric_id(CONSENT))


def pending_erasures(spark, sf):
    return retention.pending_erasures(star.erasure_requests(spark, sf))


def scores_sink(spark, sf):
    path = scratch_path(spark, "scores")
    files.write_scores(c.scores(spark, sf), path)
    back = spark.read.parquet(path)
    return back.groupBy("scored_on", "risk_level").agg(
        F.count(F.lit(1)).alias("customers"), F.max("churn_proba").alias("max_proba")
    )


def calibration_sink(spark, sf):
    path = scratch_path(spark, "calibration")
    table = metrics.calibration_table(c.scores(spark, sf))
    files.write_csv(table, path, single_file=True)
    return files.read_csv(spark, path, table.schema)


def json_reports(spark, sf):
    path = scratch_path(spark, "report")
    report = snapshot_report(c.features(spark, sf)).filter(F.col("snapshot_date").isNotNull())
    nested = report.select(
        F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot"),
        F.struct("population", "leavers", "churn_rate").alias("detail"),
    )
    files.write_json_report(nested, path)
    back = files.read_json_report(spark, path, nested.schema)
    return back.select("snapshot", "detail.*")


def journal_entries(spark, sf):
    """One journal per customer, one entry per order."""
    orders = star.table(spark, sf, "orders")
    return orders.select(
        F.col("o_custkey").alias("journal_id"),
        F.col("o_orderdate").alias("at"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit("order").alias("event"),
        F.lit("churn_scoring").alias("purpose"),
        F.col("o_orderstatus").alias("outcome"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("priority"),
    )


def journal_lines(spark, sf):
    return journal.append(
        journal_entries(spark, sf), order_by=["at", "order_id"], details=["order_id", "priority"], host="spark", pid=1
    )


def scan_bad_records(spark, sf):
    """Orders written as text without flags, in three date forms; the amount of every 50th order is no number."""
    path = scratch_path(spark, "texts")
    day, key = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.col("o_orderkey")
    star.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        key.cast("string").alias("order_id"),
        F.when(key % 3 == 0, F.concat(day, F.lit("+02"))).when(key % 3 == 1, day).otherwise("soon").alias("order_date"),
        F.when(key % 50 == 0, "free").otherwise(F.col("o_totalprice").cast("string")).alias("order_value"),
        F.col("o_orderpriority").alias("product_category"),
    ).write.option("header", "true").csv(path)
    schema = T.StructType([_NUMERIC_ID, T.StructField("order_id", T.LongType()), *[f for f in TRANSACTIONS.fields if f.name != "customer_id"]])
    checked = files.read_checked(spark, path, schema, ["customer_id", "order_date"])
    return checked.withColumn(files.PROBLEMS, F.concat_ws(",", files.PROBLEMS))


def scan_journal(spark, sf):
    """Journals of each order status, written as JSONL files and read back."""
    path = scratch_path(spark, "journals")
    entries = journal_entries(spark, sf).withColumn("journal_id", F.col("outcome"))
    lines = journal.append(entries, order_by=["at", "order_id"], details=["order_id", "priority"], host="spark", pid=1)
    journal.write_journal_files(lines, path)
    back = journal.read_entries(journal.read_journal_files(spark, path, folders=True))
    return back.select(
        F.regexp_extract("journal_id", "journal_id=([^/]*)/", 1).alias("journal_id"),
        "seq",
        "timestamp",
        "event",
        "purpose",
        "outcome",
        "host",
        "pid",
        F.col("details")["order_id"].alias("order_id"),
        F.col("details")["priority"].alias("priority"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        scan_transactions,
        check_required_columns,
        stage_daily_parquet,
        features_sink,
        scan_consent,
        pending_erasures,
        scores_sink,
        calibration_sink,
        json_reports,
        scan_bad_records,
        scan_journal,
    )
}

CALIBRATION = f"""
SELECT bucket, customers, {c.half_even('pm', 4)} AS mean_predicted, {c.half_even('om', 4)} AS observed_rate,
       {c.half_even('om - pm', 4)} AS gap
FROM (SELECT CAST(bucket AS INT) AS bucket, count(*) AS customers,
             CAST(sum(CAST(churn_proba AS DECIMAL(9,4))) AS DOUBLE) / count(*) AS pm,
             CAST(sum(churn) AS DOUBLE) / count(*) AS om
      FROM (SELECT *, CASE WHEN churn_proba <= 0.1::DOUBLE THEN 1 {' '.join(f'WHEN churn_proba <= {i * 0.1!r}::DOUBLE THEN {i}' for i in range(2, 10))} ELSE 10 END AS bucket FROM scores)
      GROUP BY bucket)"""

ORACLES = {
    "scan_transactions": c.sql(
        c.TX,
        select="""SELECT customer_id, order_date, order_value, product_category, email_opened, website_visit, cart_abandoned FROM tx""",
    ),
    "check_required_columns": c.sql(
        c.TX, select="SELECT product_category, count(*) AS rows FROM tx GROUP BY product_category"
    ),
    "stage_daily_parquet": c.sql(
        c.TX, select="SELECT customer_id, order_date, order_value, DATE '2001-08-02' AS ds FROM tx"
    ),
    "features_sink": c.sql(*c.BASE, c.FEATS, select="SELECT * FROM feats"),
    "scan_consent": c.sql(c.CONSENT, select="SELECT * FROM consent"),
    "pending_erasures": "SELECT count(*) AS pending FROM customer WHERE c_custkey % 97 = 0 AND c_custkey % 2 = 0",
    "scores_sink": c.sql(
        *c.BASE,
        c.FEATS,
        c.scores_sql(c.V1),
        select="""SELECT CAST(scored_at AS DATE) AS scored_on, risk_level, count(*) AS customers, max(churn_proba) AS max_proba
FROM scores GROUP BY ALL""",
    ),
    "calibration_sink": c.sql(*c.BASE, c.FEATS, c.scores_sql(c.V1), select=CALIBRATION),
    "json_reports": c.sql(
        *c.BASE,
        c.FEATS,
        select=f"""SELECT strftime(snapshot_date, '%Y-%m-%d') AS snapshot, count(*) AS population,
       CAST(sum(churn) AS BIGINT) AS leavers, {c.half_even('sum(churn) / count(*)', 4)} AS churn_rate
FROM feats GROUP BY snapshot_date""",
    ),
    "scan_bad_records": """SELECT o_custkey AS customer_id, o_orderkey AS order_id,
       CASE o_orderkey % 3 WHEN 0 THEN o_orderdate - INTERVAL 2 HOUR WHEN 1 THEN o_orderdate END AS order_date,
       CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice END AS order_value, o_orderpriority AS product_category,
       concat_ws(',', CASE WHEN o_orderkey % 3 = 2 THEN 'order_date' END, CASE WHEN o_orderkey % 50 = 0 THEN 'order_value' END) AS unreadable
FROM orders""",
    "scan_journal": """SELECT o_orderstatus AS journal_id,
       row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) - 1 AS seq,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS timestamp, 'order' AS event, 'churn_scoring' AS purpose,
       o_orderstatus AS outcome, 'spark' AS host, CAST(1 AS BIGINT) AS pid, CAST(o_orderkey AS VARCHAR) AS order_id, o_orderpriority AS priority
FROM orders""",
}
