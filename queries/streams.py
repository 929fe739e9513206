"""Structured Streaming jobs replayed over everything available."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import common as c
from queries.governance import ORACLES as _GOVERNANCE
from queries.projections import _RULES
from tidemark.session import scratch_path
from tidemark.sources import star
from tidemark.streaming import jobs, runs

PURCHASE_DAYS = 5


def stream_score(spark, sf):
    """Feature rows written by the batch replay, read back as a stream and scored."""
    path = scratch_path(spark, "served")
    rows = c.features(spark, sf).withColumn(
        "email_open_rate_30d",
        F.when(F.col("total_orders") > 20, F.lit(1.5)).otherwise(F.col("email_open_rate_30d")),
    )
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    folder = scratch_path(spark, "stream-score")
    runs.finish(jobs.score_into(stream, c.V1, c.THRESHOLD, folder))
    schema = jobs.score_stream(rows, c.V1, c.THRESHOLD).schema
    tables = [runs.read_batches(spark, f"{folder}/{status}", schema) for status in ("scored", "quarantined")]
    return tables[0].unionByName(tables[1])


def stream_daily_activity(spark, sf):
    return jobs.replay_available(jobs.event_stream(spark, sf), jobs.daily_activity, scratch_path(spark, "stream-daily"))


def stream_sliding_activity(spark, sf):
    return jobs.replay_available(jobs.event_stream(spark, sf), jobs.sliding_activity, scratch_path(spark, "stream-sliding"))


def stream_label_maturity(spark, sf):
    labels = jobs.label_maturity(jobs.event_stream(spark, sf), PURCHASE_DAYS)
    return jobs.matured_labels(runs.run_available(labels, scratch_path(spark, "stream-labels")))


def _consent(spark, events):
    folder = scratch_path(spark, "stream-consent")
    runs.finish(jobs.consent_into(jobs.consent_events(events), folder))
    return jobs.current_consent(spark, folder)


def stream_consent_state(spark, sf):
    return _consent(spark, jobs.event_stream(spark, sf))


def stream_consent_registry(spark, sf):
    """The registry after the streamed events of users that may be unknown to it."""
    events = jobs.event_stream(spark, sf).withColumn("user_id", F.col("user_id") * 20)
    return jobs.consent_registry(star.consent_registry(spark, sf), _consent(spark, events))


def stream_dedup(spark, sf):
    """Every event delivered twice."""
    twice = jobs.event_stream(spark, sf).unionByName(jobs.event_stream(spark, sf))
    out = runs.run_available(jobs.dedup(twice), scratch_path(spark, "stream-dedup"))
    return out.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value")


QUERIES = {
    f.__name__: f
    for f in (
        stream_score,
        stream_daily_activity,
        stream_sliding_activity,
        stream_label_maturity,
        stream_consent_state,
        stream_consent_registry,
        stream_dedup,
    )
}

_MARK = "mark AS (SELECT max(ts) - INTERVAL 1 DAY AS wm FROM events)"

ORACLES = {
    "stream_score": c.sql(
        *c.BASE,
        c.FEATS,
        "served AS (SELECT * REPLACE (CASE WHEN total_orders > 20 THEN 1.5 ELSE email_open_rate_30d END AS email_open_rate_30d) FROM feats)",
        f"""judged AS (SELECT customer_id, snapshot_date, concat_ws('; ', {', '.join(_RULES)}) AS problems,
  1.0::DOUBLE / (1.0::DOUBLE + exp(-({c.linear_sql(c.V1)}))) AS p FROM served)""",
        select=f"""SELECT customer_id, snapshot_date, CASE WHEN ok THEN {c.half_even('p', 4)} END AS churn_proba,
       CASE WHEN ok THEN CASE WHEN p >= 0.7 THEN 'eleve' WHEN p >= 0.4 THEN 'moyen' ELSE 'faible' END END AS risk_level,
       CASE WHEN ok THEN CAST(p >= {c.THRESHOLD!r} AS INT) END AS predicted_churn, '{c.V1.version}' AS model_version,
       {c.THRESHOLD!r}::DOUBLE AS decision_threshold, problems, CASE WHEN ok THEN 'scored' ELSE 'quarantined' END AS status
FROM (SELECT *, problems = '' AS ok FROM judged)""",
    ),
    "stream_daily_activity": """SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS events, count(*) FILTER (event_type = 'purchase') AS purchases,
       coalesce(CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'purchase') AS DOUBLE), 0) AS purchase_value
FROM events GROUP BY 1, 2""",
    "stream_sliding_activity": """SELECT user_id, d + CAST(i AS INT) * INTERVAL 1 DAY AS window_end, count(*) AS events
FROM (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS d FROM events), (SELECT unnest(range(1, 8)) AS i) GROUP BY 1, 2""",
    "stream_label_maturity": c.sql(
        _MARK.replace("max(ts) - INTERVAL 1 DAY", "max(ts) - INTERVAL 1 MICROSECOND - INTERVAL 1 DAY"),
        """days AS (SELECT DISTINCT user_id, event_type = 'purchase' AS bought,
  date_trunc('day', ts - INTERVAL 1 MICROSECOND)::TIMESTAMP + INTERVAL 1 DAY AS closes FROM events)""",
        "closed AS (SELECT days.* FROM days, mark WHERE closes <= wm)",
        f"""scored AS (SELECT s.user_id, s.closes AS scored_at, EXISTS (SELECT 1 FROM closed p WHERE p.bought AND p.user_id = s.user_id
  AND p.closes > s.closes AND p.closes <= s.closes + INTERVAL {PURCHASE_DAYS} DAY) AS back
  FROM (SELECT DISTINCT user_id, closes FROM closed) s)""",
        select=f"""SELECT user_id, scored_at, CAST(NOT back AS INT) AS churn FROM scored, mark
WHERE back OR scored_at + INTERVAL {PURCHASE_DAYS} DAY <= wm""",
    ),
    "stream_consent_state": """SELECT user_id AS customer_id, 'marketing_email' AS purpose, max(ts) FILTER (event_type = 'error') AS objection_at,
       max(ts) FILTER (event_type = 'signup') AS withdrawn_at FROM events WHERE event_type IN ('error', 'signup') GROUP BY user_id""",
    "stream_consent_registry": _GOVERNANCE["apply_consent_events"],
    "stream_dedup": "SELECT event_id, ts, user_id, event_type, value FROM events",
}
