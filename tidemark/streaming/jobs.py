"""Structured Streaming forms of scoring, activity, labels, consent and ingest.

Every job is a DataFrame-to-DataFrame transformation that ``runs`` drives over what the
source holds, or a function of a stream and the job's folder. A job called again with its
folder goes on where it was stopped.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.numeric import half_even
from tidemark.operators import consent
from tidemark.operators.scoring import LinearScorer, risk_level, served_row_problems
from tidemark.schemas import EVENTS, MODEL_FEATURES
from tidemark.streaming import runs

DAY = "1 day"
#: Event time of the row that ends a replay; its own window never closes.
END = dt.datetime(9000, 1, 1)


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The events table as a stream, with event time as an instant."""
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events*.parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))


def replay_available(events: DataFrame, job: Callable[[DataFrame], DataFrame], folder: str) -> DataFrame:
    """``job`` over all events, windows still open at the end included; see ``runs.replay``."""
    return runs.replay(events, job, folder, "ts", END)


# -------------------------------------------------------------------- scoring


def score_stream(
    rows: DataFrame,
    model: LinearScorer,
    threshold: float,
    features: Sequence[str] = MODEL_FEATURES,
    keys: Sequence[str] = ("customer_id", "snapshot_date"),
) -> DataFrame:
    """Contract-checked scores; rows breaking the contract carry reasons and no score."""
    problems = F.concat_ws("; ", served_row_problems(rows, features))
    ok = F.col("problems") == ""
    p = F.col("_p")
    return (
        rows.withColumn("problems", problems)
        .withColumn("_p", F.when(ok, model.probability()))
        .select(
            *keys,
            half_even(p, 4).alias("churn_proba"),
            F.when(ok, risk_level(p)).alias("risk_level"),
            (p >= threshold).cast("int").alias("predicted_churn"),
            F.lit(model.version).alias("model_version"),
            F.lit(float(threshold)).alias("decision_threshold"),
            "problems",
            F.when(ok, "scored").otherwise("quarantined").alias("status"),
        )
    )


def score_into(
    rows: DataFrame, model: LinearScorer, threshold: float, folder: str, features: Sequence[str] = MODEL_FEATURES, keys: Sequence[str] = ("customer_id", "snapshot_date")
) -> StreamingQuery:
    """Start scoring a stream into two tables, ``folder/scored`` and ``folder/quarantined``.

    Each micro-batch is scored once and written to both under its number, so one that is run again
    after a failure replaces its own rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = score_stream(batch, model, threshold, features, keys).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for status in ("scored", "quarantined"):
                runs.replace_batch(scored.where(F.col("status") == status), f"{folder}/{status}", batch_id)
        finally:
            scored.unpersist()

    return runs.start_batches(rows, folder, write)


# ------------------------------------------------------------------- activity


def daily_activity(events: DataFrame, delay: str = DAY) -> DataFrame:
    """Counts and amounts per user and day; a day closes ``delay`` after its end.

    The aggregate is combined before it reaches the state store, so a very
    active user costs one state row per day.
    """
    purchase = F.col("event_type") == "purchase"
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", DAY).alias("w"), "user_id")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(purchase).alias("purchases"),
            F.sum(F.when(purchase, F.round(F.col("value") * 100).cast("bigint"))).alias("cents"),
        )
        .select(
            "user_id",
            F.col("w.start").cast("timestamp_ntz").alias("day"),
            "events",
            "purchases",
            (F.coalesce("cents", F.lit(0)).cast("double") / 100.0).alias("purchase_value"),
        )
    )


def sliding_activity(events: DataFrame, span: str = "7 days", step: str = DAY, delay: str = DAY) -> DataFrame:
    """Event counts per user over sliding windows."""
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", span, step).alias("w"), "user_id")
        .agg(F.count(F.lit(1)).alias("events"))
        .select("user_id", F.col("w.end").cast("timestamp_ntz").alias("window_end"), "events")
    )


# --------------------------------------------------------------------- labels


def label_maturity(events: DataFrame, outcome_days: int = 5, delay: str = DAY) -> DataFrame:
    """Daily scored users left-joined to the days they purchase on afterwards.

    A user active on a day is scored at its end ``t``; the outcome window is
    ``(t, t + outcome_days]``. Both sides are first folded to one row per user
    and day, so a user with very many events meets at most ``outcome_days``
    rows. A row without a purchase appears only once the watermark has passed
    the window: until then the label is not known to be 1.

    Windows are cut one microsecond late, which makes a day ``(start, end]``.
    """
    shifted = events.withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 MICROSECOND")).withWatermark("ts", delay)

    def per_day(rows: DataFrame, prefix: str) -> DataFrame:
        return (
            rows.groupBy(F.window("ts", DAY).alias("w"), F.col("user_id").alias(f"{prefix}_user"))
            .agg(F.count(F.lit(1)).alias(f"{prefix}_n"))
            .select(f"{prefix}_user", F.window_time("w").alias(f"{prefix}_at"))
        )

    scored = per_day(shifted, "s")
    bought = per_day(shifted.filter(F.col("event_type") == "purchase"), "p")
    after = (
        (F.col("s_user") == F.col("p_user"))
        & (F.col("p_at") > F.col("s_at"))
        & (F.col("p_at") <= F.col("s_at") + F.expr(f"INTERVAL {outcome_days} DAYS"))
    )
    return scored.join(bought, after, "left_outer").select(
        F.col("s_user").alias("user_id"),
        (F.col("s_at") + F.expr("INTERVAL 1 MICROSECOND")).cast("timestamp_ntz").alias("scored_at"),
        F.col("p_at").isNotNull().alias("purchased"),
    )


def matured_labels(rows: DataFrame) -> DataFrame:
    """One label per scored (user, time): 0 with any purchase, else 1."""
    return rows.groupBy("user_id", "scored_at").agg(
        (~F.bool_or("purchased")).cast("int").alias("churn")
    )


# -------------------------------------------------------------------- consent

def consent_state(events: DataFrame) -> DataFrame:
    """Latest objection and withdrawal per (customer, purpose), to be written in update mode.

    ``events`` is (customer_id, purpose, kind, at). Events are combined before they reach
    the state store, which holds two instants a key.
    """
    kind, at = F.col("kind"), F.col("at")
    return events.groupBy("customer_id", "purpose").agg(
        F.max(F.when(kind == "objection", at)).alias("objection_at"),
        F.max(F.when(kind == "withdrawal", at)).alias("withdrawn_at"),
    )


def consent_into(events: DataFrame, folder: str) -> StreamingQuery:
    """Start keeping the consent state of a stream in ``folder/state``: one row a key, in the newest version."""
    return runs.start_batches(
        consent_state(events), folder, lambda batch, batch_id: runs.upsert(batch, f"{folder}/state", batch_id, ["customer_id", "purpose"]), "update"
    )


def current_consent(spark: SparkSession, folder: str, customer_type: str = "bigint") -> DataFrame:
    """The state ``consent_into`` has reached, instants as wall clock."""
    schema = T.StructType.fromDDL(f"customer_id {customer_type}, purpose string, objection_at timestamp, withdrawn_at timestamp")
    at = {c: F.col(c).cast("timestamp_ntz") for c in ("objection_at", "withdrawn_at")}
    return runs.newest(spark, f"{folder}/state", schema).withColumns(at)


def consent_registry(registry: DataFrame, states: DataFrame) -> DataFrame:
    """The registry after the streamed events: an objection may add a person, a withdrawal never does."""
    events = states.select(
        "customer_id",
        "purpose",
        F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("at")) for k, c in (("objection", "objection_at"), ("withdrawal", "withdrawn_at"))])),
    )
    return consent.apply_events(registry, events.where("at is not null"))


def consent_events(events: DataFrame, purpose: str = "marketing_email") -> DataFrame:
    """The event stream read as consent events: errors object, signups withdraw."""
    kind = F.when(F.col("event_type") == "error", "objection").when(
        F.col("event_type") == "signup", "withdrawal"
    )
    return events.withColumn("kind", kind).filter(F.col("kind").isNotNull()).select(
        F.col("user_id").alias("customer_id"), F.lit(purpose).alias("purpose"), "kind", F.col("ts").alias("at")
    )


# --------------------------------------------------------------------- ingest


def dedup(events: DataFrame, keys: Sequence[str] = ("event_id",), delay: str = DAY) -> DataFrame:
    """Exact repeats arriving within the watermark are dropped."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))
