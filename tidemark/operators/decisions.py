"""Model life-cycle decisions as table expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import half_even

# fixed values
PRIORITIES = ("critique", "haute", "routine", "aucune")


@dataclass(frozen=True)
class RetrainingPolicy:
    performance_drop: float = 0.05
    max_age_days: int = 90
    min_drifted_features: int = 2


def retraining_decision(signals: DataFrame, policy: RetrainingPolicy = RetrainingPolicy()) -> DataFrame:
    """Priority and reasons for each row of signals.

    Signals are ``erasure_requests``, ``performance_delta``, ``features_drifted``,
    ``predictions_drifted`` and ``model_age_days``; any may be null. Erasure is a
    legal reason and outranks the others; drift counts only when features and
    scores moved together; age is routine.
    """
    erasure = F.coalesce(F.col("erasure_requests") > 0, F.lit(False))
    worse = F.coalesce(F.col("performance_delta") <= -policy.performance_drop, F.lit(False))
    moved = F.coalesce(F.col("features_drifted") >= policy.min_drifted_features, F.lit(False)) & F.coalesce(
        F.col("predictions_drifted"), F.lit(False)
    )
    old = F.coalesce(F.col("model_age_days") >= policy.max_age_days, F.lit(False))
    critical, high, routine, none = PRIORITIES
    reasons = F.array_compact(
        F.array(
            F.when(erasure, "erasure"),
            F.when(worse, "performance"),
            F.when(moved, "joint_drift"),
            F.when(old, "age"),
        )
    )
    return signals.withColumns(
        {
            "should_retrain": erasure | worse | moved | old,
            "priority": F.when(erasure, critical).when(worse | moved, high).when(old, routine).otherwise(none),
            "reasons": reasons,
        }
    )


def compare_to_champion(
    metrics: DataFrame, metric: str, champion: str | None, min_gain: float = 0.0
) -> DataFrame:
    """Each version against the one in production, on one metric of the same rows.

    With no production version the candidate is promotable. ``metrics`` has a row
    per model version.
    """
    if champion is None:
        return metrics.select(
            F.col("model_version").alias("candidate"),
            F.lit(None).cast("string").alias("champion"),
            F.col(metric).alias("candidate_value"),
            F.lit(None).cast("double").alias("champion_value"),
            F.lit(None).cast("double").alias("gain"),
            F.lit(True).alias("promote"),
        )
    # One pass: the champion's value meets every row through an unbounded frame over the versions.
    best = F.max(F.when(F.col("model_version") == champion, F.col(metric))).over(Window.partitionBy())
    gain = F.col("candidate_value") - F.col("champion_value")
    return (
        metrics.select("model_version", F.col(metric).alias("candidate_value"), best.alias("champion_value"))
        .filter(F.col("model_version") != champion)
        .select(
            F.col("model_version").alias("candidate"),
            F.lit(champion).alias("champion"),
            "candidate_value",
            "champion_value",
            half_even(gain, 4).alias("gain"),
            F.coalesce(gain > min_gain, F.lit(False)).alias("promote"),
        )
    )


def promotion_verdict(comparison: DataFrame, priority, min_gain: float = 0.0) -> DataFrame:
    """A critical priority always promotes; otherwise the comparison and its gain decide.

    A first version has no gain to show and is promoted.
    """
    first = F.col("champion").isNull()
    better = F.col("promote") & (first | F.coalesce(F.col("gain") > min_gain, F.lit(False)))
    critical = priority == PRIORITIES[0]
    return comparison.withColumns(
        {
            "priority": priority,
            "promoted": critical | better,
            "reason": F.when(critical, "legal")
            .when(first, "no_production")
            .when(better, "gain")
            .otherwise("insufficient_gain"),
        }
    )


def production_history(events: DataFrame, key: Sequence[str] = ("model_name",)) -> DataFrame:
    """Replay of promotion events (key, version, promoted_at, and ``kind`` if there are rollbacks).

    A ``rollback`` without a version re-promotes the version that was in production before, one with a version
    that version; either way the version just left is no target of the next one. A rollback with nothing to go
    back to is refused. One row an event: what it put in production, what was there (``promoted_from``), where a
    rollback would then go (``rollback_to``), and its stage. The events of one model are folded in
    order in one group: they are a handful.
    """
    kind = F.col("kind") if "kind" in events.columns else F.lit("promotion")
    event = F.struct(F.col("promoted_at").alias("at"), kind.alias("kind"), F.col("version").cast("string").alias("version"))
    text, texts = F.lit(None).cast("string"), F.array().cast("array<string>")
    logged = f"array<struct<version:string,promoted_at:{dict(events.dtypes)['promoted_at']},promoted_by:string,promoted_from:string,rollback_to:string,refused:boolean>>"
    start = F.struct(text.alias("current"), texts.alias("before"), F.lit(-1).alias("last"), F.array().cast(logged).alias("log"))

    def step(s: Column, e: Column) -> Column:
        back = e["kind"] == "rollback"
        before = s["before"]
        to = F.when(back, F.coalesce(e["version"], F.get(before, F.size(before) - 1))).otherwise(e["version"])
        place = F.coalesce(F.array_position(before, to), F.lit(0)).cast("int")
        popped = F.when(place > 0, F.slice(before, F.lit(1), place - 1)).otherwise(before)
        unnamed = F.slice(before, F.lit(1), F.greatest(F.size(before) - 1, F.lit(0)))
        pushed = F.when(s["current"].isNull(), before).otherwise(F.array_append(before, s["current"]))
        stack = F.when(to.isNull(), before).when(back & e["version"].isNull(), unnamed).when(back, popped).otherwise(pushed)
        entry = F.struct(
            to.alias("version"),
            e["at"].alias("promoted_at"),
            e["kind"].alias("promoted_by"),
            s["current"].alias("promoted_from"),
            F.get(stack, F.size(stack) - 1).alias("rollback_to"),
            to.isNull().alias("refused"),
        )
        return F.struct(
            F.coalesce(to, s["current"]).alias("current"),
            stack.alias("before"),
            F.when(to.isNull(), s["last"]).otherwise(F.size(s["log"])).alias("last"),
            F.array_append(s["log"], entry).alias("log"),
        )

    folded = events.groupBy(*key).agg(F.aggregate(F.array_sort(F.collect_list(event)), start, step).alias("s"))
    rows = folded.select(*key, F.col("s.last").alias("last"), F.posexplode("s.log").alias("i", "e"))
    stage = F.when(F.col("e.refused"), "refused").when(F.col("i") == F.col("last"), "production").otherwise("archived")
    shown = ("version", "promoted_at", "promoted_by", "promoted_from", "rollback_to")
    return rows.select(*key, *[F.col(f"e.{c}").alias(c) for c in shown], stage.alias("stage"))


def rollback_target(history: DataFrame, key: Sequence[str] = ("model_name",)) -> DataFrame:
    return history.filter(F.col("stage") == "production").select(*key, F.col("version").alias("current"), "rollback_to")
