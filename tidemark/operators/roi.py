"""Campaign return, scenarios and a month-by-month timeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import half_even

# fixed values
SCENARIOS = (("optimistic", 0.80), ("realistic", 0.65), ("pessimistic", 0.50))
RAMP_MONTHS = 6


@dataclass(frozen=True)
class RoiConfig:
    project_cost: float = 25000.0
    customer_value: float = 1000.0
    contact_cost: float = 15.0
    success_rate: float = 0.65
    initial_churn_rate: float = 0.18
    threshold: float = 0.7
    horizon_months: int = 12


def at_risk(scores: DataFrame, threshold: float) -> DataFrame:
    """Customers scored and customers at or above the threshold; the only pass over the data."""
    return scores.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("churn_proba") >= threshold).alias("at_risk_customers"),
    )


def _economics(base: DataFrame, cfg: RoiConfig, success: Column) -> DataFrame:
    cost = F.lit(cfg.project_cost)
    out = (
        base.withColumn("saved_customers", F.floor(F.col("at_risk_customers") * success).cast("bigint"))
        .withColumn("revenue_saved", F.col("saved_customers") * F.lit(cfg.customer_value))
        .withColumn("campaign_cost", F.col("at_risk_customers") * F.lit(cfg.contact_cost))
        .withColumn("net_benefit", F.col("revenue_saved") - F.col("campaign_cost") - cost)
    )
    monthly = (F.col("revenue_saved") - F.col("campaign_cost")) / F.lit(float(cfg.horizon_months))
    reduction = F.lit(cfg.initial_churn_rate) * F.try_divide(
        F.col("saved_customers"), F.col("total_customers")
    )
    return out.withColumns(
        {
            "roi_percentage": half_even(F.col("net_benefit") / cost * 100, 4)
            if cfg.project_cost > 0
            else F.lit(0.0),
            "new_churn_rate": half_even(F.lit(cfg.initial_churn_rate) - reduction, 6),
            "churn_reduction": half_even(reduction, 6),
            "campaign_roi": half_even(
                F.coalesce(F.try_divide(F.col("revenue_saved"), F.col("campaign_cost")), F.lit(0.0)), 4
            ),
            "payback_months": half_even(F.when(monthly > 0, cost / monthly), 4),
        }
    )


def roi(scores: DataFrame, cfg: RoiConfig = RoiConfig()) -> DataFrame:
    """Simple return: the success rate applies to everyone targeted.

    ``payback_months`` is null where the campaign never pays back.
    """
    return _economics(at_risk(scores, cfg.threshold), cfg, F.lit(cfg.success_rate))


def roi_scenarios(scores: DataFrame, cfg: RoiConfig = RoiConfig()) -> DataFrame:
    cases = F.array(
        *[F.struct(F.lit(n).alias("scenario"), F.lit(r).alias("success_rate")) for n, r in SCENARIOS]
    )
    base = at_risk(scores, cfg.threshold).select("*", F.inline(cases))
    return _economics(base, cfg, F.col("success_rate"))


def roi_timeline(scores: DataFrame, cfg: RoiConfig = RoiConfig()) -> DataFrame:
    """Monthly savings ramp up linearly over half a year; costs are even."""
    months = cfg.horizon_months
    saved = F.floor(F.col("at_risk_customers") * F.lit(cfg.success_rate)).cast("bigint")
    reduction = F.lit(cfg.initial_churn_rate) * F.try_divide(saved, F.col("total_customers"))
    line = at_risk(scores, cfg.threshold).select(
        (saved * F.lit(cfg.customer_value)).alias("revenue"),
        (F.col("at_risk_customers") * F.lit(cfg.contact_cost)).alias("cost"),
        reduction.alias("reduction"),
        F.explode(F.sequence(F.lit(1), F.lit(months))).alias("month"),
    )
    ramp = F.least(F.lit(1.0), F.col("month") / F.lit(float(RAMP_MONTHS)))
    so_far = Window.partitionBy("revenue", "cost").orderBy("month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    gain = F.col("revenue") / F.lit(float(months)) * ramp
    out = line.select(
        "month",
        F.concat(F.lit("M"), F.col("month").cast("string")).alias("month_label"),
        half_even(F.lit(cfg.initial_churn_rate) - F.col("reduction") * ramp, 6).alias("churn_rate"),
        half_even(gain, 4).alias("monthly_revenue_saved"),
        half_even(F.sum(gain).over(so_far), 4).alias("cumulative_revenue_saved"),
        half_even(
            F.lit(cfg.project_cost) + F.sum(F.col("cost") / F.lit(float(months))).over(so_far), 4
        ).alias("cumulative_cost"),
    )
    net = F.col("cumulative_revenue_saved") - F.col("cumulative_cost")
    percent = net / F.lit(cfg.project_cost) * 100 if cfg.project_cost > 0 else F.lit(0.0)
    return out.withColumns({"net_benefit": half_even(net, 4), "roi": half_even(percent, 4)})
