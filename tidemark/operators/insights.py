"""Descriptive tables over a feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.binning import interval_label
from tidemark.functions.numeric import half_even
from tidemark.operators.ordered import at_or_before, rows_at_ranks
from tidemark.operators.quantiles import profiles, ranks_of, two_sides
from tidemark.session import materialize

# fixed values: bins, labels, segment codes and feature families
RECENCY_EDGES = (30, 60, 90, 180)
RECENCY_LABELS = ("<30j", "30-60j", "60-90j", "90-180j", ">180j")
FREQUENCY_EDGES = (1, 3, 5, 10)
FREQUENCY_LABELS = ("0-1", "2-3", "4-5", "6-10", ">10")
RISK_EDGES = (30, 60, 90)
RISK_LABELS = ("Actif (<30j)", "Modéré (30-60j)", "Inactif (60-90j)", "Très inactif (>90j)")
RFM_SEGMENTS = {
    "Champions": ("333", "332", "323", "322"),
    "Clients fidèles": ("313", "312", "311", "223", "222", "221"),
    "À risque": ("133", "132", "123", "122"),
    "Perdus": ("111", "112", "121", "131"),
}
RFM_OTHER = "Autres"
FEATURE_FAMILIES = {
    "Comportementales": (
        "days_since_last_order",
        "purchase_frequency_30d",
        "purchase_frequency_90d",
        "avg_basket_value",
        "avg_days_between_orders",
    ),
    "Transactionnelles": ("total_orders", "total_revenue", "avg_order_value", "max_order_value"),
    "Engagement": ("email_open_rate_30d", "website_visits_30d", "cart_abandonment_rate"),
}


def _mean(column: str, digits: int = 6) -> Column:
    return half_even(F.avg(F.col(column).cast("double")), digits)


def _cents_mean(column: str) -> Column:
    """Mean of an amount with two decimals, summed exactly."""
    cents = F.sum(F.round(F.col(column) * 100).cast("bigint"))
    return F.try_divide(cents.cast("double") / 100.0, F.count(column).cast("double"))


def _binned(df: DataFrame, label: Column) -> DataFrame:
    """Rates per bin; rows of no bin leave the table."""
    return (
        df.groupBy(label.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            _mean("churn").alias("churn_rate"),
            F.sum(F.col("churn").cast("bigint")).alias("leavers"),
            _cents_mean("total_revenue").alias("mean_revenue"),
        )
        .filter(F.col("bin").isNotNull())
    )


def churn_by_recency(df: DataFrame) -> DataFrame:
    return _binned(df, interval_label(F.col("days_since_last_order"), RECENCY_EDGES, RECENCY_LABELS, -1))


def churn_by_frequency(df: DataFrame) -> DataFrame:
    """Bins start above 0: a customer without an order in the window is in none."""
    return _binned(df, interval_label(F.col("purchase_frequency_30d"), FREQUENCY_EDGES, FREQUENCY_LABELS, 0))


def risk_segment_counts(df: DataFrame) -> DataFrame:
    label = interval_label(F.col("days_since_last_order"), RISK_EDGES, RISK_LABELS, -1)
    return df.groupBy(label.alias("risk_segment")).agg(F.count(F.lit(1)).alias("customers")).filter(
        F.col("risk_segment").isNotNull()
    )


def recency_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width counts per class; the last bin is closed on both sides.

    The range is known only after a pass, but counting per distinct age first
    makes the second pass one over a few hundred rows.
    """
    x = F.col("days_since_last_order")
    ages = df.groupBy("churn", x.alias("x")).agg(F.count(F.lit(1)).alias("n"))
    limits = ages.agg(F.min("x").cast("double").alias("lo"), F.max("x").cast("double").alias("hi")).first()
    lo, hi = limits.lo, limits.hi
    if lo is None:
        return ages.select("churn", F.lit(1).alias("bin"), F.lit(0.0).alias("bin_start"), "n").limit(0)
    width = (hi - lo) / bins or 1.0
    index = F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1)).cast("int")
    return (
        ages.groupBy("churn", (index + 1).alias("bin"))
        .agg(F.sum("n").alias("customers"))
        .withColumn("bin_start", half_even(F.lit(lo) + (F.col("bin") - 1) * F.lit(width), 6))
    )


def monthly_churn(df: DataFrame) -> DataFrame:
    month = F.date_format("last_order_date", "yyyy-MM")
    return df.groupBy(month.alias("month")).agg(
        F.count(F.lit(1)).alias("customers"), _mean("churn").alias("churn_rate")
    )


def overview_kpis(df: DataFrame) -> DataFrame:
    """Headline figures; revenue at risk is the revenue of the leavers themselves."""
    cents = F.round(F.col("total_revenue") * 100).cast("bigint")
    gone = F.col("churn") == 1

    def mean_of(cond: Column) -> Column:
        return F.try_divide(
            F.sum(F.when(cond, cents)).cast("double") / 100.0, F.count_if(cond).cast("double")
        )

    return df.agg(
        F.count(F.lit(1)).alias("customers"),
        _mean("churn").alias("churn_rate"),
        mean_of(F.lit(True)).alias("mean_revenue"),
        F.count_if(~gone).alias("stayers"),
        F.count_if(gone).alias("leavers"),
        mean_of(~gone).alias("mean_revenue_stayers"),
        mean_of(gone).alias("mean_revenue_leavers"),
        (F.coalesce(F.sum(F.when(gone, cents)), F.lit(0)).cast("double") / 100.0).alias("revenue_at_risk"),
    )


# ------------------------------------------------------------------------ RFM


def tercile_cuts(n: int) -> tuple[int, int]:
    """Ranks at which linear-quantile terciles of the ranks 1..n end."""
    third, rest = divmod(n, 3)
    extra = 1 if rest == 2 else 0
    return third + extra, 2 * third + extra


def rfm_scores(df: DataFrame, tie: Sequence[str] = ("customer_id",)) -> DataFrame:
    """Add R, F and M scores (1..3): terciles of the first-come rank, recency inverted.

    Terciles need two cut rows per dimension, not a rank for every row: the six
    cut rows are located, and each row compares itself with them.
    """
    dims = {"R": "days_since_last_order", "F": "purchase_frequency_30d", "M": "total_revenue"}
    table = materialize(df, "rfm")
    cuts = rows_at_ranks(table, dims, tie, lambda n: list(tercile_cuts(n)))

    def score(dim: str, labels: tuple[int, int, int]) -> Column:
        value = F.col(dims[dim])
        found = [cuts[dim][r] for r in sorted(cuts[dim])]
        out = F.when(value.isNull(), F.lit(None).cast("int"))
        for cut, label in zip(found, labels):
            out = out.when(at_or_before(table, value, tie, cut), label)
        return out.otherwise(labels[-1])

    return table.withColumns(
        {"R_score": score("R", (3, 2, 1)), "F_score": score("F", (1, 2, 3)), "M_score": score("M", (1, 2, 3))}
    )


def rfm_segments(scored: DataFrame) -> DataFrame:
    """Three-digit code and named segment; the first name listing a code wins."""
    code = F.concat(*[F.col(c).cast("string") for c in ("R_score", "F_score", "M_score")])
    name = F.lit(RFM_OTHER)
    for label, codes in reversed(RFM_SEGMENTS.items()):
        name = F.when(F.col("RFM_segment").isin(*codes), label).otherwise(name)
    return scored.withColumn("RFM_segment", code).withColumn("segment_name", name)


def segment_profile(segmented: DataFrame) -> DataFrame:
    return (
        segmented.groupBy("segment_name")
        .agg(
            half_even(F.avg(F.col("churn").cast("double")), 2).alias("churn_rate"),
            half_even(_cents_mean("total_revenue"), 2).alias("mean_revenue"),
            F.count("customer_id").alias("customers"),
        )
        .orderBy(F.desc("churn_rate"), "segment_name")
    )


# -------------------------------------------------- correlations, description


def _long(df: DataFrame, features: Sequence[str], *keep: Column) -> DataFrame:
    """(feature, x) rows, nulls kept.

    One small grouped aggregate over these runs in compiled code; the same
    figures as one aggregate with a column set per feature do not, and take
    three times as long. Groups are combined map-side, so each task ships one
    row per feature.
    """
    pairs = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features]
    )
    return df.select(*keep, F.inline(pairs))


def feature_correlation(
    df: DataFrame, features: Sequence[str], target: str = "churn", digits: int = 6
) -> DataFrame:
    """Pearson correlation of each feature with the label; null for a constant one.

    Rows where the feature is missing are left out of its own pair only.
    ``corr`` itself would divide by zero on a constant feature.
    """
    x, y = F.col("x"), F.col("y")
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return (
        _long(df, features, F.col(target).cast("double").alias("y"))
        .groupBy("feature")
        .agg(half_even(F.try_divide(F.covar_pop(x, y), spread), digits).alias("correlation"))
        .withColumn("strength", F.abs("correlation"))
    )


def top_features(strengths: DataFrame, by: str = "strength", n: int = 10) -> DataFrame:
    return strengths.filter(F.col(by).isNotNull()).orderBy(F.desc(by), "feature").limit(n)


def category_importance(strengths: DataFrame, top: int = 10) -> DataFrame:
    """Strengths of the leading features, summed per family; a family may have none."""
    family = F.lit(None).cast("string")
    for name, members in FEATURE_FAMILIES.items():
        family = F.when(F.col("feature").isin(*members), name).otherwise(family)
    led = (
        top_features(strengths, n=top)
        .withColumn("family", family)
        .filter(F.col("family").isNotNull())
        .groupBy("family")
        .agg(F.sum("strength").alias("importance"))
    )
    names = strengths.sparkSession.createDataFrame([(n,) for n in FEATURE_FAMILIES], "family string")
    return names.join(led, "family", "left").select(
        "family", half_even(F.coalesce("importance", F.lit(0.0)), 6).alias("importance")
    )


def describe_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per feature.

    Quartiles are interpolated linearly between exact order statistics.
    """
    levels = (0.25, 0.5, 0.75)
    with two_sides(df, None, features) as table:
        known = profiles(table, features, lambda n: ranks_of(n, levels))
        moments = (
            table.groupBy("i")
            .agg(
                F.count("x").alias("count"),
                half_even(F.avg("x"), 4).alias("mean"),
                half_even(F.stddev_samp("x"), 4).alias("std"),
                half_even(F.min("x"), 4).alias("min"),
                half_even(F.max("x"), 4).alias("max"),
            )
            .collect()
        )
    spark = df.sparkSession
    rows = []
    for i, *figures in map(tuple, moments):
        p = known[i]
        rows.append((p.feature, *figures, *(p.quantile(q) if p.rows[0] else None for q in levels)))
    names = ("count", "mean", "std", "min", "max", "q25", "q50", "q75")
    table = spark.createDataFrame(rows, ", ".join(["feature string", "count bigint", *[f"{n} double" for n in names[1:]]]))
    return table.select("feature", "count", *[half_even(F.col(n), 4).alias(n) if n.startswith("q") else n for n in names[1:]])


def bounded_sample(df: DataFrame, n: int = 1000, by: Sequence[str] = ("customer_id",)) -> DataFrame:
    """``n`` rows in the order of a digest of the key: the same rows on every run."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in by]))
    return df.orderBy(digest, *by).limit(n)
