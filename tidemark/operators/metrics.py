"""Classification quality of scored rows, per group, from one histogram of scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import half_even, ratio
from tidemark.operators.ordered import at_or_before, equal_slices, rows_at_ranks, running_totals
from tidemark.session import materialize

# fixed values of the default campaign
CONTACT_COST = 2.0
INCENTIVE_COST = 25.0
CUSTOMER_VALUE = 1000.0
MARGIN_RATE = 0.25
RETENTION_SUCCESS = 0.30
MAX_CONTACT_RATE = 0.35


@dataclass(frozen=True)
class CampaignEconomics:
    contact_cost: float = CONTACT_COST
    incentive_cost: float = INCENTIVE_COST
    customer_value: float = CUSTOMER_VALUE
    margin_rate: float = MARGIN_RATE
    success_rate: float = RETENTION_SUCCESS

    def net_value(self, true_positives: Column, contacted: Column) -> Column:
        """Margin on retained leavers less the cost of everyone contacted."""
        gain = (
            true_positives.cast("double")
            * F.lit(self.success_rate)
            * F.lit(self.customer_value)
            * F.lit(self.margin_rate)
        )
        return gain - contacted.cast("double") * F.lit(self.contact_cost + self.incentive_cost)


def confusion(df: DataFrame, groups: Sequence[str], predicted: Column, target: str = "churn") -> DataFrame:
    y = F.col(target) == 1
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(predicted & y).alias("tp"),
        F.count_if(predicted & ~y).alias("fp"),
        F.count_if(~predicted & y).alias("fn"),
        F.count_if(~predicted & ~y).alias("tn"),
    )


def f1_of(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(tp * 2, tp * 2 + fp + fn)


def classification_metrics(
    df: DataFrame, groups: Sequence[str], threshold: float, proba: str = "churn_proba", target: str = "churn"
) -> DataFrame:
    """F1, precision and recall per group; an empty denominator gives 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return confusion(df, groups, F.col(proba) >= threshold, target).select(
        *groups,
        "rows",
        half_even(f1_of(tp, fp, fn), 4).alias("f1"),
        half_even(ratio(tp, tp + fp), 4).alias("precision"),
        half_even(ratio(tp, tp + fn), 4).alias("recall"),
    )


def score_histogram(
    df: DataFrame, groups: Sequence[str], proba: str = "churn_proba", target: str = "churn"
) -> DataFrame:
    """Counts of leavers and stayers per distinct score."""
    return df.where(F.col(proba).isNotNull()).groupBy(*groups, F.col(proba).alias("score")).agg(
        F.count_if(F.col(target) == 1).alias("pos"), F.count_if(F.col(target) == 0).alias("neg")
    )


def roc_auc(
    df: DataFrame, groups: Sequence[str], proba: str = "churn_proba", target: str = "churn"
) -> DataFrame:
    """Exact area under the ROC curve; equal scores count one half; one class gives 0.

    Twice the number of ordered pairs is summed as an exact decimal, so neither
    rounding nor the order of the partial sums plays a part. Rows without a score are left out.
    """
    df, groups, one = _grouped(df, groups)
    return _auc(_written_histogram(df, groups, proba, target), groups).drop(*one)


def _grouped(df: DataFrame, groups: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """The frame, its group columns, and those of them made here: no group column means one group."""
    if groups:
        return df, list(groups), []
    return df.withColumn("_everything", F.lit(True)), ["_everything"], ["_everything"]


def _written_histogram(df: DataFrame, groups: Sequence[str], proba: str, target: str) -> DataFrame:
    """The histogram as a table: prefix sums read it twice, and what made the scores
    is usually a long plan that should not be optimised again at every stage."""
    return materialize(score_histogram(df, groups, proba, target), "histogram")


def _auc(hist: DataFrame, groups: Sequence[str]) -> DataFrame:
    below = running_totals(equal_slices(hist, groups, "score"), groups, "score", ["neg"])
    wide = "decimal(19,0)"
    pairs = F.col("pos").cast(wide) * (F.col("cum_neg") * 2 - F.col("neg")).cast(wide)
    sums = below.groupBy(*groups).agg(
        F.sum(pairs).alias("pairs2"), F.sum("pos").alias("p"), F.sum("neg").alias("n")
    )
    area = ratio(F.col("pairs2"), F.col("p").cast("double") * F.col("n").cast("double") * 2)
    return sums.select(*groups, half_even(area, 4).alias("roc_auc"))


def brier(
    df: DataFrame, groups: Sequence[str], proba: str = "churn_proba", target: str = "churn"
) -> DataFrame:
    error = F.pow(F.col(proba) - F.col(target), F.lit(2.0))
    return df.groupBy(*groups).agg(half_even(F.avg(error), 4).alias("brier"))


def evaluate(
    df: DataFrame,
    groups: Sequence[str],
    threshold: float,
    baseline_f1: float | None = None,
    proba: str = "churn_proba",
    target: str = "churn",
) -> DataFrame:
    """All cohort metrics and the F1 difference to a baseline.

    Everything but the area comes from the histogram that the area needs anyway.
    """
    df, groups, one = _grouped(df, groups)
    hist = _written_histogram(df, groups, proba, target)
    hit = F.col("score") >= threshold
    n = F.col("pos") + F.col("neg")
    s = F.col("score")
    squared = F.col("pos") * F.pow(s - 1, F.lit(2.0)) + F.col("neg") * F.pow(s, F.lit(2.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    basic = (
        hist.groupBy(*groups)
        .agg(
            F.sum(n).alias("rows"),
            F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
            F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"),
            F.sum(squared).alias("sq"),
            F.sum(s * n).alias("total"),
            F.sum("pos").alias("pos"),
        )
        .select(
            *groups,
            "rows",
            half_even(f1_of(tp, fp, fn), 4).alias("f1"),
            half_even(ratio(tp, tp + fp), 4).alias("precision"),
            half_even(ratio(tp, tp + fn), 4).alias("recall"),
            half_even(F.col("sq") / F.col("rows"), 4).alias("brier"),
            half_even(F.col("pos") / F.col("rows"), 4).alias("observed_rate"),
            half_even(F.col("total") / F.col("rows"), 4).alias("mean_score"),
        )
    )
    out = basic.join(_auc(hist, groups), groups)
    if baseline_f1 is not None:
        out = out.withColumn("f1_delta", half_even(F.col("f1") - F.lit(baseline_f1), 4))
    return out.drop(*one)


def calibration_table(
    df: DataFrame, groups: Sequence[str] = (), buckets: int = 10, proba: str = "churn_proba", target: str = "churn"
) -> DataFrame:
    """Predicted against observed rate per ``(a, b]`` score bucket; 0 is in the first.

    The bucket is found by comparing with the edges, not by ``ceil``: 0.3 * 10
    is not 3 in binary.
    """
    p = F.col(proba)
    step = 1.0 / buckets
    bucket = F.when(p <= step, 1)
    for i in range(2, buckets):
        bucket = bucket.when(p <= i * step, i)
    bucket = F.when((p >= 0) & (p <= 1), bucket.otherwise(buckets))
    predicted = F.sum(F.round(p * 10000).cast("bigint")).cast("double") / 10000.0 / F.count(p)
    observed = F.avg(F.col(target).cast("double"))
    return (
        df.groupBy(*groups, bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("customers"), predicted.alias("pm"), observed.alias("om"))
        .filter(F.col("bucket").isNotNull())
        .select(
            *groups,
            "bucket",
            "customers",
            half_even(F.col("pm"), 4).alias("mean_predicted"),
            half_even(F.col("om"), 4).alias("observed_rate"),
            half_even(F.col("om") - F.col("pm"), 4).alias("gap"),
        )
    )


def lift_at(
    df: DataFrame,
    fractions: Sequence[float] = (0.10, 0.20, 0.30),
    proba: str = "churn_proba",
    target: str = "churn",
    tie: Sequence[str] = ("customer_id",),
) -> DataFrame:
    """Precision and lift in the top fractions of the ranking.

    The rows at the cut ranks are located first; counting above a cut is then a
    plain conditional aggregate over unsorted rows. Rows without a score have no rank and are left out.
    """
    narrow = materialize(
        df.where(F.col(proba).isNotNull()).select((-F.col(proba)).alias("_neg"), F.col(target), *tie), "lift"
    )
    total = narrow.count()
    ks = {f: max(1, int(total * f)) for f in fractions}
    cuts = rows_at_ranks(narrow, {"score": "_neg"}, tie, lambda n: list(ks.values()))["score"]
    y = F.col(target).cast("bigint")
    aggs = [F.sum(y).alias("pos"), F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(fractions):
        above = at_or_before(narrow, F.col("_neg"), tie, cuts[ks[f]])
        aggs.append(F.sum(F.when(above, y).otherwise(0)).alias(f"hit{i}"))
    one = narrow.agg(*aggs)
    base = F.col("pos") / F.col("n")
    rows = F.array(
        *[
            F.struct(
                F.lit(int(f * 100)).alias("top_percent"),
                F.lit(ks[f]).cast("bigint").alias("k"),
                half_even(F.col(f"hit{i}") / F.lit(ks[f]), 4).alias("precision_at_k"),
                half_even(ratio(F.col(f"hit{i}") / F.lit(ks[f]), base), 4).alias("lift_at_k"),
                half_even(base, 4).alias("base_rate"),
            )
            for i, f in enumerate(fractions)
        ]
    )
    return one.select(F.inline(rows))


def _sweep(
    df: DataFrame,
    groups: Sequence[str],
    economics: CampaignEconomics = CampaignEconomics(),
    max_contact_rate: float = MAX_CONTACT_RATE,
    proba: str = "churn_proba",
    target: str = "churn",
) -> DataFrame:
    """Counts and unrounded net value per threshold, those within the capacity only."""
    start, step = 0.05, (0.05 + 0.01) - 0.05
    grid = [start + i * step for i in range(91)]
    # Index of the highest threshold not above the score: arithmetic, then corrected by one step.
    score = F.col(proba)
    guess = F.floor((score - start) / step).cast("int")
    limits = F.lit(grid)
    at = lambda i: F.get(limits, i)
    g = F.greatest(F.lit(-1), F.least(F.lit(90), guess))
    slot = (
        F.when((g < 90) & (score >= at(g + 1)), g + 1)
        .when((g >= 0) & (score < at(g)), g - 1)
        .otherwise(g)
    )
    # The interval is a function of the score: 92 counts a group and task are all that is exchanged.
    known = df.where(score.isNotNull() & F.col(target).isin(0, 1))
    counted = materialize(
        known.groupBy(*groups, slot.alias("slot")).agg(F.count_if(F.col(target) == 1).alias("pos"), F.count(F.lit(1)).alias("n")),
        "threshold-counts",
    )
    # Every threshold gets a row even where no score falls between it and the next.
    axis = counted.groupBy(*groups).agg(F.sum("n").alias("total")).select(
        *groups,
        F.explode(F.sequence(F.lit(0), F.lit(90))).alias("slot"),
        F.lit(0).cast("bigint").alias("pos"),
        F.lit(0).cast("bigint").alias("n"),
    )
    above = (
        Window.partitionBy(*groups).orderBy(F.desc("slot")).rangeBetween(
            Window.unboundedPreceding, Window.currentRow
        )
    )
    whole = Window.partitionBy(*groups)
    swept = (
        counted.unionByName(axis)
        .groupBy(*groups, "slot")
        .agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
        .withColumns(
            {
                "contacted": F.sum("n").over(above),
                "tp": F.sum("pos").over(above),
                "total": F.sum("n").over(whole),
            }
        )
        .filter((F.col("slot") >= 0) & (F.col("contacted") > 0))
        .filter(F.col("contacted") / F.col("total") <= max_contact_rate)
    )
    return swept.select(
        *groups,
        F.get(limits, F.col("slot")).alias("threshold"),
        "contacted",
        (F.col("contacted") / F.col("total")).alias("contact_rate"),
        (F.col("tp") / F.col("contacted")).alias("precision"),
        economics.net_value(F.col("tp"), F.col("contacted")).alias("net_value"),
    )


#: Decimals of the reported figures.
_SHOWN = {"threshold": 2, "contact_rate": 4, "precision": 4, "net_value": 2}


def _shown(swept: DataFrame) -> DataFrame:
    return swept.withColumns({n: half_even(F.col(n), d) for n, d in _SHOWN.items()})


def threshold_sweep(
    df: DataFrame,
    groups: Sequence[str],
    economics: CampaignEconomics = CampaignEconomics(),
    max_contact_rate: float = MAX_CONTACT_RATE,
    proba: str = "churn_proba",
    target: str = "churn",
) -> DataFrame:
    """The 91 thresholds 0.05 .. 0.95 with contact rate, precision and net value.

    Scores are counted once per threshold interval and accumulated from the top;
    the data is read once, not 91 times. Thresholds contacting nobody or more
    than the capacity are left out.
    """
    df, groups, one = _grouped(df, groups)
    return _shown(_sweep(df, groups, economics, max_contact_rate, proba, target)).drop(*one)


def best_threshold(
    df: DataFrame,
    groups: Sequence[str],
    economics: CampaignEconomics = CampaignEconomics(),
    max_contact_rate: float = MAX_CONTACT_RATE,
    proba: str = "churn_proba",
    target: str = "churn",
) -> DataFrame:
    """The sweep's row of highest net value, lowest threshold first; 0.5 where none fits."""
    df, groups, one = _grouped(df, groups)
    swept = _sweep(df, groups, economics, max_contact_rate, proba, target)
    order = Window.partitionBy(*groups).orderBy(F.desc("net_value"), F.asc("threshold"))
    best = _shown(swept.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r"))
    everyone = df.select(*groups).distinct()
    return everyone.join(best, groups, "left").select(
        *groups,
        F.coalesce("threshold", F.lit(0.5)).alias("threshold"),
        F.col("threshold").isNull().alias("fallback"),
        "contact_rate",
        "precision",
        "net_value",
    ).drop(*one)


def campaign_value(
    df: DataFrame, groups: Sequence[str], threshold: float, economics: CampaignEconomics = CampaignEconomics()
) -> DataFrame:
    """Net value of contacting everyone at or above a threshold."""
    hit = F.col("churn_proba") >= threshold
    return (
        df.groupBy(*groups)
        .agg(
            F.count_if(hit).alias("contacted"),
            F.count_if(hit & (F.col("churn") == 1)).alias("true_positives"),
        )
        .withColumn("net_value", half_even(economics.net_value(F.col("true_positives"), F.col("contacted")), 2))
    )


def class_weight(df: DataFrame, target: str = "churn", groups: Sequence[str] = ()) -> DataFrame:
    """Stayers per leaver, for re-weighting the rarer class."""
    return (
        df.groupBy(*groups)
        .agg(F.count_if(F.col(target) == 1).alias("positives"), F.count_if(F.col(target) == 0).alias("negatives"))
        .withColumn("scale_pos_weight", half_even(F.try_divide(F.col("negatives"), F.col("positives")), 3))
    )
