"""Distribution shift between a reference slice and a current slice.

All features share the passes of ``quantiles.profiles``: quantile edges and the
Kolmogorov-Smirnov distance come from cell counts that are cut finer only where the
answer can still change, so no value is shuffled and nothing is written.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.frames import side_by_side
from tidemark.functions.numeric import half_even
from tidemark.operators.quantiles import Profile, profiles, ranks_of, two_sides

# fixed values
PSI_STABLE = 0.10
PSI_MODERATE = 0.25
PSI_FLOOR = 1e-6
DRIFT_THRESHOLD = 0.20
KS_MIN_ROWS = 20


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text or number columns as doubles; what does not parse becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def _levels(buckets: int) -> list[float]:
    return [i * (1.0 / buckets) for i in range(buckets)] + [1.0]


def _bin_shares(table: DataFrame, inner: dict[int, list[float]]) -> dict[int, list[tuple[int, int]]]:
    """Rows of both sides per bin between the inner edges, in order; one row per column and bin leaves a task."""
    if not inner:
        return {}
    most = max(map(len, inner.values()))
    names = [f"e{k}" for k in range(most)]
    listed = [(i, *edges, *[None] * (most - len(edges))) for i, edges in inner.items()]
    edges = table.sparkSession.createDataFrame(listed, ", ".join(["i int", *[f"{n} double" for n in names]]))
    bin_ = sum((F.when(F.col("x") >= F.col(n), 1).otherwise(0) for n in names), F.lit(0))
    ours = F.when(F.col("side") == 0, 1).otherwise(0)
    counted = (
        table.where("x is not null")
        .join(F.broadcast(edges), "i")
        .groupBy("i", bin_.alias("bin"))
        .agg(F.sum(ours).alias("r"), F.sum(1 - ours).alias("c"))
    )
    out: dict[int, list[tuple[int, int]]] = {i: [] for i in inner}
    for i, _, r, c in sorted(map(tuple, counted.collect())):
        out[i].append((r, c))
    return out


def _stability(table: DataFrame, known: Sequence[Profile], buckets: int) -> list[float | None]:
    edges = {i: sorted({p.quantile(q) for q in _levels(buckets)}) for i, p in enumerate(known) if all(p.rows)}
    shares = _bin_shares(table, {i: e[1:-1] for i, e in edges.items() if len(e) >= 3})
    out: list[float | None] = []
    for i, p in enumerate(known):
        if not all(p.rows):
            out.append(None)
        elif i not in shares:
            close = abs(p.mean[0] - p.mean[1]) <= 1e-8 + 1e-5 * abs(p.mean[1])
            out.append(0.0 if close else 1.0)
        else:  # a bin with no row on either side would add nothing
            both = [(max(r / p.rows[0], PSI_FLOOR), max(c / p.rows[1], PSI_FLOOR)) for r, c in shares[i]]
            out.append(sum((c - r) * math.log(c / r) for r, c in both))
    return out


def psi(
    reference: DataFrame, current: DataFrame, features: Sequence[str], buckets: int = 10
) -> DataFrame:
    """Population stability index per feature, with row counts and means.

    Bins are ``[a, b)`` between the reference quantiles, open at both ends. A
    feature with fewer than three distinct edges is judged on its mean: 0 when
    close, 1 when not. Null when a side is empty.
    """
    with two_sides(reference, current, features) as table:
        known = profiles(table, features, lambda n: ranks_of(n, _levels(buckets)))
        values = _stability(table, known, buckets)
    rows = [(p.feature, v, *p.rows, *p.mean) for p, v in zip(known, values)]
    return reference.sparkSession.createDataFrame(
        rows, "feature string, psi double, rows_ref bigint, rows_cur bigint, mean_ref double, mean_cur double"
    )


def interpretation(value: Column) -> Column:
    return (
        F.when(value.isNull(), "indeterminé")
        .when(value < PSI_STABLE, "stable")
        .when(value < PSI_MODERATE, "dérive modérée")
        .otherwise("dérive significative")
    )


def ks_p_value(distance: float, n: int, m: int) -> float | None:
    """The Kolmogorov series at ``sqrt(n m / (n + m)) * D``; none unless both slices have more than 20 rows."""
    if min(n, m) <= KS_MIN_ROWS:
        return None
    x = math.sqrt(n * m / (n + m)) * distance
    if x < 0.2:  # the alternating series converges slowly near zero, where the value is 1
        return 1.0
    series = sum(2.0 * (-1) ** (k - 1) * math.exp(-2.0 * k * k * x * x) for k in range(1, 101))
    return max(0.0, min(1.0, series))


def ks_distance(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per feature and its asymptotic p-value; both null when a side is empty."""
    with two_sides(reference, current, features) as table:
        known = profiles(table, features, with_distance=True)
    rows = [(p.feature, *p.rows, p.distance, ks_p_value(p.distance, *p.rows)) if all(p.rows) else (p.feature, *p.rows, None, None) for p in known]
    return reference.sparkSession.createDataFrame(
        rows, "feature string, rows_ref bigint, rows_cur bigint, ks_distance double, ks_pvalue double"
    )


def feature_drift(
    reference: DataFrame, current: DataFrame, features: Sequence[str], threshold: float = DRIFT_THRESHOLD, buckets: int = 10
) -> DataFrame:
    """The drift report: one row per requested feature, largest index first.

    The Kolmogorov-Smirnov p-value stands beside the index as a second look and decides nothing. ``reference_rows``
    and ``current_rows`` are those of the slices. A feature absent from a slice is reported, with
    null index.
    """
    both = [f for f in features if f in reference.columns and f in current.columns]
    known, values = [], {}
    if both:
        with two_sides(reference, current, both) as table:
            known = profiles(table, both, lambda n: ranks_of(n, _levels(buckets)), with_distance=True)
            values = dict(zip(both, _stability(table, known, buckets)))
        sizes = known[0].slice_rows
    else:
        sizes = (reference.count(), current.count())
    found = {p.feature: p for p in known}
    rows = []
    for f in features:
        p = found.get(f)
        ks = ks_p_value(p.distance, *p.rows) if p and all(p.rows) else None
        rows.append((f, p is None, values.get(f), ks, *(p.mean if p else (None, None)), *sizes))
    listed = reference.sparkSession.createDataFrame(
        rows,
        "feature string, absent boolean, psi double, ks_pvalue double, mean_ref double, mean_cur double, reference_rows bigint, current_rows bigint",
    )
    value = F.col("psi")
    return listed.select(
        "feature",
        half_even(value, 4).alias("psi"),
        F.when(F.col("absent"), "absente").otherwise(interpretation(value)).alias("interpretation"),
        (F.coalesce(half_even(value, 4), F.lit(0.0)) >= threshold).alias("drifted"),
        half_even(F.col("ks_pvalue"), 6).alias("ks_pvalue"),
        half_even(F.col("mean_ref"), 4).alias("mean_ref"),
        half_even(F.col("mean_cur"), 4).alias("mean_cur"),
        "reference_rows",
        "current_rows",
    ).orderBy(F.coalesce("psi", F.lit(0.0)).desc(), "feature")


def drift_summary(drift: DataFrame) -> DataFrame:
    return drift.agg(
        F.count(F.lit(1)).alias("features_analysed"),
        F.count_if("drifted").alias("features_drifted"),
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("drift_detected"),
        F.max("psi").alias("psi_max"),
    )


def prediction_drift(
    reference: DataFrame,
    current: DataFrame,
    proba: str = "churn_proba",
    threshold: float = DRIFT_THRESHOLD,
    high: float = 0.7,
) -> DataFrame:
    """Shift of the score distribution; needs no label. The high share is strictly above."""
    base = psi(reference, current, [proba])
    share = (
        reference.select(F.lit(0).alias("side"), F.col(proba).alias("p"))
        .unionByName(current.select(F.lit(1).alias("side"), F.col(proba).alias("p")))
        .agg(
            F.avg(F.when(F.col("side") == 0, (F.col("p") > high).cast("double"))).alias("high_ref"),
            F.avg(F.when(F.col("side") == 1, (F.col("p") > high).cast("double"))).alias("high_cur"),
        )
    )
    value = F.col("psi")
    return side_by_side(base, share).select(
        half_even(value, 4).alias("psi"),
        interpretation(value).alias("interpretation"),
        F.coalesce(value >= threshold, F.lit(False)).alias("drift_detected"),
        half_even(F.col("mean_ref"), 4).alias("mean_ref"),
        half_even(F.col("mean_cur"), 4).alias("mean_cur"),
        half_even(F.col("high_ref"), 4).alias("high_share_ref"),
        half_even(F.col("high_cur"), 4).alias("high_share_cur"),
    )
