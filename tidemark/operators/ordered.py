"""Exact order statistics without sorting everything in one task.

Two building blocks:

* ``running_totals``: prefix sums along a numeric column, per group. The rows
  are cut into contiguous buckets, summed per bucket, and shifted by the totals
  of the lower buckets. The shift is joined on the key the window is
  partitioned by, so the large side is shuffled once.
* ``rows_at_ranks``: the rows that hold given ranks of a total order. Bucket
  counts say which bucket holds a rank; only those buckets are sorted.

A value shared by many rows never makes a hot bucket: ``running_totals`` wants
its input already combined per value, and ``rows_at_ranks`` gives a repeated
split value a bucket of its own, cut further along the tie-break column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType, IntegralType

from tidemark.operators.quantiles import order_code

#: Split tables of more groups than this are joined without a broadcast hint.
SPLIT_GROUPS_LIMIT = 10_000


def _probabilities(buckets: int) -> Column:
    return F.lit([i / buckets for i in range(1, buckets)])


def quantile_bucket(
    df: DataFrame, groups: Sequence[str], value: str, n_groups: int, buckets: int = 64, accuracy: int = 1000
) -> DataFrame:
    """Add ``_bucket``: a contiguous slice of the group's values, of about equal row counts.

    The splits are one array per group. ``n_groups`` is known to the caller (a
    list of feature names, say) and bounds what is broadcast.
    """
    splits = df.groupBy(*groups).agg(
        F.percentile_approx(F.col(value).cast("double"), _probabilities(buckets), accuracy).alias("_s")
    )
    if n_groups <= SPLIT_GROUPS_LIMIT:
        splits = F.broadcast(splits)
    return (
        df.join(splits, list(groups))
        .withColumn("_bucket", F.size(F.filter("_s", lambda s: s < F.col(value))))
        .drop("_s")
    )


def equal_slices(df: DataFrame, groups: Sequence[str], value: str, rows: int = 1 << 18) -> DataFrame:
    """Add ``_bucket``: contiguous slices of the group's values with about ``rows`` rows each.

    The splits come from a mergeable quantile sketch, so slices are even however the values
    cluster; their number follows the row count. ``df`` has one row per (groups, value) and is read twice:
    pass a written table.
    """
    most = df.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0
    buckets = max(1, min(10_000, -(-most // rows)))
    if buckets == 1:
        return df.withColumn("_bucket", F.lit(0))
    return quantile_bucket(df, groups, value, SPLIT_GROUPS_LIMIT + 1, buckets, 20 * buckets)


def running_totals(
    df: DataFrame, groups: Sequence[str], value: str, measures: Sequence[str]
) -> DataFrame:
    """Add ``cum_<m>``: the inclusive prefix sum of each whole-number measure along ``value``.

    ``df`` has one row per (groups, value) and a ``_bucket`` column that never
    decreases along ``value``.
    """
    key = [*groups, "_bucket"]
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*key)
        .agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
        .select(
            *key,
            *[F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"_o_{m}") for m in measures],
        )
    )
    inside = (
        Window.partitionBy(*key)
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        df.withColumns({f"cum_{m}": F.sum(m).over(inside) for m in measures})
        .join(offsets, key)
        .withColumns({f"cum_{m}": F.col(f"cum_{m}") + F.col(f"_o_{m}") for m in measures})
        .drop("_bucket", *[f"_o_{m}" for m in measures])
    )


def tie_code(df: DataFrame, columns: Sequence[str]) -> Column:
    """A numeric tie-break: the column itself if it is one whole number, its ordered bits if it is one fraction, else its hash."""
    if len(columns) == 1:
        kind = df.schema[columns[0]].dataType
        if isinstance(kind, IntegralType) or (isinstance(kind, DecimalType) and kind.scale == 0 and kind.precision <= 18):
            return F.col(columns[0]).cast("bigint")
        if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType):
            return order_code(F.col(columns[0]).cast("double"))
    return F.xxhash64(*columns)


def _choose(dims: Sequence[str], arrays: Mapping[str, list]) -> Column:
    out = F.when(F.col("dim") == dims[0], F.lit(arrays[dims[0]]))
    for d in dims[1:]:
        out = out.when(F.col("dim") == d, F.lit(arrays[d]))
    return out


def rows_at_ranks(
    df: DataFrame,
    values: Mapping[str, str],
    tie: Sequence[str],
    ranks: Callable[[int], Sequence[int]],
    buckets: int = 128,
) -> dict[str, dict[int, tuple[float, int]]]:
    """(value, tie code) of the rows at the 1-based ``ranks(n)`` of each order (value, tie).

    ``values`` names the orders wanted; all of them share the passes over the
    data. Nulls are not ranked. Only the located pairs, the split points and the
    bucket counts come back to the driver.
    """
    dims = list(values)
    long = df.select(
        tie_code(df, tie).alias("k"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(d).alias("dim"), F.col(c).cast("double").alias("v"))
                    for d, c in values.items()
                ]
            )
        ),
    ).filter(F.col("v").isNotNull())
    cuts = {
        r.dim: r
        for r in long.groupBy("dim")
        .agg(
            F.percentile_approx("v", _probabilities(buckets), 10000).alias("v"),
            F.percentile_approx("k", _probabilities(buckets), 10000).alias("k"),
            F.count(F.lit(1)).alias("n"),
        )
        .collect()
    }
    dims = [d for d in dims if d in cuts]
    if not dims:
        return {}
    v_cuts = _choose(dims, {d: sorted(set(cuts[d].v)) for d in dims})
    k_cuts = _choose(dims, {d: sorted(set(cuts[d].k)) for d in dims})
    v, k = F.col("v"), F.col("k")
    on_cut = F.array_contains(v_cuts, v)
    cut = long.select(
        "dim",
        "v",
        "k",
        F.size(F.filter(v_cuts, lambda c: c <= v)).alias("b1"),
        F.when(on_cut, 0).otherwise(1).alias("b2"),
        F.when(on_cut, F.size(F.filter(k_cuts, lambda c: c <= k))).otherwise(0).alias("b3"),
    )
    address = ["dim", "b1", "b2", "b3"]
    counts = sorted(tuple(r) for r in cut.groupBy(*address).count().collect())
    spans: list[tuple] = []
    seen = dict.fromkeys(dims, 0)
    for dim, b1, b2, b3, n in counts:
        low = seen[dim]
        for rank in set(ranks(cuts[dim].n)):
            if low < rank <= low + n:
                spans.append((dim, b1, b2, b3, rank - low, rank))
        seen[dim] = low + n
    if not spans:
        return {d: {} for d in dims}
    kinds = {"dim": pa.string(), "b1": pa.int32(), "b2": pa.int32(), "b3": pa.int32(), "at": pa.int64(), "rank": pa.int64()}
    # An Arrow table needs no Python worker: rows would start a second pool of them on the executors.
    targets = F.broadcast(
        df.sparkSession.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(zip(*spans), kinds.values())], names=list(kinds)))
    )
    order = Window.partitionBy(*address).orderBy("v", "k")
    found = (
        cut.join(F.broadcast(targets.select(*address).distinct()), address, "left_semi")
        .withColumn("at", F.row_number().over(order).cast("bigint"))
        .join(targets, [*address, "at"])
        .select("dim", "rank", "v", "k")
        .collect()
    )
    out: dict[str, dict[int, tuple[float, int]]] = {d: {} for d in dims}
    for r in found:
        out[r.dim][r.rank] = (r.v, r.k)
    return out


def at_or_before(df: DataFrame, value: Column, tie: Sequence[str], cut: tuple[float, int]) -> Column:
    """Whether a row comes no later than ``cut`` in the order (value, tie)."""
    v, k = value.cast("double"), tie_code(df, tie)
    return (v < F.lit(cut[0])) | ((v == F.lit(cut[0])) & (k <= F.lit(cut[1])))
