"""Point-in-time replay: snapshot dates, grid cells and the snapshot calendar.

All windows around a snapshot ``t`` are whole numbers of days, so their ends
lie on a daily grid through ``t``. A transaction is therefore described fully,
for every window of every snapshot, by its *grid position*: ``2k`` if it falls
exactly on grid point ``k`` and ``2k + 1`` if it falls strictly between ``k``
and ``k + 1``. Closed and half-open window ends become integer comparisons.

Two things follow. A customer has at most two positions per calendar day, so
whatever a customer's number of orders is, their history after one partial
aggregation is bounded by the calendar. And the range join "orders near a
snapshot" becomes an expansion in place: the snapshots that reach a position are a
run of the sorted dates, looked up in a literal table (``with_snapshots``).
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SnapshotConfig:
    outcome_days: int = 30
    activity_days: int = 180
    min_history_days: int = 180
    short_days: int = 30
    long_days: int = 90
    frequency: str = "month"  # "month" (month starts) or "week" (every 7 days)
    #: Decimals amounts are given in; sums are then exact. None: plain doubles.
    amount_decimals: int | None = 2


class PeriodTooShortError(ValueError):
    """The history does not cover one snapshot and its outcome window."""


def date_bounds(tx: DataFrame, column: str = "order_date") -> tuple[dt.datetime, dt.datetime]:
    row = tx.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    if row is None or row.lo is None:
        raise PeriodTooShortError("no dated transaction")
    return row.lo, row.hi


def month_starts(start: dt.datetime, end: dt.datetime) -> list[dt.datetime]:
    """First days of months in ``[start, end]``, at the time of day of ``start``."""
    at = start
    if at.day != 1:
        at = (at.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    out = []
    while at <= end:
        out.append(at)
        at = (at + dt.timedelta(days=32)).replace(day=1)
    return out


def snapshot_dates(tx: DataFrame, cfg: SnapshotConfig = SnapshotConfig()) -> list[dt.datetime]:
    """Usable replay dates: enough history before, a whole outcome window after."""
    lo, hi = date_bounds(tx)
    start = lo + dt.timedelta(days=cfg.min_history_days)
    end = hi - dt.timedelta(days=cfg.outcome_days)
    if start >= end:
        raise PeriodTooShortError(
            f"history {lo:%Y-%m-%d}..{hi:%Y-%m-%d} is shorter than "
            f"{cfg.min_history_days + cfg.outcome_days} days"
        )
    if cfg.frequency == "week":
        steps = (end - start).days // 7
        return [start + dt.timedelta(days=7 * i) for i in range(steps + 1)]
    return month_starts(start, end) or [start]


def snapshot_frame(spark: SparkSession, dates: Iterable[dt.datetime]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in dates], "snapshot_date timestamp_ntz")


# ------------------------------------------------------------------- the grid


def _midnight_offset(at: dt.datetime) -> dt.timedelta:
    return at - at.replace(hour=0, minute=0, second=0, microsecond=0)


def _grid_origin(at: dt.datetime) -> dt.datetime:
    return dt.datetime(1000, 1, 1) + _midnight_offset(at)


def grid_point(at: dt.datetime) -> int:
    return (at - _grid_origin(at)).days


def _origin_literal(at: dt.datetime) -> Column:
    return F.lit(_grid_origin(at).isoformat(sep=" ")).cast("timestamp_ntz")


def grid_position(instant: Column, at: dt.datetime) -> Column:
    """Position of ``instant`` on the daily grid through ``at``."""
    origin = _origin_literal(at)
    since = instant - origin
    day = F.extract(F.lit("DAY"), since)
    exact = since == F.make_dt_interval(day)
    return (day.cast("bigint") * 2 + F.when(exact, 0).otherwise(1)).cast("bigint")


def by_time_of_day(dates: Iterable[dt.datetime]) -> list[list[dt.datetime]]:
    """Dates that can share one grid, i.e. have the same time of day."""
    groups: dict[dt.timedelta, list[dt.datetime]] = defaultdict(list)
    for at in sorted(set(dates)):
        groups[_midnight_offset(at)].append(at)
    return list(groups.values())


def with_snapshots(
    df: DataFrame, dates: list[dt.datetime], cfg: SnapshotConfig, past_days: int | None = None, outcome: bool = True
) -> DataFrame:
    """Every row of ``df`` (with a grid position ``pos``) once for each snapshot whose windows reach it, with window flags.

    The snapshots that reach a position stand next to each other in the sorted dates. Where they begin and end
    is read from a table of counts by grid point, a literal, so the expansion is an ``explode`` of a slice
    of another literal: no join, no exchange, and no limit on the number of dates. A row has as many copies as
    windows of ``past_days`` (the longest look-back unless given) and of the outcome overlap there.
    """
    points = sorted(grid_point(d) for d in dates)
    back = max(cfg.activity_days, cfg.long_days, cfg.short_days) if past_days is None else past_days
    ahead = cfg.outcome_days if outcome else 0
    first, last = points[0], points[-1] + 1
    counts, seen = [], 0
    for k in range(first, last + 1):  # points before grid point k
        while seen < len(points) and points[seen] < k:
            seen += 1
        counts.append(seen)
    pos = F.col("pos")
    # One literal each, whatever its length; the optimiser folds the conversion.
    table, axis = (F.split(F.lit(",".join(map(str, xs))), ",").cast("array<int>") for xs in (counts, points))

    def before(position: Column) -> Column:
        """How many snapshots have a position below this one."""
        k = F.floor((position + 1) / 2)
        return F.get(table, (F.least(F.greatest(k, F.lit(first)), F.lit(last)) - first).cast("int"))

    start, end = before(pos - 2 * ahead), before(pos + 2 * back + 1)
    expanded = df.withColumns({"_from": start, "_to": end}).where(F.col("_to") > F.col("_from"))
    point = F.explode(F.slice(axis, F.col("_from") + 1, F.col("_to") - F.col("_from")))
    expanded = expanded.withColumn("_point", point).drop("_from", "_to")
    at = F.col("_point").cast("bigint") * 2
    past = pos <= at
    return expanded.withColumns(
        {
            "snapshot_date": _origin_literal(dates[0]) + F.make_dt_interval(F.col("_point")),
            "past": past,
            "in_short": past & (pos >= at - 2 * cfg.short_days),
            "in_long": past & (pos >= at - 2 * cfg.long_days),
            "in_activity": past & (pos > at - 2 * cfg.activity_days),
            "in_outcome": pos > at,
        }
    ).drop("_point")


def horizon(dates: list[dt.datetime], cfg: SnapshotConfig) -> Column:
    """Keep only what some snapshot can see; a plain comparison that reaches the scan."""
    last = max(dates) + dt.timedelta(days=cfg.outcome_days)
    return F.col("order_date") <= F.lit(last.isoformat(sep=" ")).cast("timestamp_ntz")


# ------------------------------------------------------- pieces of the replay


def positions(tx: DataFrame, dates: list[dt.datetime], cfg: SnapshotConfig) -> DataFrame:
    """Distinct (customer, grid position), combined map-side before the shuffle."""
    return (
        tx.filter(F.col("customer_id").isNotNull() & horizon(dates, cfg))
        .select("customer_id", grid_position(F.col("order_date"), dates[0]).alias("pos"))
        .distinct()
    )


def eligible_population(
    tx: DataFrame, dates: list[dt.datetime], cfg: SnapshotConfig = SnapshotConfig()
) -> DataFrame:
    """(customer, snapshot) with an order in ``(t - activity, t]``."""
    parts = [
        with_snapshots(positions(tx, group, cfg), group, cfg, cfg.activity_days, outcome=False)
        .filter("in_activity")
        .select("customer_id", "snapshot_date")
        .distinct()
        for group in by_time_of_day(dates)
    ]
    return _stack(parts)


def returned_customers(
    tx: DataFrame, dates: list[dt.datetime], cfg: SnapshotConfig = SnapshotConfig()
) -> DataFrame:
    """(customer, snapshot) with an order in ``(t, t + outcome]``."""
    parts = [
        with_snapshots(positions(tx, group, cfg), group, cfg, 0)
        .filter("in_outcome")
        .select("customer_id", "snapshot_date")
        .distinct()
        for group in by_time_of_day(dates)
    ]
    return _stack(parts)


def churn_labels(
    tx: DataFrame, dates: list[dt.datetime], cfg: SnapshotConfig = SnapshotConfig()
) -> DataFrame:
    """Label of the eligible population: 1 when no order follows in the outcome window.

    Population and outcome are two flags of the same expanded row, so one
    grouping replaces the semi-join and the anti-join.
    """
    parts = [
        with_snapshots(positions(tx, group, cfg), group, cfg, cfg.activity_days)
        .groupBy("customer_id", "snapshot_date")
        .agg(
            F.max("in_activity").alias("eligible"),
            F.max("in_outcome").alias("returned"),
        )
        .filter("eligible")
        .select(
            "customer_id", "snapshot_date", (~F.col("returned")).cast("int").alias("churn")
        )
        for group in by_time_of_day(dates)
    ]
    return _stack(parts)


def snapshot_orders(
    tx: DataFrame, dates: list[dt.datetime], cfg: SnapshotConfig = SnapshotConfig()
) -> DataFrame:
    """Orders expanded to the snapshots whose activity window holds them, aggregated.

    The expansion happens after the orders are combined per grid position.
    """
    from tidemark.functions.numeric import from_units, to_units

    parts = []
    for group in by_time_of_day(dates):
        cells = (
            tx.filter(F.col("customer_id").isNotNull() & horizon(group, cfg))
            .groupBy("customer_id", grid_position(F.col("order_date"), group[0]).alias("pos"))
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(to_units(F.col("order_value"), cfg.amount_decimals)).alias("v"),
            )
        )
        parts.append(
            with_snapshots(cells, group, cfg, cfg.activity_days, outcome=False)
            .filter("in_activity")
            .groupBy("customer_id", "snapshot_date")
            .agg(
                F.sum("n").alias("orders_in_window"),
                from_units(F.coalesce(F.sum("v"), F.lit(0)), cfg.amount_decimals).alias(
                    "value_in_window"
                ),
            )
        )
    return _stack(parts)


def asof_last_order(tx: DataFrame, dates: list[dt.datetime]) -> DataFrame:
    """Last order at or before each snapshot, for every customer known by then.

    Orders are reduced to one row per (customer, first snapshot that sees them);
    ``lead`` over those at most ``len(dates)`` rows gives the run of snapshots
    each one stays the latest for, and only that run is emitted.
    """
    from pyspark.sql import Window

    from tidemark.functions.temporal import elapsed_days

    spark = tx.sparkSession
    parts = []
    for group in by_time_of_day(dates):
        ordered = sorted(group)
        points = [2 * grid_point(d) for d in ordered]
        grid = F.lit(points)
        seen_from = F.when(
            F.col("pos") <= points[0], F.lit(0)
        ).otherwise(F.size(F.filter(grid, lambda p: p < F.col("pos"))))
        per_cell = (
            tx.filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
            .groupBy("customer_id", grid_position(F.col("order_date"), ordered[0]).alias("pos"))
            .agg(F.max("order_date").alias("last_order_date"))
            .filter(F.col("pos") <= points[-1])
        )
        runs = (
            per_cell.groupBy("customer_id", seen_from.alias("i"))
            .agg(F.max("last_order_date").alias("last_order_date"))
            .withColumn(
                "next_i",
                F.lead("i", 1, len(ordered)).over(Window.partitionBy("customer_id").orderBy("i")),
            )
        )
        axis = F.broadcast(
            spark.createDataFrame(list(enumerate(ordered)), "j int, snapshot_date timestamp_ntz")
        )
        parts.append(
            runs.withColumn("j", F.explode(F.sequence("i", F.col("next_i") - 1)))
            .join(axis, "j")
            .select(
                "customer_id",
                "snapshot_date",
                "last_order_date",
                elapsed_days(F.col("last_order_date"), F.col("snapshot_date")).alias(
                    "days_since_last_order"
                ),
            )
        )
    return _stack(parts)


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
