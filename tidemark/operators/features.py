"""Customer features, at one date or replayed at many dates in one plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import from_units, ratio, to_units
from tidemark.functions.temporal import day_of_week, elapsed_days
from tidemark.operators.snapshots import (
    SnapshotConfig,
    _stack,
    by_time_of_day,
    grid_position,
    horizon,
    with_snapshots,
)

#: Optional 0/1 inputs; the feature they feed exists only when the column does.
OPTIONAL_FLAGS = ("is_refund", "email_opened", "website_visit", "cart_abandoned")
#: Transactions whose customers are replayed in one task, and the least that are worth a task.
ROWS_A_PART, SMALL_PART = 100_000, 5_000


def _ntz(at: dt.datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def _present_flags(tx: DataFrame) -> list[str]:
    return [c for c in OPTIONAL_FLAGS if c in tx.columns]


def cells(tx: DataFrame, at: dt.datetime, cfg: SnapshotConfig) -> DataFrame:
    """Partial aggregates per (customer, grid position, category).

    This is the only place raw transactions are shuffled, on a key that splits
    even a customer holding a third of all orders, and after a map-side combine.
    """
    units = to_units(F.col("order_value"), cfg.amount_decimals)
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.min("order_date").alias("first_ts"),
        F.max("order_date").alias("last_ts"),
        F.count("order_value").alias("n_value"),
        F.sum(units).alias("sum_value"),
        F.max(units).alias("max_value"),
    ]
    for flag in _present_flags(tx):
        aggs.append(F.sum(F.col(flag).cast("int")).alias(f"{flag}_sum"))
        aggs.append(F.count(flag).alias(f"{flag}_n"))
    return (
        tx.filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
        .groupBy(
            "customer_id",
            grid_position(F.col("order_date"), at).alias("pos"),
            "product_category",
        )
        .agg(*aggs)
    )


def with_running_state(cell_rows: DataFrame) -> DataFrame:
    """Cumulative state of each customer as of each cell.

    Gaps inside a cell are shorter than a day and floor to zero, so only the
    step from the latest earlier instant counts; ``greatest`` drops the steps
    between cells that overlap (categories of one position). The RANGE frame
    includes rows of the same instant, so no tie-break column is needed. The
    partition holds cells, not orders: its size is bounded by the calendar
    times the number of categories.
    """
    earlier = (
        Window.partitionBy("customer_id")
        .orderBy("first_ts")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    so_far = (
        Window.partitionBy("customer_id")
        .orderBy("first_ts")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    gap = F.greatest(
        F.lit(0), F.coalesce(elapsed_days(F.max("last_ts").over(earlier), F.col("first_ts")), F.lit(0))
    )
    out = cell_rows.withColumn("gap_days", gap.cast("bigint"))
    cumulative = {
        "cum_rows": F.sum("n_rows").over(so_far),
        "cum_n": F.sum("n_value").over(so_far),
        "cum_sum": F.sum("sum_value").over(so_far),
        "cum_max": F.max("max_value").over(so_far),
        "cum_first": F.min("first_ts").over(so_far),
        "cum_gap": F.sum("gap_days").over(so_far),
    }
    if "is_refund_sum" in cell_rows.columns:
        cumulative["cum_refunds"] = F.sum("is_refund_sum").over(so_far)
        cumulative["cum_refund_n"] = F.sum("is_refund_n").over(so_far)
    return out.withColumns(cumulative)


def _windowed(column: str, flag: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col(flag), F.col(column))), F.lit(0))


def _per_snapshot(expanded: DataFrame) -> DataFrame:
    """Fold expanded cells to one row per (customer, snapshot)."""
    past = F.col("past")

    def latest(column: str) -> Column:
        return F.max(F.when(past, F.col(column)))

    aggs = [
        F.max("in_activity").alias("eligible"),
        F.max("in_outcome").alias("returned"),
        F.min(F.when(past, F.col("cum_first"))).alias("first_order_date"),
        latest("last_ts").alias("last_order_date"),
        latest("cum_rows").alias("cum_rows"),
        latest("cum_n").alias("cum_n"),
        F.max_by("cum_sum", F.when(past, F.col("first_ts"))).alias("cum_sum"),
        latest("cum_max").alias("cum_max"),
        latest("cum_gap").alias("cum_gap"),
        _windowed("n_rows", "in_short").alias("orders_short"),
        _windowed("n_rows", "in_long").alias("orders_long"),
        _windowed("n_value", "in_short").alias("values_short"),
        F.sum(F.when(F.col("in_short"), F.col("sum_value"))).alias("value_short"),
        F.count_distinct(F.when(F.col("in_long"), F.col("product_category"))).alias("categories"),
    ]
    columns = set(expanded.columns)
    if "cum_refunds" in columns:
        aggs += [latest("cum_refunds").alias("refunds"), latest("cum_refund_n").alias("refund_n")]
    for flag in ("email_opened", "website_visit", "cart_abandoned"):
        if f"{flag}_sum" in columns:
            aggs += [
                _windowed(f"{flag}_sum", "in_short").alias(f"{flag}_sum"),
                _windowed(f"{flag}_n", "in_short").alias(f"{flag}_n"),
            ]
    return expanded.groupBy("customer_id", "snapshot_date").agg(*aggs)


def _feature_columns(
    state: DataFrame, at: Column, cfg: SnapshotConfig, extra: list[Column]
) -> DataFrame:
    """Named features from folded state; the column order is the contract's."""
    columns = set(state.columns)
    d = cfg.amount_decimals
    total = from_units(F.coalesce(F.col("cum_sum"), F.lit(0)), d)
    short_value = from_units(F.col("value_short"), d)
    out = [
        F.col("customer_id"),
        F.col("first_order_date"),
        F.col("last_order_date"),
        elapsed_days(F.col("first_order_date"), at).cast("int").alias("days_since_first_order"),
        elapsed_days(F.col("last_order_date"), at).cast("int").alias("days_since_last_order"),
        F.col("orders_short").cast("double").alias("purchase_frequency_30d"),
        F.col("orders_long").cast("double").alias("purchase_frequency_90d"),
        ratio(short_value, F.col("values_short")).alias("avg_basket_value"),
        F.col("categories").cast("double").alias("product_category_diversity"),
        F.try_divide(F.col("cum_gap").cast("double"), (F.col("cum_rows") - 1).cast("double")).alias(
            "avg_days_between_orders"
        ),
        total.alias("total_revenue"),
        F.try_divide(total, F.col("cum_n").cast("double")).alias("avg_order_value"),
        from_units(F.col("cum_max"), d).alias("max_order_value"),
        F.col("cum_n").cast("int").alias("total_orders"),
    ]
    if "refunds" in columns:
        out.append(ratio(F.col("refunds"), F.col("refund_n")).alias("refund_rate"))
    if "email_opened_sum" in columns:
        out.append(
            ratio(F.col("email_opened_sum"), F.col("email_opened_n")).alias("email_open_rate_30d")
        )
    if "website_visit_sum" in columns:
        out.append(F.col("website_visit_sum").cast("double").alias("website_visits_30d"))
    if "cart_abandoned_sum" in columns:
        out.append(
            ratio(F.col("cart_abandoned_sum"), F.col("cart_abandoned_n")).alias(
                "cart_abandonment_rate"
            )
        )
    return state.select(*out, *temporal_features(at), *extra)


def temporal_features(at: Column) -> list[Column]:
    """Month, weekday (Monday is 0) and the November-December flag of a date."""
    return [
        F.month(at).alias("month"),
        day_of_week(at).alias("day_of_week"),
        F.month(at).isin(11, 12).cast("int").alias("is_holiday_season"),
    ]


def customer_partitions(tx: DataFrame, rows: int | None = None) -> int:
    """Into how many parts customers are dealt: one for each ROWS_A_PART transactions, so a part's size is fixed.

    A small table has no more parts than tasks that run at once.
    """
    rows = tx.count() if rows is None else rows
    at_once = tx.sparkSession.sparkContext.defaultParallelism
    return max(2, -(-rows // ROWS_A_PART), min(at_once, rows // SMALL_PART))


def snapshot_dataset(
    tx: DataFrame, dates: list[dt.datetime], cfg: SnapshotConfig = SnapshotConfig(), rows: int | None = None
) -> DataFrame:
    """Features and label of the active population at every date, in one plan.

    Two shuffles and no join: cells on (customer, position,
    category), then customer. The second one also serves the running window and
    the (customer, snapshot) grouping. A task there holds about ten times what it reads, which adaptive
    execution cannot know, so the number of parts follows the number of transactions (``rows``, counted unless given).
    """
    if not dates:
        raise ValueError("at least one snapshot date is needed")
    parts, n = [], customer_partitions(tx, rows)
    for group in by_time_of_day(dates):
        dealt = cells(tx.filter(horizon(group, cfg)), group[0], cfg).repartition(n, "customer_id")
        running = with_running_state(dealt)
        folded = _per_snapshot(with_snapshots(running, group, cfg)).filter("eligible")
        parts.append(
            _feature_columns(
                folded,
                F.col("snapshot_date"),
                cfg,
                [(~F.col("returned")).cast("int").alias("churn"), F.col("snapshot_date")],
            )
        )
    return _stack(parts)


def features_at(
    tx: DataFrame,
    reference_date: dt.datetime,
    cfg: SnapshotConfig = SnapshotConfig(),
    with_target: bool = False,
    min_history_days: int = 60,
) -> DataFrame:
    """Features of every customer known at one date, active or not.

    ``with_target`` adds the single-date label (no order within
    ``outcome_days`` of the last one) and drops customers with less than
    ``min_history_days`` of history.
    """
    ref = _ntz(reference_date)
    seen = tx.filter(F.col("order_date") <= ref)
    at = 2 * _point(reference_date)
    pos = F.col("pos")
    rows = with_running_state(cells(seen, reference_date, cfg)).withColumns(
        {
            "snapshot_date": ref,
            "past": F.lit(True),
            "in_activity": F.lit(True),
            "in_outcome": F.lit(False),
            "in_short": pos >= at - 2 * cfg.short_days,
            "in_long": pos >= at - 2 * cfg.long_days,
        }
    )
    out = _feature_columns(_per_snapshot(rows), F.col("snapshot_date"), cfg, [])
    if not with_target:
        return out
    labels = single_date_labels(tx, reference_date, cfg.outcome_days)
    return out.join(labels, "customer_id").filter(
        F.col("days_since_first_order") >= min_history_days
    )


def _point(at: dt.datetime) -> int:
    from tidemark.operators.snapshots import grid_point

    return grid_point(at)


def single_date_labels(
    tx: DataFrame, reference_date: dt.datetime, outcome_days: int = 30
) -> DataFrame:
    """1 when the first order after the reference comes more than ``outcome_days``
    after the last one before it. One grouping: no self-join is needed, because
    the outcome window of a customer starts at their own last order."""
    ref = _ntz(reference_date)
    when = F.col("order_date")
    return (
        tx.filter(F.col("customer_id").isNotNull() & when.isNotNull())
        .groupBy("customer_id")
        .agg(
            F.max(F.when(when <= ref, when)).alias("last_before"),
            F.min(F.when(when > ref, when)).alias("first_after"),
        )
        .filter(F.col("last_before").isNotNull())
        .select(
            "customer_id",
            F.coalesce(
                F.col("first_after") > F.col("last_before") + F.make_dt_interval(F.lit(outcome_days)),
                F.lit(True),
            )
            .cast("int")
            .alias("churn"),
        )
    )


# -------------------------------------------------- feature families, one date


def customer_base(tx: DataFrame, reference_date: dt.datetime | None = None) -> DataFrame:
    """First and last order of each customer, lifetime, and ages at a reference."""
    known = tx if reference_date is None else tx.filter(F.col("order_date") <= _ntz(reference_date))
    base = (
        known.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"))
    )
    out = base.withColumn(
        "customer_lifetime_days",
        elapsed_days(F.col("first_order_date"), F.col("last_order_date")).cast("int"),
    )
    if reference_date is None:
        return out
    ref = _ntz(reference_date)
    return out.withColumns(
        {
            "days_since_first_order": elapsed_days(F.col("first_order_date"), ref).cast("int"),
            "days_since_last_order": elapsed_days(F.col("last_order_date"), ref).cast("int"),
        }
    )


def order_gaps(tx: DataFrame, reference_date: dt.datetime | None = None) -> DataFrame:
    """Mean of the floored gaps between consecutive orders; null with one order."""
    known = tx if reference_date is None else tx.filter(F.col("order_date") <= _ntz(reference_date))
    daily = (
        known.filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
        .groupBy("customer_id", grid_position(F.col("order_date"), dt.datetime(2000, 1, 1)).alias("pos"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("order_date").alias("first_ts"),
            F.max("order_date").alias("last_ts"),
        )
    )
    previous = F.lag("last_ts").over(Window.partitionBy("customer_id").orderBy("pos"))
    return (
        daily.withColumn("gap", elapsed_days(previous, F.col("first_ts")).cast("bigint"))
        .groupBy("customer_id")
        .agg(F.sum("n").alias("orders"), F.coalesce(F.sum("gap"), F.lit(0)).alias("gap_days"))
        .select(
            "customer_id",
            "orders",
            F.try_divide(F.col("gap_days").cast("double"), (F.col("orders") - 1).cast("double")).alias(
                "avg_days_between_orders"
            ),
        )
    )


def running_state(tx: DataFrame, cfg: SnapshotConfig = SnapshotConfig()) -> DataFrame:
    """Cumulative count, sum, mean, max and first date at every order instant.

    Orders are first combined per instant. The running totals are then taken
    inside (customer, calendar day) pieces and shifted by the totals of the
    earlier days, so no window holds more than one day of a customer.
    """
    units = to_units(F.col("order_value"), cfg.amount_decimals)
    instants = (
        tx.filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
        .groupBy(
            "customer_id",
            F.to_date("order_date").alias("piece"),
            "order_date",
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("order_value").alias("n_value"),
            F.sum(units).alias("v"),
            F.max(units).alias("m"),
        )
    )
    before = (
        Window.partitionBy("customer_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        instants.groupBy("customer_id", "piece")
        .agg(
            F.sum("n").alias("n"),
            F.sum("n_value").alias("n_value"),
            F.sum("v").alias("v"),
            F.max("m").alias("m"),
            F.min("order_date").alias("first"),
        )
        .select(
            "customer_id",
            "piece",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
            F.coalesce(F.sum("n_value").over(before), F.lit(0)).alias("nv0"),
            F.sum("v").over(before).alias("v0"),
            F.max("m").over(before).alias("m0"),
            F.min("first").over(before).alias("first0"),
        )
    )
    inside = (
        Window.partitionBy("customer_id", "piece")
        .orderBy("order_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = instants.withColumns(
        {
            "rn": F.sum("n").over(inside),
            "rnv": F.sum("n_value").over(inside),
            "rv": F.sum("v").over(inside),
            "rm": F.max("m").over(inside),
            "rfirst": F.min("order_date").over(inside),
        }
    ).join(offsets, ["customer_id", "piece"])
    d = cfg.amount_decimals
    zero = F.lit(0)
    total = from_units(F.coalesce(F.col("rv"), zero) + F.coalesce(F.col("v0"), zero), d)
    n_value = F.col("rnv") + F.col("nv0")
    return running.select(
        "customer_id",
        "order_date",
        (F.col("rn") + F.col("n0")).alias("orders_so_far"),
        total.alias("revenue_so_far"),
        F.try_divide(total, n_value.cast("double")).alias("avg_value_so_far"),
        from_units(F.greatest("rm", "m0"), d).alias("max_value_so_far"),
        F.least("rfirst", "first0").alias("first_order_date"),
    )


# ------------------------------------------------------- incremental appends


def append_snapshot(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Add the rows of new snapshot dates to a feature table (same schema by name)."""
    return existing.unionByName(fresh.select(*existing.columns))
