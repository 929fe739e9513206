"""Snapshot dates and temporal splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import common as c
from tidemark.operators import snapshots, splits


def snapshot_dates(spark, sf):
    return snapshots.snapshot_frame(spark, c.dates(spark, sf))


def split_by_snapshot(spark, sf):
    return splits.split_by_snapshot(c.features(spark, sf), dates=c.dates(spark, sf)).select(
        "customer_id", "snapshot_date", "split"
    )


def split_summary(spark, sf):
    return splits.split_summary(splits.split_by_snapshot(c.features(spark, sf), dates=c.dates(spark, sf)))


def time_series_split(spark, sf):
    return splits.time_series_split(c.tx(spark, sf)).select("order_id", "order_date", "split")


def single_reference_date(spark, sf):
    """Orders on either side of the reference date."""
    at = c.ntz(splits.single_reference_date(c.tx(spark, sf)))
    return (
        c.tx(spark, sf)
        .groupBy((F.col("order_date") <= at).alias("observed"))
        .agg(F.count(F.lit(1)).alias("orders"), F.max(at).alias("reference_date"))
    )


def ordered_80_20_split(spark, sf):
    return splits.ordered_split(c.features(spark, sf, "latest")).select("customer_id", "split")


QUERIES = {
    f.__name__: f
    for f in (
        snapshot_dates,
        split_by_snapshot,
        split_summary,
        time_series_split,
        single_reference_date,
        ordered_80_20_split,
    )
}

_SPLIT = """parts AS (SELECT t, CASE WHEN r <= 2 THEN 'test' WHEN r <= 3 THEN 'val' ELSE 'train' END AS split
  FROM (SELECT t, row_number() OVER (ORDER BY t DESC) AS r FROM snap))"""

ORACLES = {
    "snapshot_dates": c.sql(*c.BASE, select="SELECT t AS snapshot_date FROM snap"),
    "split_by_snapshot": c.sql(
        *c.BASE,
        c.FEATS,
        _SPLIT,
        select="SELECT customer_id, snapshot_date, split FROM feats JOIN parts ON t = snapshot_date",
    ),
    "split_summary": c.sql(
        *c.BASE,
        c.FEATS,
        _SPLIT,
        select=f"""SELECT split, count(DISTINCT snapshot_date) AS snapshots, count(*) AS rows,
       {c.half_even('sum(churn) / count(*)', 4)} AS churn_rate, min(snapshot_date) AS first_date, max(snapshot_date) AS last_date
FROM feats JOIN parts ON t = snapshot_date GROUP BY split""",
    ),
    "time_series_split": c.sql(
        c.TX,
        "e AS (SELECT max(order_date) AS hi, max(order_date) - INTERVAL 3 MONTH AS mid FROM tx)",
        "w AS (SELECT hi, mid, mid - INTERVAL 1 DAY AS stop, (mid - INTERVAL 1 DAY) - INTERVAL 12 MONTH AS start FROM e)",
        select="""SELECT order_id, order_date, CASE WHEN order_date >= mid THEN 'test' ELSE 'train' END AS split
FROM tx, w WHERE (order_date >= mid AND order_date <= hi) OR (order_date >= start AND order_date <= stop)""",
    ),
    "single_reference_date": c.sql(
        c.TX,
        "ref AS (SELECT lo + to_microseconds(CAST(floor((epoch_us(hi) - epoch_us(lo)) * 0.65::DOUBLE) AS BIGINT)) AS r FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM tx))",
        select="SELECT order_date <= r AS observed, count(*) AS orders, max(r) AS reference_date FROM tx, ref GROUP BY 1",
    ),
    "ordered_80_20_split": c.sql(
        *c.BASE,
        c.FEATS_LAST,
        select="""SELECT customer_id, CASE WHEN row_number() OVER (ORDER BY customer_id) <= floor(count(*) OVER () * 0.8::DOUBLE)
       THEN 'train' ELSE 'test' END AS split FROM feats""",
    ),
}
