"""Retention purges and erasure of persons."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.temporal import naive_utc


def _kept(df: DataFrame, column: str, days: int, as_of: dt.datetime) -> Column:
    if column not in df.columns:
        raise KeyError(f"no date column {column}")
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
    cutoff = F.lit((as_of - dt.timedelta(days=days)).isoformat(sep=" ")).cast("timestamp_ntz")
    when = naive_utc(F.col(column), dict(df.dtypes)[column])
    return when.isNull() | (when >= cutoff)


def retention_purge(df: DataFrame, column: str, days: int, as_of: dt.datetime) -> DataFrame:
    """Rows dated on or after ``as_of - days``; rows without a date are kept."""
    return df.filter(_kept(df, column, days, as_of))


def retention_trace(
    df: DataFrame, column: str, days: int, as_of: dt.datetime, label: str
) -> DataFrame:
    kept = _kept(df, column, days, as_of)
    return df.agg(
        F.lit(label).alias("dataset"),
        F.lit(days).alias("retention_days"),
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(kept).alias("rows_after"),
        F.count_if(~kept).alias("rows_purged"),
    )


def erase_customers(
    frames: Mapping[str, DataFrame], requests: DataFrame, column: str = "customer_id"
) -> dict[str, DataFrame]:
    """Every frame without the requesting persons; frames without the column pass."""
    ids = requests.select(F.col(column))
    return {
        name: df.join(ids, column, "left_anti") if column in df.columns else df
        for name, df in frames.items()
    }


def erasure_trace(
    frames: Mapping[str, DataFrame], requests: DataFrame, column: str = "customer_id"
) -> DataFrame:
    """Rows removed per frame. Each frame is counted per person before the join."""
    ids = requests.select(F.col(column))
    out = None
    for name, df in frames.items():
        if column in df.columns:
            gone = (
                df.groupBy(column)
                .agg(F.count(F.lit(1)).alias("n"))
                .join(ids, column, "left_semi")
                .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_removed"))
            )
        else:
            gone = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("rows_removed"))
        one = gone.select(F.lit(name).alias("dataset"), "rows_removed")
        out = one if out is None else out.unionByName(one)
    return out


def pending_erasures(
    requests: DataFrame | None, column: str = "processed_in_model_version", spark: SparkSession | None = None
) -> DataFrame:
    """One row, ``pending``: requests no model version has taken into account yet.

    Without the column all of them are pending; without a table there are none. An empty text counts as
    no version, as in a file with an empty field.
    """
    if requests is None:
        spark = spark or SparkSession.getActiveSession()
        return spark.range(1).select(F.lit(0).cast("bigint").alias("pending"))
    pending = F.coalesce(F.trim(F.col(column).cast("string")), F.lit("")) == "" if column in requests.columns else F.lit(True)
    return requests.agg(F.count_if(pending).alias("pending"))
