"""Small-table plumbing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(*frames: DataFrame) -> DataFrame:
    """One-row frames with different columns as one row, without a join; several values of a column are an error."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    only = [
        F.when(F.count(c) > 1, F.raise_error(F.lit(f"more than one row has {c}"))).otherwise(F.first(c, ignorenulls=True))
        for c in stacked.columns
    ]
    return stacked.agg(*[value.alias(c) for value, c in zip(only, stacked.columns)])
