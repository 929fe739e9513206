"""Labelled intervals as CASE expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def interval_label(
    value: Column, upper_edges: Sequence[float], labels: Sequence, lower: float | None = None
) -> Column:
    """Label of the ``(previous edge, edge]`` interval that holds ``value``.

    ``labels`` has one entry more than ``upper_edges``; the last one is
    open-ended. Values at or under ``lower`` and nulls get null.
    """
    if len(labels) != len(upper_edges) + 1:
        raise ValueError("one more label than edges is needed")
    guard = value.isNotNull() if lower is None else value > F.lit(lower)
    inside = F.when(value <= F.lit(upper_edges[0]), F.lit(labels[0]))
    for edge, label in zip(upper_edges[1:], labels[1:-1]):
        inside = inside.when(value <= F.lit(edge), F.lit(label))
    return F.when(guard, inside.otherwise(F.lit(labels[-1])))
