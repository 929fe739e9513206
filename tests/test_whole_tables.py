"""Insights describe the feature rows of all snapshots, not those of one date."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from queries import all_queries, common
from tidemark.operators import insights
from tidemark.schemas import MODEL_FEATURES


@pytest.fixture(scope="module")
def rows(spark, sf):
    return common.features(spark, sf).cache()


@pytest.mark.parametrize(
    "name, wanted",
    [
        ("churn_by_recency", "true"),
        ("churn_by_frequency", "purchase_frequency_30d > 0"),
        ("recency_histogram", "true"),
        ("risk_segment_counts", "true"),
    ],
)
def test_every_row_is_counted(spark, sf, rows, name, wanted):
    assert rows.select("snapshot_date").distinct().count() > 1
    counted = all_queries()[name](spark, sf).agg(F.sum("customers")).first()[0]
    assert counted == rows.where(wanted).count()


def test_strengths_are_those_of_all_rows(spark, sf, rows):
    whole = insights.feature_correlation(rows, MODEL_FEATURES)
    assert sorted(all_queries()["feature_correlation"](spark, sf).collect()) == sorted(whole.collect())
    assert all_queries()["top_features"](spark, sf).collect() == insights.top_features(whole).collect()
    families = insights.category_importance(whole)
    assert sorted(all_queries()["category_importance"](spark, sf).collect()) == sorted(families.collect())
