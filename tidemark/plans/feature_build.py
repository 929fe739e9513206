"""From raw transactions to the feature table.

The order of the steps is a legal one and is not left to the optimiser:
contract, retention, legal basis, minimisation, then features.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.frames import side_by_side
from tidemark.functions.numeric import half_even
from tidemark.operators import consent, contracts, privacy, retention
from tidemark.operators.features import snapshot_dataset
from tidemark.operators.snapshots import SnapshotConfig, date_bounds, snapshot_dates
from tidemark.schemas import RETENTION_DAYS
from tidemark.sources.files import read_features, write_features


@dataclass
class FeatureBuild:
    features: DataFrame
    traces: dict[str, DataFrame]
    minimisation: dict
    dates: list[dt.datetime]


class MissingConsentError(ValueError):
    """No registry was given; processing without a legal basis is refused."""


def ingest_summary(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.count(F.lit(1)).alias("transactions"), F.count_distinct("customer_id").alias("customers")
    )


def build_features(
    tx: DataFrame,
    registry: DataFrame | None,
    cfg: SnapshotConfig = SnapshotConfig(),
    as_of: dt.datetime | None = None,
    pseudonym_key: bytes | None = None,
    output_path: str | None = None,
    today: dt.datetime | None = None,
    retention_days: int = RETENTION_DAYS["transactions"],
) -> FeatureBuild:
    """Run the chain; blocking contract failures raise before anything is written.

    With ``output_path`` the table is written first and the output contract runs
    over what was written, so the features are computed once.
    """
    if registry is None:
        raise MissingConsentError("a consent registry is required")
    as_of = as_of or date_bounds(tx)[1]
    checked = contracts.contract_transactions(tx, today or dt.datetime.now())
    contracts.raise_if_failed(checked, "transactions")

    kept = retention.retention_purge(tx, "order_date", retention_days, as_of)
    lawful = consent.eligible_for_scoring(kept, registry, as_of)
    minimal, record = privacy.minimize(lawful, pseudonym_key)
    dates = snapshot_dates(minimal, cfg)
    features = snapshot_dataset(minimal, dates, cfg)
    if output_path:
        write_features(features, output_path)
        features = read_features(tx.sparkSession, output_path)
    output = contracts.contract_features(features)
    contracts.raise_if_failed(output, "features")
    traces = {
        "ingest": ingest_summary(tx),
        "input_contract": checked,
        "retention": retention.retention_trace(tx, "order_date", retention_days, as_of, "transactions"),
        "legal_basis": consent.legal_basis_trace(kept, registry, ["churn_scoring"], as_of),
        "output_contract": output,
        "snapshots": snapshot_report(features),
    }
    return FeatureBuild(features, traces, record, dates)


def snapshot_report(features: DataFrame) -> DataFrame:
    """Population and label rate per snapshot, and a total row with a null date.

    ``rollup`` would shuffle every row twice over; counting per snapshot first
    leaves a handful of rows to total.
    """
    per = features.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("population"), F.sum(F.col("churn").cast("bigint")).alias("leavers")
    )
    return (
        per.rollup("snapshot_date")
        .agg(F.sum("population").alias("population"), F.sum("leavers").alias("leavers"))
        .withColumn("churn_rate", half_even(F.col("leavers") / F.col("population"), 4))
    )


def snapshot_totals(features: DataFrame) -> DataFrame:
    """Rows, distinct customers, overall rate and the range of the snapshot rates."""
    per = snapshot_report(features)
    total = F.col("snapshot_date").isNull()
    rates = per.agg(
        F.count_if(~total).alias("snapshots"),
        F.max(F.when(total, F.col("population"))).alias("rows"),
        F.max(F.when(total, F.col("churn_rate"))).alias("churn_rate"),
        F.min(F.when(~total, F.col("churn_rate"))).alias("min_rate"),
        F.max(F.when(~total, F.col("churn_rate"))).alias("max_rate"),
    )
    people = features.agg(F.count_distinct("customer_id").alias("customers"))
    return side_by_side(rates, people)


def latest_snapshot(features: DataFrame) -> DataFrame:
    """Rows of the last date, without the date column.

    The date is a driver-side scalar: over the partitioned table only one folder
    is then read.
    """
    last = features.agg(F.max("snapshot_date")).first()[0]
    if last is None:
        return features.limit(0).drop("snapshot_date")
    at = F.lit(last.isoformat(sep=" ")).cast("timestamp_ntz")
    return features.filter(F.col("snapshot_date") == at).drop("snapshot_date")


def reference_and_current(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The slices of the first and of the last date."""
    lo, hi = features.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()

    def at(when):
        return features.filter(F.col("snapshot_date") == F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz"))

    return at(lo), at(hi)
