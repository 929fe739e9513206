"""Data contracts: all row checks of a table in one aggregate pass.

A check is a boolean *aggregate* column. Checks that need a grouping first
(duplicates, unique key, spread of rates) run over that grouping, which is
combined map-side; all checks on the same grouping share it. A check whose
columns are missing is a failed row, never an exception.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from tidemark.schemas import REQUIRED_TRANSACTION_COLUMNS


class ContractError(RuntimeError):
    """At least one blocking expectation failed."""


@dataclass(frozen=True)
class Expectation:
    """A named check.

    ``check`` is a boolean aggregate (or SQL text of one) over the rows of
    ``over(df)``, by default the table itself; a plain bool is a check settled
    on the schema alone.
    """

    name: str
    check: Column | str | bool
    needs: tuple[str, ...] = ()
    blocking: bool = True
    over: str = "rows"
    description: str = ""


Grouping = Callable[[DataFrame], DataFrame]


def run_expectations(
    df: DataFrame,
    expectations: Sequence[Expectation],
    groupings: dict[str, Grouping] | None = None,
) -> DataFrame:
    """One row per expectation: (name, blocking, passed, error)."""
    groupings = {"rows": lambda d: d, **(groupings or {})}
    columns = set(df.columns)
    by_grouping: dict[str, list[tuple[Expectation, Column, Column]]] = {}
    for e in expectations:
        missing = [c for c in e.needs if c not in columns]
        error = F.lit(None).cast("string")
        if missing:
            passed, error, over = F.lit(False), F.lit(f"missing columns: {missing}"), "rows"
        elif isinstance(e.check, bool):
            passed, over = F.lit(e.check), "rows"
        else:
            passed = F.expr(e.check) if isinstance(e.check, str) else e.check
            passed, over = F.coalesce(passed, F.lit(False)), e.over
        by_grouping.setdefault(over, []).append((e, passed, error))
    out = None
    for over, items in by_grouping.items():
        one = groupings[over](df).agg(
            F.array(
                *[
                    F.struct(
                        F.lit(e.name).alias("name"),
                        F.lit(e.blocking).alias("blocking"),
                        passed.alias("passed"),
                        error.alias("error"),
                    )
                    for e, passed, error in items
                ]
            ).alias("r")
        )
        rows = one.select(F.inline("r"))
        out = rows if out is None else out.unionByName(rows)
    return out


def report_status(results: DataFrame) -> DataFrame:
    failed = ~F.col("passed")
    return results.agg(
        F.count(F.lit(1)).alias("expectations"),
        F.count_if("passed").alias("passed"),
        F.count_if(failed & F.col("blocking")).alias("blocking_failures"),
        F.count_if(failed & ~F.col("blocking")).alias("warnings"),
        F.when(F.count_if(failed & F.col("blocking")) == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def raise_if_failed(results: DataFrame, dataset: str) -> None:
    failed = results.filter("blocking AND NOT passed").orderBy("name").collect()
    if failed:
        names = "; ".join(f"{r.name} ({r.error})" if r.error else r.name for r in failed)
        raise ContractError(f"{dataset}: {len(failed)} blocking failure(s): {names}")


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED_TRANSACTION_COLUMNS) -> list[str]:
    return sorted(set(required) - set(df.columns))


def check_required_columns(
    df: DataFrame, required: Sequence[str] = REQUIRED_TRANSACTION_COLUMNS
) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ContractError(f"missing columns {missing}, expected {list(required)}")
    return df


# --------------------------------------------------------------- transactions


def _whole_rows(df: DataFrame) -> DataFrame:
    """Copies of each distinct row: told apart by 128 bits of hash and by which fields are null; maps and arrays compare by their JSON."""
    flat = [F.to_json(c) if t.startswith(("map", "array")) else F.col(c) for c, t in df.dtypes]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in flat])  # a null adds nothing to a hash
    key = df.select(F.xxhash64(nulls, *flat).alias("_a"), F.xxhash64(*reversed(flat), nulls).alias("_b"))
    return key.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n"))


def transaction_expectations(df: DataFrame, today: dt.datetime) -> list[Expectation]:
    """Contract of raw transactions; only the share of repeated rows needs them brought together, as digests."""
    n = F.col("_n")
    types = dict(df.dtypes)
    limit = F.lit((today + dt.timedelta(days=1)).isoformat(sep=" ")).cast("timestamp_ntz")

    def date() -> Column:
        when = F.col("order_date")
        return when.try_cast("timestamp_ntz") if types.get("order_date") == "string" else when

    return [
        Expectation("required_columns", not missing_columns(df)),
        Expectation("not_empty", F.count(F.lit(1)) > 0),
        Expectation("customer_id_present", F.count_if(F.col("customer_id").isNull()) == 0, ("customer_id",)),
        Expectation("dates_parse", F.count_if(date().isNull()) == 0, ("order_date",)),
        Expectation(
            "amounts_not_negative",
            F.count_if(~F.coalesce(F.col("order_value") >= 0, F.lit(False))) == 0,
            ("order_value",),
        ),
        Expectation("no_future_order", F.max(date()) <= limit, ("order_date",), False),
        Expectation("few_duplicates", F.try_divide(F.sum(n - 1), F.sum(n)) < 0.01, (), False, "whole_rows"),
    ]


TRANSACTION_GROUPINGS: dict[str, Grouping] = {"whole_rows": _whole_rows}


def contract_transactions(df: DataFrame, today: dt.datetime) -> DataFrame:
    return run_expectations(df, transaction_expectations(df, today), TRANSACTION_GROUPINGS)


def quality_warnings(df: DataFrame, now: dt.datetime) -> DataFrame:
    """Repeated (customer, date) rows, negative amounts and future dates."""
    at = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    per_key = df.groupBy("customer_id", "order_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("order_value") < 0).alias("negative")
    )
    return per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum("negative"), F.lit(0)).alias("negative_values"),
        F.coalesce(F.sum(F.when(F.col("order_date") > at, F.col("n"))), F.lit(0)).alias("future_dates"),
    )


# ------------------------------------------------------------------- features


def _feature_keys(df: DataFrame) -> list[str]:
    return [c for c in ("customer_id", "snapshot_date") if c in df.columns]


def feature_expectations(df: DataFrame, stable_schema: Sequence[str] | None = None) -> list[Expectation]:
    churn = F.col("churn")
    dated = "snapshot_date" in df.columns
    null_shares = [F.try_divide(F.count_if(F.col(c).isNull()), F.count(F.lit(1))) for c in df.columns]
    most_nulls = F.greatest(*null_shares) if len(null_shares) > 1 else null_shares[0]
    recency, age = F.col("days_since_last_order"), F.col("days_since_first_order")

    def every(rule: Column) -> Column:
        return F.count_if(~F.coalesce(rule, F.lit(False))) == 0

    checks = [
        Expectation("not_empty", F.count(F.lit(1)) > 0),
        Expectation("unique_key", F.coalesce(F.max("_n"), F.lit(0)) <= 1, ("customer_id",), True, "keys"),
        Expectation(
            "several_snapshots", F.count("snapshot_date") >= 3 if dated else True, (), True, "snapshots"
        ),
        Expectation(
            "stable_rate_between_snapshots",
            (F.max("_rate") - F.min("_rate")) < 0.25 if dated else True,
            ("churn",) if dated else (),
            True,
            "snapshots",
        ),
        Expectation("label_present", "churn" in df.columns),
        Expectation("label_binary", F.count_if(~churn.isin(0, 1)) == 0, ("churn",), True, "labels"),
        Expectation("two_classes", F.count(churn) == 2, ("churn",), True, "labels"),
        Expectation("recency_not_negative", every(recency >= 0), ("days_since_last_order",)),
        Expectation(
            "first_order_before_last",
            every(age >= recency),
            ("days_since_first_order", "days_since_last_order"),
        ),
        Expectation("revenue_not_negative", every(F.col("total_revenue") >= 0), ("total_revenue",)),
        Expectation("reasonable_balance", F.avg(churn).between(0.02, 0.98), ("churn",), False),
        Expectation("few_missing_values", most_nulls < 0.5, (), False),
    ]
    if stable_schema:
        checks.append(Expectation("stable_schema", set(stable_schema) <= set(df.columns)))
    return checks


def _by_key(df: DataFrame) -> DataFrame:
    return df.groupBy(*_feature_keys(df)).agg(F.count(F.lit(1)).alias("_n"))


def _by_snapshot(df: DataFrame) -> DataFrame:
    rate = F.avg("churn") if "churn" in df.columns else F.lit(None).cast("double")
    return df.groupBy("snapshot_date").agg(rate.alias("_rate"))


def _by_label(df: DataFrame) -> DataFrame:
    return df.groupBy("churn").agg(F.count(F.lit(1)).alias("_n"))


FEATURE_GROUPINGS: dict[str, Grouping] = {
    "keys": _by_key,
    "snapshots": _by_snapshot,
    "labels": _by_label,
}


def contract_features(df: DataFrame, stable_schema: Sequence[str] | None = None) -> DataFrame:
    return run_expectations(df, feature_expectations(df, stable_schema), FEATURE_GROUPINGS)


def scoring_expectations(df: DataFrame, names: Sequence[str]) -> list[Expectation]:
    served = [c for c in df.columns if c in set(names)]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numbers = [c for c in names if isinstance(kinds.get(c), NumericType)]
    floats = [c for c in numbers if isinstance(kinds[c], (DoubleType, FloatType))]
    infinite = F.lit(False)
    for c in floats:
        infinite = infinite | F.coalesce(F.abs(c) == F.lit(float("inf")), F.lit(False))
    recency = "days_since_last_order"
    return [
        Expectation("schema_as_trained", served == list(names)),
        Expectation("no_infinite_value", F.count_if(infinite) == 0, tuple(names)),
        Expectation(
            "recency_not_negative",
            F.count_if(~F.coalesce(F.col(recency) >= 0, F.lit(False))) == 0 if recency in df.columns else True,
        ),
    ]


def contract_scoring(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return run_expectations(df, scoring_expectations(df, names))


def temporal_leak_guard(df: DataFrame) -> DataFrame:
    """Counts of negative ages; anything but zero means a feature saw the future."""
    ages = [c for c in ("days_since_last_order", "days_since_first_order") if c in df.columns]
    return df.agg(*[F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in ages])


def with_leak_guard(df: DataFrame) -> DataFrame:
    """The same rows; executing them fails on the first negative age."""
    out = df
    for c in ("days_since_last_order", "days_since_first_order"):
        if c in df.columns:
            message = F.concat(F.lit(f"temporal leak: {c} = "), F.col(c).cast("string"))
            out = out.withColumn(c, F.when(F.col(c) < 0, F.raise_error(message).cast(dict(df.dtypes)[c])).otherwise(F.col(c)))
    return out
