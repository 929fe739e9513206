"""File sources and sinks: typed reads, partitioned writes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, IntegralType, StringType, StructField, StructType, TimestampNTZType

from tidemark.functions.temporal import naive_utc
from tidemark.operators import consent
from tidemark.schemas import CONSENT, ERASURE_REQUESTS, REQUIRED_TRANSACTION_COLUMNS, TRANSACTIONS


#: Column of ``read_checked`` with the names of the fields of a row that could not be read.
PROBLEMS = "unreadable"
_WHOLE_LINE = "line"


class MissingColumnsError(ValueError):
    """A file lacks a column that the rules need."""


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header, read with a fixed schema; a malformed line fails the job."""
    return (
        spark.read.option("header", "true")
        .option("mode", "FAILFAST")
        .option("enforceSchema", "false")
        .schema(schema)
        .csv(path)
    )


def _readable(text: Column, kind: DataType) -> Column:
    """A text as a value of a type, or null: dates with any zone, whole numbers written as 1.0, flags written as words."""
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, TimestampNTZType):
        return naive_utc(text, "string")
    if isinstance(kind, IntegralType):
        as_number = text.try_cast("double")
        whole = F.when(as_number == F.floor(as_number), as_number).try_cast(kind)
        return F.coalesce(text.try_cast(kind), whole, text.try_cast("boolean").try_cast(kind))
    if isinstance(kind, BooleanType):
        return F.coalesce(text.try_cast("boolean"), (text.try_cast("double") != 0))
    return text.try_cast(kind)


def read_checked(spark: SparkSession, path: str, schema: StructType, required: Sequence[str] = ()) -> DataFrame:
    """CSV whose header decides which columns of ``schema`` there are, in any order.

    Known columns are typed, others stay text, those of the schema that the file lacks are left out; a ``required``
    one that is missing is an error. ``unreadable`` names the fields of a row that had a text but no
    readable value, and ``line`` if the row has too many or too few fields; it is empty for a
    good row. All files of a folder must have the same header.
    """
    names = spark.read.option("header", "true").csv(path).columns
    missing = [c for c in required if c not in names]
    if missing:
        raise MissingColumnsError(f"columns missing in {path}: {missing}")
    texts = StructType([StructField(n, StringType()) for n in [*names, "_corrupt_record"]])
    raw = spark.read.option("header", "true").option("enforceSchema", "false").schema(texts).csv(path)
    known = {f.name: f.dataType for f in schema.fields if f.name in names}
    text = {n: F.col(f"`{n}`") for n in names}
    typed = [(_readable(text[n], known[n]) if n in known else text[n]).alias(n) for n in names]
    problems = [F.when((F.trim(text[n]) != "") & _readable(text[n], t).isNull(), F.lit(n)) for n, t in known.items()]
    problems.append(F.when(F.col("_corrupt_record").isNotNull(), F.lit(_WHOLE_LINE)))
    return raw.select(*typed, F.array_compact(F.array(*problems)).alias(PROBLEMS))


def bad_records(checked: DataFrame) -> DataFrame:
    """Rows of ``read_checked`` with a field that could not be read."""
    return checked.where(F.size(PROBLEMS) > 0)


def _settled(checked: DataFrame, strict: bool) -> DataFrame:
    """Without the problem column; ``strict`` fails the job at the first bad record."""
    if not strict:
        return checked.drop(PROBLEMS)
    message = F.concat(F.lit("malformed record: "), F.concat_ws(",", PROBLEMS))
    return checked.where(F.when(F.size(PROBLEMS) > 0, F.raise_error(message).cast("boolean")).otherwise(True)).drop(PROBLEMS)


def read_transactions(
    spark: SparkSession, path: str, schema: StructType = TRANSACTIONS, fmt: str | None = None, strict: bool = False
) -> DataFrame:
    """Transactions from CSV or Parquet, by extension unless ``fmt`` says.

    Engagement flags and ``is_refund`` are optional. What can't be read is null, which the transaction contract
    counts, unless ``strict``; ``read_checked`` has the rows themselves.
    """
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if fmt != "csv":
        return normalise_transactions(spark.read.parquet(path))
    wide = StructType([*schema.fields, *([] if "is_refund" in schema.names else [StructField("is_refund", BooleanType())])])
    return _settled(read_checked(spark, path, wide, REQUIRED_TRANSACTION_COLUMNS), strict)


def normalise_transactions(df: DataFrame) -> DataFrame:
    """Order dates of any source type as UTC wall clock, which every operator expects."""
    dtype = dict(df.dtypes).get("order_date")
    if dtype in (None, "timestamp_ntz"):
        return df
    return df.withColumn("order_date", naive_utc(F.col("order_date"), dtype))


def read_consent(
    spark: SparkSession, path: str, fmt: str = "csv", schema: StructType = CONSENT, strict: bool = False
) -> DataFrame:
    """The consent registry; dates may carry a zone, and one that can't be read is null unless ``strict``."""
    if fmt != "csv":
        return consent.normalise(spark.read.parquet(path))
    return consent.normalise(_settled(read_checked(spark, path, schema), strict))


def read_erasure_requests(spark: SparkSession, path: str, schema: StructType = ERASURE_REQUESTS) -> DataFrame:
    """Requests; a file of ids alone has no version column, so all of them are pending."""
    return _settled(read_checked(spark, path, schema, schema.names[:1]), strict=False)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """``single_file`` is for tables of a few rows, such as a calibration table."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)


def stage_daily(df: DataFrame, path: str, day: dt.date) -> None:
    """Frozen copy of a run's input; running the same day again replaces only that day."""
    (
        df.withColumn("ds", F.lit(day.isoformat()).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ds")
        .parquet(path)
    )


def write_features(df: DataFrame, path: str, dynamic: bool = True) -> None:
    """Feature table laid out by snapshot, so that a date filter reads only its files.

    ``rebalance`` brings the rows of a date together and lets adaptive execution
    split a large date over several tasks and merge small ones: no task writes
    to every folder and no date is written by one task.
    """
    writer = df.hint("rebalance", "snapshot_date").write.mode("overwrite")
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("snapshot_date").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The feature table; the partition column comes back as a wall-clock timestamp."""
    df = spark.read.parquet(path)
    return df.withColumn("snapshot_date", F.col("snapshot_date").cast("timestamp_ntz"))


def write_scores(df: DataFrame, path: str) -> None:
    """Scores by scoring day."""
    (
        df.withColumn("scored_on", F.to_date("scored_at"))
        .hint("rebalance", "scored_on")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("scored_on")
        .parquet(path)
    )


def write_json_report(df: DataFrame, path: str) -> None:
    """A nested one-row report as a JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_json_report(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
