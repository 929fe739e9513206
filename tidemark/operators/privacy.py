"""Minimisation, pseudonymisation, k-anonymity and table fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from tidemark.functions.hashing import pseudonym
from tidemark.schemas import DIRECT_IDENTIFIERS, JOURNAL_FORBIDDEN_KEYS, SPECIAL_CATEGORIES


class SpecialCategoryError(ValueError):
    """A column of a category that must not be processed at all."""


class PersonalDataInJournalError(ValueError):
    """A journal payload names a person."""


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    by_lower = {c.lower(): c for c in df.columns}
    return [by_lower[n] for n in names if n in by_lower]


def forbid_special_categories(df: DataFrame) -> DataFrame:
    found = _present(df, SPECIAL_CATEGORIES)
    if found:
        raise SpecialCategoryError(f"columns must be removed upstream: {found}")
    return df


def drop_direct_identifiers(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Without the identifying columns, and their names as they were written."""
    found = _present(df, DIRECT_IDENTIFIERS)
    return df.drop(*found), found


def pseudonymize(df: DataFrame, key: bytes, column: str = "customer_id") -> DataFrame:
    return df.withColumn(column, pseudonym(F.col(column), key))


def minimize(
    df: DataFrame, key: bytes | None = None, column: str = "customer_id"
) -> tuple[DataFrame, dict]:
    """Refuse special categories, drop identifiers, pseudonymise; all at plan time.

    The returned record has no row count: counting is the caller's job, together
    with whatever else is counted.
    """
    out, dropped = drop_direct_identifiers(forbid_special_categories(df))
    done = key is not None and column in out.columns
    if done:
        out = pseudonymize(out, key, column)
    return out, {"dropped_identifiers": dropped, "forbidden_found": [], "pseudonymized": done}


def k_anonymity(df: DataFrame, quasi_identifiers: Sequence[str], k: int = 5) -> DataFrame:
    """Smallest group, groups under ``k`` and the persons in them; nulls form groups."""
    present = [c for c in quasi_identifiers if c in df.columns]
    if not present:
        return df.sparkSession.range(1).select(F.lit(False).alias("applicable"))
    sizes = df.groupBy(*present).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return sizes.agg(
        F.lit(True).alias("applicable"),
        F.lit(k).alias("k_required"),
        F.min(n).alias("k_observed"),
        F.count_if(n < k).alias("groups_under_k"),
        (F.count_if(n < k) == 0).alias("compliant"),
        F.coalesce(F.sum(F.when(n < k, n)), F.lit(0)).alias("persons_exposed"),
    )


def data_fingerprint(df: DataFrame) -> DataFrame:
    """Digest of a table's rows and schema that does not depend on row order.

    Each row gives 60 bits of a SHA-256 over its fields; their sum and their XOR
    are combined with the row count and the schema. Both are associative, so
    partial aggregation and any partitioning give the same digest.
    """
    fields = [
        F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit("\u0000")))
        for name in df.columns
    ]
    row = F.conv(F.substring(F.sha2(F.concat_ws("\u001f", *fields), 256), 1, 15), 16, 10).cast("bigint")
    schema = "|".join(f"{n}:{t}" for n, t in df.dtypes)
    total = df.select(row.alias("h")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("s"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("x"),
    )
    text = F.concat_ws(
        "|", F.col("row_count").cast("string"), F.col("s").cast("string"), F.col("x").cast("string"), F.lit(schema)
    )
    return total.select("row_count", F.sha2(text, 256).alias("fingerprint"))


# ----------------------------------------------- no personal data in journals


def forbidden_schema_keys(schema: DataType, path: str = "") -> list[str]:
    """Dotted names of forbidden fields at any depth of a payload's type."""
    if isinstance(schema, (ArrayType,)):
        return forbidden_schema_keys(schema.elementType, path)
    if isinstance(schema, MapType):
        return forbidden_schema_keys(schema.valueType, path)
    if not isinstance(schema, StructType):
        return []
    out = []
    for field in schema.fields:
        full = f"{path}.{field.name}" if path else field.name
        if field.name.lower() in JOURNAL_FORBIDDEN_KEYS:
            out.append(full)
        out += forbidden_schema_keys(field.dataType, full)
    return out


def assert_no_personal_data(df: DataFrame, column: str = "details") -> DataFrame:
    found = forbidden_schema_keys(df.schema[column].dataType)
    if found:
        raise PersonalDataInJournalError(f"forbidden keys in {column}: {found}")
    return df


def json_forbidden_keys(text: Column) -> Column:
    """Forbidden keys of a JSON text, at any depth, as a sorted array; null if it is no JSON or repeats a key.

    The text is read as a VARIANT and written again, which undoes escapes; in that form quotes only ever
    open and close strings, so its strings can be read off one after the other, and those before a colon are the
    keys.
    """
    plain = F.to_json(F.try_parse_json(text))
    strings = F.regexp_extract_all(plain, F.lit(r'("(?:[^"\\]|\\.)*+":?)'), F.lit(1))
    keys = F.transform(F.filter(strings, lambda x: x.endswith(":")), lambda x: F.lower(x.substr(F.lit(2), F.length(x) - 3)))
    return F.array_sort(F.array_intersect(F.array_distinct(keys), F.lit(list(JOURNAL_FORBIDDEN_KEYS))))


def checked_text(text: Column) -> Column:
    """A text as it is; one that is a JSON object or array with a forbidden key, or that looks like one and can't be read, fails the job."""
    keys = json_forbidden_keys(text)
    message = F.concat(F.lit("personal data in journal: "), F.when(keys.isNull(), "unreadable").otherwise(F.concat_ws(",", keys)))
    # Nested, so that only what looks like JSON is parsed.
    judged = F.when(keys.isNull() | (F.size(keys) > 0), F.raise_error(message)).otherwise(text)
    return F.when(text.rlike(r"^\s*[\[{]"), judged).otherwise(text)
