"""Document fingerprints by locally consistent parsing.

A text is a sequence of symbols, at first its characters. At each level a run of equal
symbols becomes one; deterministic coin tossing (the lowest bit in which a symbol differs
from the one before, three times over) gives neighbours different labels below eight; a
phrase begins at every label larger than both beside it. A phrase's name is a hash of its
symbols, and names are the symbols of the next level. Where a phrase begins depends on a few
symbols on either side, so equal substrings are parsed alike inside, at any offset.

The fingerprint is a sketch of the names of the second level up (of the first, in texts of
fewer than 32 phrases) and of the name of the whole text: 128 bins, in each the least of its
names, kept as one byte (zero: none). The share of equal bins, less what equal bytes by
chance would give, estimates the share J of common names; likeness is 2 J / (1 + J), the
common part of the average of both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.repeats import mix

BINS = 128
_VALUES = 255
#: Characters parsed at a time, whole texts.
BATCH_CHARS = 400_000
FEW_PHRASES = 32
_LOWEST = np.array([0] + [(x & -x).bit_length() - 1 for x in range(1, 256)], np.uint8)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _toss(label: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One more round on labels of one byte; the first of a text tosses against its own complement."""
    before = np.concatenate((label[:1], label[:-1]))
    before = np.where(first, label ^ np.uint8(1), before)
    k = _LOWEST[label ^ before]
    return 2 * k + (label >> k & 1)


def phrases(symbol: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and texts of the phrases of one level; texts lie one after the other."""
    first = np.concatenate(([True], text[1:] != text[:-1]))
    head = first | np.concatenate(([True], symbol[1:] != symbol[:-1]))
    at = np.flatnonzero(head)
    length = np.diff(np.append(at, len(symbol)))
    symbol, text, first = symbol[at], text[at], first[at]
    long_ = np.flatnonzero(length > 1)
    symbol[long_] = mix(symbol[long_] ^ mix(length[long_].astype(np.uint64)))
    before = np.concatenate((symbol[:1], symbol[:-1]))
    differ = symbol ^ np.where(first, ~symbol, before)
    # Different runs could get one name only by a hash collision; then the lowest bit counts.
    k = np.where(differ > 0, np.bitwise_count((differ & -differ) - np.uint64(1)), 0).astype(np.uint64)
    label = (2 * k + (symbol >> k & np.uint64(1))).astype(np.uint8)
    for _ in range(2):
        label = _toss(label, first)
    last = np.append(first[1:], True)
    peak = ~first & ~last & (label > np.concatenate((label[:1], label[:-1]))) & (label > np.append(label[1:], label[-1:]))
    begin = np.flatnonzero(first | peak)
    size = np.diff(np.append(begin, len(symbol)))
    inside = np.arange(len(symbol)) - np.repeat(begin, size)
    name = np.add.reduceat(mix(symbol + mix(inside.astype(np.uint64))), begin)
    return mix(name + size.astype(np.uint64)), text[begin]


def sketches(texts: list[str]) -> np.ndarray:
    """One row of BINS bytes a text."""
    least = np.full(len(texts) * BINS, np.iinfo(np.uint64).max, np.uint64)

    def note(name: np.ndarray, text: np.ndarray) -> None:
        value = mix(name)
        np.minimum.at(least, text * BINS + (value & np.uint64(BINS - 1)).astype(np.int64), value >> np.uint64(7))

    parts = [codes(t) for t in texts]
    size = np.array([len(p) for p in parts], np.int64)
    symbol, text = np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.repeat(np.arange(len(texts)), size)
    level = 0
    while len(symbol):
        level += 1
        symbol, text = phrases(symbol, text)
        own = slice(None) if level > 1 else np.bincount(text, minlength=len(texts))[text] < FEW_PHRASES
        note(symbol[own], text[own])
        alone = np.ones(len(text), bool)
        alone[1:] &= text[1:] != text[:-1]
        alone[:-1] &= text[1:] != text[:-1]
        note(symbol[alone] ^ np.uint64(0xA5), text[alone])  # the whole text
        symbol, text = symbol[~alone], text[~alone]
    none = least == np.iinfo(np.uint64).max
    return np.where(none, 0, 1 + least % np.uint64(_VALUES)).astype(np.uint8).reshape(-1, BINS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From 0 to 1, row by row; texts without any name are alike."""
    either = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    share = np.where(either > 0, same / np.maximum(either, 1), 1.0)
    share = np.clip((share - 1 / _VALUES) / (1 - 1 / _VALUES), 0, 1)
    return 2 * share / (1 + share)


def sketched(texts: list[str]) -> np.ndarray:
    """``sketches``, a bounded number of characters at a time (a longer text alone)."""
    out, held, n = [np.zeros((0, BINS), np.uint8)], [], 0
    for text in texts:
        if held and n + len(text) > BATCH_CHARS:
            out.append(sketches(held))
            held, n = [], 0
        held.append(text)
        n += len(text)
    if held:
        out.append(sketches(held))
    return np.concatenate(out)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``fingerprint`` (hexadecimal) of each whole text; a null text counts as empty."""
    docs = docs.drop("fingerprint")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(fingerprint=[x.tobytes().hex() for x in sketched([t or "" for t in pdf["text"]])])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInPandas(run, f"{columns}, fingerprint string")


def _dealt(docs: DataFrame, buckets: int) -> DataFrame | None:
    """Rows in buckets of consecutive ids, each bucket with the first rows of the next one, marked ``head``.

    The bounds are quantiles of the ids; the first id of each bucket is all the driver sees.
    """
    shares = [i / buckets for i in range(1, buckets)]
    found = docs.agg(F.expr(f"percentile_approx(doc, array({', '.join(map(str, shares))}), 20000)").alias("q")).first()["q"] if shares else []
    bounds = sorted(set(found or []))
    bucket = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col("doc"))) if bounds else F.lit(0)
    placed = docs.withColumn("bucket", bucket.cast("int"))
    firsts = {r["bucket"]: r["first"] for r in placed.groupBy("bucket").agg(F.min("doc").alias("first")).collect()}
    if not firsts:
        return None
    order = sorted(firsts)
    before = [(firsts[b], order[i - 1]) for i, b in enumerate(order)]  # the bucket before; for the first, the last
    heads = docs.where(F.col("doc").isin([f for f, _ in before]))
    target = F.create_map(*[F.lit(x) for pair in before for x in pair])
    heads = heads.withColumn("bucket", target[F.col("doc")].cast("int")).withColumn("head", F.lit(1))
    return placed.withColumn("head", F.lit(0)).unionByName(heads)


def edit_likeness(docs: DataFrame) -> DataFrame:
    """How far the fingerprint follows an edit and tells the next document apart.

    The edited text has its last quarter of characters (rounded down) replaced by the first
    as many, or all, of the next document. Next is by ascending doc_id (null first; rows of
    one doc_id by text); the last row's next is the first row. A null text is empty. Returns
    ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``. Other columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lowest = F.lit(-(1 << 63)).cast("long")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), lowest).alias("doc"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    dealt = _dealt(rows, min(4 * parts, 1000))
    if dealt is None:
        return spark.createDataFrame([], schema)
    dealt = dealt.repartitionByRange(parts, "bucket").sortWithinPartitions("bucket", "head", "doc", "text")

    def finish(rows: list[tuple]) -> pd.DataFrame:
        """``rows``: doc_id, text, text of the next document."""
        own, edited = [t for _, t, _ in rows], []
        for _, text, after in rows:
            n = len(text) // 4
            edited.append(text[: len(text) - n] + after[:n])
        a, b, c = sketched(own), sketched(edited), sketched([rows[-1][2]])
        return pd.DataFrame({
            "doc_id": pd.Series([r[0] for r in rows], dtype="object"), "n_chars": [len(t) for t in own],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
            "fingerprint": [x.tobytes().hex() for x in a], "edited_fingerprint": [x.tobytes().hex() for x in b],
            "near_edited": likeness(a, b), "near_next": likeness(a, np.concatenate((a[1:], c))),
        })

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[tuple] = []  # complete rows of one run of neighbours
        last, n = None, 0  # the row whose next one has not come yet
        for pdf in batches:
            for bucket, head, doc_id, text in zip(pdf["bucket"], pdf["head"], pdf["doc_id"], pdf["text"]):
                if last is not None and bucket == last[0]:
                    waiting.append((last[1], last[2], text))
                    n += len(text)
                # After the first head the bucket is done: its other heads belong to the next one alone.
                last = None if head else (bucket, doc_id, text)
                if waiting and (head or n > 4 * BATCH_CHARS):
                    yield finish(waiting)
                    waiting, n = [], 0
        if waiting:
            yield finish(waiting)

    columns = dealt.select("bucket", "head", F.col("doc_id").cast("string"), "text")
    out = columns.mapInPandas(run, schema.replace(f"doc_id {kind}", "doc_id string", 1))
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))
