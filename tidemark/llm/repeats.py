"""What the two exact-repeat operators share: anchors, the filter of shared anchors, removal.

Every window of a text picks one anchor inside it, by a rule that sees nothing but the
window, so equal windows pick equal anchors. Neighbouring windows mostly pick the same one;
they form a segment. An anchor's signature is a hash of what stands around it inside all
windows that can pick it. Only segments whose signature occurs elsewhere can hold a repeat.

Which signatures are shared is worked out by grouping them all; the scan that then emits
segments only asks a bitmap of at most MOST_BITS bits whether to emit. A wrong yes costs a
row, never a result. Segments of a signature with more than ``hot`` occurrences are settled
before they meet: equal ones as a whole, by partial aggregation, and while more than ``hot``
kinds are left, their windows get longer signatures (``by_finer_keys``). So no task holds a
passage that a large part of all documents have, and every size is compared in one way. A
text that a smaller document has as a whole goes as a whole and is not cut into segments.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize
from tidemark.llm.workers import frugal

HOT = 2000
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
FACTORS = tuple(np.uint64(x) for x in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(32))) * _B
    x = (x ^ (x >> np.uint64(29))) * _A
    return x ^ (x >> np.uint64(32))


def run_hash(values: np.ndarray, span: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``span`` values: a polynomial of them, its factor chosen by ``seed``."""
    n = max(0, len(values) - span + 1)
    out = np.full(n, seed, np.uint64)
    for k in range(span):
        out *= FACTORS[seed]
        out += values[k : k + n]
    return mix(out)


def least_in_runs(values: np.ndarray, span: int) -> np.ndarray:
    """Place of the first of the least values of each run of ``span`` 32-bit values."""
    best = (values.astype(np.uint64) << np.uint64(32)) | np.arange(len(values), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        best = np.minimum(best[: len(best) - width], best[width:])
        width *= 2
    if width < span:
        best = np.minimum(best[: len(best) - (span - width)], best[span - width :])
    return (best & np.uint64(0xFFFFFFFF)).astype(np.int64)


def segments(anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each run of windows with one anchor."""
    begin = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))) if len(anchor) else np.zeros(0, np.int64)
    return begin, np.append(begin[1:], len(anchor)) - 1 if len(anchor) else begin


def keyed(docs: DataFrame) -> DataFrame:
    """``doc`` (doc_id, null first), ``key`` (tells rows of one doc_id apart by their text), ``doc_id``, ``text``."""
    lowest = F.lit(-(1 << 63)).cast("long")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), lowest).alias("doc"),
        F.xxhash64("doc_id", "text").alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("text"),
    )


@dataclass
class Bitmap:
    """A set of 64-bit values, by their low bits: a wrong yes is possible, a wrong no is not."""

    bits: int
    places: np.ndarray

    def has(self, value) -> np.ndarray:
        value = np.asarray(value).view(np.uint64)
        at = (value & np.uint64(self.bits - 1)).astype(np.int64)
        return (self.places[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def bitmap(rows: DataFrame, value: Column, count: int) -> Bitmap:
    """``count``: how many values to make room for."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * count - 1).bit_length() if count else 0))
    at = value.bitwiseAND(F.lit(bits - 1).cast("long"))
    # One row per 32,768 bits comes to the driver.
    made = rows.select(at.alias("at")).select((F.col("at") / 32768).cast("long").alias("bucket"), F.pmod("at", F.lit(32768)).alias("place"))
    made = made.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("map"))
    out = np.zeros(bits // 8, np.uint8)
    for bucket, found in made.collect():
        out[bucket * 4096 : (bucket + 1) * 4096] = np.frombuffer(bytes(found), np.uint8)[: max(0, len(out) - bucket * 4096)]
    return Bitmap(bits, out)


#: The start of the last window of a text that goes as a whole.
TO_THE_END = 1 << 30


def copied_texts(rows: DataFrame) -> tuple[DataFrame, Bitmap, DataFrame]:
    """``rows`` with ``told``, the values of it whose text no smaller document has, and the ranges (whole texts) of the others.

    Texts are told apart by 96 bits of hash and their length. The bitmap is one of the first
    documents of all texts, so it may hold a few later copies too.
    """
    same = [F.xxhash64("text").alias("h"), F.hash("text").alias("g"), F.length("text").alias("n")]
    told = rows.select("doc", "key", *same)
    first = materialize(told.groupBy("h", "g", "n").agg(F.min("doc").alias("first")), "texts")
    firsts = bitmap(first, F.xxhash64("h", "g", "n", "first"), first.count())
    later = told.join(first, ["h", "g", "n"]).where(F.col("doc") > F.col("first"))
    return (
        rows.withColumn("told", F.xxhash64(*same, "doc")), firsts,
        later.select("doc", "key", F.lit(0).alias("start"), F.lit(TO_THE_END).alias("last")),
    )


@dataclass
class Filter:
    """Signatures that are shared, and those that are crowded."""

    shared: Bitmap
    hot: Bitmap


def shared_filter(counted: DataFrame, hot: int = HOT) -> Filter:
    """``counted`` has ``sig`` and ``n`` (occurrences) of every signature that is shared."""
    counted = materialize(counted.select("sig", "n"), "shared")
    crowded = counted.where(F.col("n") > hot)
    return Filter(bitmap(counted, F.col("sig"), counted.count()), bitmap(crowded, F.col("sig"), crowded.count()))


def _combined(rows: pd.DataFrame, order: list[str]) -> pd.DataFrame:
    """Map-side combine: rows after the first of their kind here become plain ranges, neighbours joined.

    ``rows`` are in the order of the texts; a range has no content.
    """
    ranked = rows.sort_values(order, kind="stable")
    first = ranked.drop_duplicates(["sig", "body"]).set_index(["sig", "body"])[order]
    least = first.loc[pd.MultiIndex.from_frame(rows[["sig", "body"]])].to_numpy()
    later = (rows[order].to_numpy() != least).any(axis=1)
    gone = rows[later]
    doc, key, start, last = (gone[c].to_numpy() for c in ("doc", "key", "start", "last"))
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (start[1:] != last[:-1] + 1)))[: len(gone)]
    ranges = gone[new].assign(last=last[np.append(new[1:], True)] if len(gone) else last, content=None)
    return pd.concat([rows[~later], ranges], ignore_index=True)


SEGMENTS = "sig long, doc long, key long, start int, last int, body long, content binary"


def segments_of(docs: DataFrame, firsts: Bitmap, known: Filter, crowded: bool, read, order: list[str] | None = None) -> DataFrame:
    """``sig``, ``doc``, ``key``, ``start``, ``last``, ``body``, ``content`` of every segment that may be shared.

    ``read(texts)`` yields, for each, signature, first and last window of each segment, and a function
    from lists of first and last windows to contents. ``body`` is a hash of the content. With ``order``
    segments that come later than an equal one of the same batch are ranges: without content.
    """

    def table(pdf: pd.DataFrame, row: list, held: list, content: list) -> pd.DataFrame:
        row = np.repeat(np.array(row, np.int64), [len(x[0]) for x in held])
        sig, begin, end = (np.concatenate([x[i] for x in held]) for i in range(3))
        body = np.array([xxhash.xxh3_64_intdigest(x) for x in content], np.uint64).view(np.int64)
        out = pd.DataFrame({
            "sig": sig.view(np.int64), "doc": pdf["doc"].to_numpy()[row], "key": pdf["key"].to_numpy()[row],
            "start": begin.astype(np.int32), "last": end.astype(np.int32), "body": body, "content": content,
        })
        return _combined(out, order) if order else out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf, row, held, content = pdf[firsts.has(pdf["told"])], [], [], []
            for i, (sig, begin, end, contents) in enumerate(read(pdf["text"])):
                own = np.flatnonzero(known.shared.has(sig) & (known.hot.has(sig) == crowded))
                if len(own):
                    row.append(i)
                    held.append((sig[own], begin[own], end[own]))
                    content += contents(begin[own].tolist(), end[own].tolist())
                if len(content) > 20_000:
                    yield table(pdf, row, held, content)
                    row, held, content = [], [], []
            if content:
                yield table(pdf, row, held, content)

    return docs.select("doc", "key", "text", "told").mapInPandas(frugal(run), SEGMENTS)


def by_finer_keys(rows: DataFrame, order: list[str], compare, finer, most: int) -> DataFrame:
    """Ranges of windows after the first of their content, for written segments of crowded signatures.

    ``rows`` are segments and ranges (without content); documents come in the order of the columns
    ``order``. A segment that is not in the bitmap of the first of each kind is a later copy as a
    whole. The kinds of a signature that has at most ``most`` go to ``compare(rows)``. Those of the
    others are cut by ``finer(level)``, a function of a pandas table, into segments whose signatures
    cover more of each window, and all starts again. Equal windows share a signature at every level,
    and at the last one it covers the whole window, so that only one kind is left.
    """
    kind, ranges, level, out = F.xxhash64("sig", "body", F.struct(*order)), ["doc", "key", "start", "last"], 0, []
    while True:
        out.append(rows.where(F.col("content").isNull()).select(*ranges))
        rows = rows.where(F.col("content").isNotNull())
        kinds = materialize(rows.groupBy("sig", "body").agg(F.min(F.struct(*order)).alias("first")), "kinds")
        firsts = bitmap(kinds, F.xxhash64("sig", "body", "first"), kinds.count())
        crowd = materialize(kinds.groupBy("sig").agg(F.count("*").alias("n")).where(F.col("n") > most), "crowd")
        many = bitmap(crowd, F.col("sig"), crowd.count())
        sort = F.pandas_udf(_sorting(firsts, many), "int")(kind, F.col("sig"))
        out.append(rows.where(sort == 0).select(*ranges))
        out.append(compare(rows.where(sort == 1)))
        if not many.places.any():
            break
        level += 1
        rows = materialize(_cut(rows.withColumn("kind", kind), firsts, many, finer(level), order), "finer")
    return functools.reduce(DataFrame.unionByName, out)


def _sorting(firsts: Bitmap, many: Bitmap):
    """0 for later copies, 1 for kinds to compare, 2 for those of a crowded signature."""

    def sort(kind: pd.Series, sig: pd.Series) -> pd.Series:
        return pd.Series(np.where(firsts.has(kind), 1 + many.has(sig), 0))

    return sort


def _cut(rows: DataFrame, firsts: Bitmap, many: Bitmap, pieces, order: list[str]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[firsts.has(pdf["kind"]) & many.has(pdf["sig"])].sort_values(["doc", "key", "start"])
            for low in range(0, len(pdf), 2000):
                yield _combined(pieces(pdf.iloc[low : low + 2000]), order)

    return rows.mapInPandas(frugal(run), SEGMENTS)


def with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """``keyed`` rows with ``starts`` and ``lasts``: the window ranges to remove, or null."""
    found = ranges.groupBy("doc", "key").agg(F.collect_list("start").alias("starts"), F.collect_list("last").alias("lasts"))
    return keyed(docs).join(found, ["doc", "key"], "left").select("doc_id", "text", "starts", "lasts")


def covered(n: int, span: int, starts: np.ndarray | None, lasts: np.ndarray | None) -> np.ndarray:
    """Which of ``n`` units lie in a window that begins in one of the ranges."""
    if starts is None or not len(starts) or n < span:
        return np.zeros(n, bool)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.asarray(starts), 1)
    np.add.at(change, np.minimum(np.asarray(lasts) + span, n), -1)
    return np.cumsum(change[:-1]) > 0
