"""Repeated word windows across documents, by recompression.

Symbols are 64-bit names, at first of words. A round names pairs: a bit of each name, drawn
anew for every round, says whether it may be a left or a right half, and a left one followed
by a right one becomes one symbol, whose name is the hash of both names. Runs of one word are
named by word and length. A name is a hash of what it stands for, so equal runs and pairs
have equal names in every task and a round needs no exchange; the names that any two
documents share are found by grouping all of them in Spark.

Each symbol carries its context: the words that decide that it is a symbol of its round. An
unmerged left half depends on its follower, a right one on its predecessor, a merged pair on
its halves. So a symbol whose context lies within a window is there in every equal window,
whatever stands around it. A window takes the symbol of the highest round among those, then
the least name; the name with its context is the signature. Windows of shared signatures are
compared in full, by 96 bits of hash. A word goes if a window over it also starts in a
document with a smaller doc_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import repeats
from tidemark.session import materialize
from tidemark.llm.workers import frugal

WINDOW = 13
_RECORD = np.dtype([("h", "<u8"), ("c", "<u4")])
#: An odd number and its inverse modulo 2**64: sums of powers hash any run of words.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def split(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def names(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words], np.uint64)


def runs(name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context (first word, word after the last) and name of each run of two or more equal words."""
    begin = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
    end = np.append(begin[1:], len(name))
    own = end - begin > 1
    begin, end = begin[own], end[own]
    return begin - 1, end + 1, repeats.mix(repeats.mix(name[begin]) + (end - begin).astype(np.uint64))


def pairs(low: np.ndarray, high: np.ndarray, name: np.ndarray, words: int, turn: int):
    """One round over all symbols of a text: contexts and names after it, and the places of the new pairs."""
    left = (repeats.mix(name + np.uint64(turn)) & np.uint64(1)).astype(bool)
    before, after = (np.concatenate(([-1], low[:-1])), np.concatenate(([0], high[:-1]))), (np.append(low[1:], words), np.append(high[1:], words + 1))
    low = np.minimum(low, np.where(left, after[0], before[0]))
    high = np.maximum(high, np.where(left, after[1], before[1]))
    joins = np.append(left[:-1] & ~left[1:], False)
    at = np.flatnonzero(joins)
    name = name.copy()
    name[at] = repeats.mix(repeats.mix(name[at]) + name[at + 1])
    stays = np.concatenate(([True], ~joins[:-1]))
    place = np.cumsum(stays) - 1
    return low[stays], high[stays], name[stays], place[at]


def symbols(name: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context, name and round of each run and pair whose context fits a window."""
    low, high = np.arange(len(name)), np.arange(1, len(name) + 1)
    a, b, title = runs(name)
    found = [(a, b, title, np.zeros(len(a), np.uint64))]
    present = name
    for turn in range(1, (window - 1).bit_length() + 1):
        low, high, present, new = pairs(low, high, present, len(name), turn)
        found.append((low[new], high[new], present[new], np.full(len(new), turn, np.uint64)))
    a, b, title, turn = (np.concatenate(x) for x in zip(*found))
    own = (b - a <= window) & (a >= 0) & (b <= len(name))
    return a[own], b[own], title[own], turn[own]


def _stretch_hash(name: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the words from ``a`` to before ``b``."""
    power = np.full(len(name), _BASE, np.uint64)
    back = np.full(len(name), _BACK, np.uint64)
    power[0] = back[0] = 1
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(name * np.multiply.accumulate(power), dtype=np.uint64)))
    return (total[b] - total[a]) * np.multiply.accumulate(back)[a]


def _segments(name: np.ndarray, row: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signature, first window and last window of each segment; ``row`` is the text of each name."""
    n = max(0, len(name) - window + 1)
    at = np.flatnonzero(row[:n] == row[len(row) - n :])  # windows within a text
    if not len(at):
        return np.zeros(0, np.uint64), at, at
    a, b, title, turn = symbols(name, window)
    # Worst first, so that the best is written last; among equal names the leftmost is.
    rank = np.argsort((np.uint64(63) - turn) << np.uint64(58) | title >> np.uint64(6), kind="stable")[::-1]
    first, last = np.maximum(b[rank] - window, 0), np.minimum(a[rank], n - 1)
    times = last - first + 1
    best = np.arange(len(a), len(a) + n)
    best[np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - first, times)] = np.repeat(rank, times)
    best, row = best[at], row[at]
    cut = np.flatnonzero(np.concatenate(([True], (best[1:] != best[:-1]) | (row[1:] != row[:-1]))))
    begin, end, own = at[cut], np.append(at[cut[1:] - 1], at[-1:]), best[cut]
    paired = own < len(a)
    sig = np.zeros(len(cut), np.uint64)
    sig[paired] = repeats.mix(title[own[paired]] ^ _stretch_hash(name, a[own[paired]], b[own[paired]]))
    sig[~paired] = repeats.mix(_stretch_hash(name, begin[~paired], begin[~paired] + window))
    return sig, begin, end


def parse(texts: list[np.ndarray], window: int = WINDOW, block: int = 20_000) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Signature, first window and last window of each segment of each text, given as names.

    A segment's windows share the occurrence of their symbol. A window without any run or
    pair of its own (one in some 600) is a segment whose signature is the hash of its words.
    What a window takes depends on its words alone, so texts are parsed one after another as
    one, and that in blocks of words; a block's end may only cut a segment in two.
    """
    size = np.array([len(x) for x in texts], np.int64)
    name, row = np.concatenate([np.zeros(0, np.uint64), *texts]), np.repeat(np.arange(len(texts)), size)
    parts = []
    for low in range(0, len(name), block):
        high = low + block + window - 1
        sig, begin, end = _segments(name[low:high], row[low:high], window)
        parts.append((sig, begin + low, end + low))
    if not parts:
        return [(np.zeros(0, np.uint64), *2 * (np.zeros(0, np.int64),))] * len(texts)
    sig, begin, end = (np.concatenate(x) for x in zip(*parts))
    owner, offset = row[begin], np.cumsum(size) - size
    begin, end = begin - offset[owner], end - offset[owner]
    edge = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    return [(sig[i:j], begin[i:j], end[i:j]) for i, j in zip(edge, edge[1:])]


def _together(texts: Iterable[str], words: int = 20_000) -> Iterator[list[np.ndarray]]:
    """Names of the words of texts, some texts at a time."""
    held, n = [], 0
    for text in texts:
        held.append(names(split(text)))
        n += len(held[-1])
        if n >= words:
            yield held
            held, n = [], 0
    yield held


def _window_records(name: np.ndarray, window: int) -> np.ndarray:
    out = np.zeros(len(name) - window + 1, _RECORD)
    out["h"] = repeats.run_hash(name, window, 1)
    out["c"] = repeats.run_hash(name, window, 2) >> np.uint64(32)
    return out


def _signatures(docs: DataFrame, firsts: repeats.Bitmap, window: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[firsts.has(pdf["told"])]
            for low in range(0, len(pdf), 500):
                part = pdf.iloc[low : low + 500]
                found = [np.unique(sig) for texts in _together(part["text"]) for sig, _, _ in parse(texts, window)]
                yield pd.DataFrame({"sig": np.concatenate(found).view(np.int64), "doc": np.repeat(part["doc"].to_numpy(), [len(x) for x in found])})

    return docs.select("doc", "text", "told").mapInPandas(frugal(run), "sig long, doc long")


def _read(window: int):
    def contents(name: np.ndarray):
        def records(first: list[int], last: list[int]) -> list[bytes]:
            raw, size = _window_records(name, window).tobytes(), _RECORD.itemsize
            return [raw[a * size : (b + 1) * size] for a, b in zip(first, last)]

        return records

    def read(texts: Iterable[str]):
        for part in _together(texts):
            for name, found in zip(part, parse(part, window)):
                yield *found, contents(name)

    return read


def _ranges(doc: np.ndarray, key: np.ndarray, start: np.ndarray, later: np.ndarray, row: np.ndarray) -> pd.DataFrame:
    """Runs of windows that come later, cut at segments."""
    at = np.flatnonzero(later)
    cut = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]]))) if len(at) else np.zeros(0, bool)
    first = at[cut]
    last = np.append(at[np.flatnonzero(cut)[1:] - 1], at[-1:]) if len(at) else at
    return pd.DataFrame({"doc": doc[row[first]], "key": key[row[first]], "start": start[first], "last": start[last]})


def _compare(pdf: pd.DataFrame) -> pd.DataFrame:
    """Ranges of windows whose content also starts in a smaller document of this table."""
    if pdf.empty:
        return pd.DataFrame(columns=["doc", "key", "start", "last"], dtype="int64")
    least = pdf.groupby(["sig", "body"], sort=False)["doc"].transform("min")
    whole = pdf.loc[pdf["doc"] > least, ["doc", "key", "start", "last"]]  # all of it stands in that document
    pdf = pdf[pdf["doc"] == least]
    pdf = pdf[pdf.groupby("sig")["doc"].transform("nunique") > 1].reset_index(drop=True)
    if pdf.empty:
        return whole
    raw = pdf["content"].tolist()
    size = np.array([len(x) // _RECORD.itemsize for x in raw])
    record, row = np.frombuffer(b"".join(raw), _RECORD), np.repeat(np.arange(len(pdf)), size)
    doc, key = pdf["doc"].to_numpy(), pdf["key"].to_numpy()
    start = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + pdf["start"].to_numpy()[row]
    order = np.lexsort((doc[row], record["c"], record["h"]))
    h, c, d = record["h"][order], record["c"][order], doc[row][order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))
    later = np.zeros(len(row), bool)
    later[order] = d > d[np.flatnonzero(new)][np.cumsum(new) - 1]
    return pd.concat([whole, _ranges(doc, key, start, later, row)], ignore_index=True)


def by_signature(rows: DataFrame, work, schema: str, *then: str, most: int = 60_000) -> DataFrame:
    """``work`` over tables of whole signatures, at least ``most`` rows at a time where there are so many.

    Rows of a signature come in the order of the columns ``then``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for pdf in batches:
            held.append(pdf)
            n += len(pdf)
            if n < most:
                continue
            pdf = pd.concat(held, ignore_index=True)
            sig = pdf["sig"].to_numpy()
            cut = int(np.searchsorted(sig, sig[-1]))
            if cut:
                yield work(pdf.iloc[:cut].reset_index(drop=True))
            held, n = [pdf.iloc[cut:]], len(pdf) - cut
        if n:
            yield work(pd.concat(held, ignore_index=True))

    return rows.repartition("sig").sortWithinPartitions("sig", *then).mapInPandas(frugal(run), schema)


RANGES = "doc long, key long, start int, last int"


def _single(level: int):
    """Cuts segments into windows; the signature of a window is a hash of all of it, so one level is enough."""

    def pieces(pdf: pd.DataFrame) -> pd.DataFrame:
        raw, width = pdf["content"].tolist(), _RECORD.itemsize
        size = np.array([len(x) // width for x in raw], np.int64)
        data, row = b"".join(raw), np.repeat(np.arange(len(pdf)), size)
        record = np.frombuffer(data, _RECORD)
        start = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + pdf["start"].to_numpy()[row]
        return pd.DataFrame({
            "sig": record["h"].astype(np.uint64).view(np.int64), "doc": pdf["doc"].to_numpy()[row], "key": pdf["key"].to_numpy()[row],
            "start": start, "last": start, "body": record["c"].astype(np.int64), "content": [data[i : i + width] for i in range(0, len(data), width)],
        })

    return pieces


def repeated_windows(docs: DataFrame, window: int = WINDOW, hot: int = repeats.HOT) -> DataFrame:
    """``doc``, ``key``, ``start``, ``last``: ranges of windows that also start in a smaller document."""
    rows, firsts, copies = repeats.copied_texts(repeats.keyed(docs))
    count = _signatures(rows, firsts, window).groupBy("sig").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("n"))
    known = repeats.shared_filter(count.where(F.col("a") != F.col("b")), hot)

    def compare(segments: DataFrame) -> DataFrame:
        return by_signature(segments, _compare, RANGES, most=20_000)

    found = copies.unionByName(compare(repeats.segments_of(rows, firsts, known, False, _read(window))))
    if not known.hot.places.any():
        return found
    crowded = materialize(repeats.segments_of(rows, firsts, known, True, _read(window), ["doc"]), "crowded")
    return found.unionByName(repeats.by_finer_keys(crowded, ["doc"], compare, _single, hot))


def remove_repeats(docs: DataFrame, window: int = WINDOW, hot: int = repeats.HOT) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (words joined by a space), ``kept_sha256`` of each row.

    A null or empty text has no words; a text of fewer than ``window`` words keeps all.
    Rows of one doc_id never remove from each other; a null doc_id is the smallest. Other
    columns are ignored.
    """
    rows = repeats.with_ranges(docs, repeated_windows(docs, window, hot))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, starts, lasts in zip(pdf["text"], pdf["starts"], pdf["lasts"]):
                words = split(text)
                gone = repeats.covered(len(words), window, starts, lasts)
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                out.append((len(words), int(gone.sum()), kept.decode("utf-8", "surrogatepass"), hashlib.sha256(kept).hexdigest()))
            done = pd.DataFrame(out, columns=["n_words", "n_removed", "kept", "kept_sha256"], index=pdf.index)
            yield pd.concat([pdf[["doc_id"]], done], axis=1)

    ids = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(frugal(run), f"doc_id {ids}, n_words long, n_removed long, kept string, kept_sha256 string")
