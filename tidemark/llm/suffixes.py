"""Repeated byte windows, by longest-previous-factor arrays over suffix order.

Every 100-byte window picks the 32-byte gram inside it with the least hash (the first of
equals). Windows that share a gram with another place form segments; segments of one gram
meet in one task, with as many others as fit. There the suffixes of all segments are sorted
by prefix doubling up to the window length. A gram that too many different segments have is
replaced by longer ones around the same anchor, one for each range of its places in the window,
up to the window itself. In suffix order the nearest suffixes on either
side that start earlier in the text (previous and next smaller position) give the longest
previous factor; where it spans a window, the window came before. Only later copies go.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import repeats
from tidemark.session import materialize
from tidemark.llm.substring import RANGES, by_signature
from tidemark.llm.workers import frugal

WINDOW = 100
GRAM = 32
#: Segments (some 130 suffixes each) sorted at a time, and the rest of a gram's.
BATCH = 8000


def raw(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _words_at(data: bytes) -> np.ndarray:
    """The eight bytes from every offset that has them, as one number."""
    out = np.zeros(max(0, len(data) - 7), np.uint64)
    for k in range(min(8, len(out))):
        part = np.frombuffer(data, ">u8", count=(len(data) - k) // 8, offset=k)
        out[k::8] = part[: len(out[k::8])]
    return out


def _anchors(data: bytes, window: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each gram, and the place of the gram that each window picks."""
    at = _words_at(data)
    # Hashes of 8, 16, 32, ... bytes, each from two of half the length; the last two overlap.
    around, span = at * repeats.FACTORS[0], 8
    around ^= around >> np.uint64(32)
    while span < gram:
        step = min(span, gram - span)
        around = around[:-step] * repeats.FACTORS[0] + around[step:]
        span += step
    around = repeats.mix(around)
    return around, repeats.least_in_runs((around >> np.uint64(32)).astype(np.uint32), window - gram + 1)


def parse(data: bytes, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signature, first window and last window of each segment."""
    if len(data) < window:
        return np.zeros(0, np.uint64), *2 * (np.zeros(0, np.int64),)
    around, best = _anchors(data, window, gram)
    begin, end = repeats.segments(best)
    return around[best[begin]], begin, end


def _signatures(docs: DataFrame, firsts: repeats.Bitmap, window: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"][firsts.has(pdf["told"])]
            for low in range(0, len(texts), 500):
                yield pd.DataFrame({"sig": np.concatenate([parse(raw(t), window)[0] for t in texts.iloc[low : low + 500]]).view(np.int64)})

    return docs.select("text", "told").mapInPandas(frugal(run), "sig long")


def _read(window: int):
    def read(text: str):
        data = raw(text)
        return *parse(data, window), lambda first, last: [data[a : b + window] for a, b in zip(first, last)]

    return read


def _suffix_order(first: np.ndarray, room: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Order and class of suffixes by their first ``window`` bytes; a suffix ends with its segment.

    ``first``: the first eight bytes as a number, zero beyond the end; ``room``: bytes left.
    """
    n = len(first)

    def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(key)
        own = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([True], own[1:] != own[:-1])))
        return order, rank

    # Seven bytes, and how many of them there are, in one number.
    step = 7
    order, rank = ranked(first >> np.uint64(8) << np.uint64(8) | np.minimum(room, step).astype(np.uint64))
    while step < window:
        jump = min(step, window - step)  # the next part ends where the window does
        ahead = np.zeros(n, np.int64)
        own = np.flatnonzero(room > jump)
        ahead[own] = rank[own + jump]
        order, rank = ranked(rank * (n + 1) + ahead)
        step += jump
    return order, rank


def _nearest_smaller(position: np.ndarray) -> np.ndarray:
    """For each entry the nearest earlier one with a smaller value, or -1."""
    n = len(position)
    out = np.arange(-1, n - 1)
    active = np.arange(n)
    while True:
        active = active[out[active] >= 0]
        active = active[position[out[active]] > position[active]]
        if not len(active):
            return out
        out[active] = out[out[active]]


def longest_previous(order: np.ndarray, rank: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Whether the longest previous factor of each suffix spans the window that ``rank`` compares.

    Of all suffixes that start earlier in the text, the nearest in suffix order on either side
    share the longest prefix.
    """
    at = position[order]
    before = _nearest_smaller(at)
    after = len(at) - 1 - _nearest_smaller(at[::-1])[::-1]
    own = rank[order]
    spans = (before >= 0) & (own[np.maximum(before, 0)] == own)
    spans |= (after < len(at)) & (own[np.minimum(after, len(at) - 1)] == own)
    out = np.zeros(len(order), bool)
    out[order] = spans
    return out


def _compare(window: int):
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        # Rows come by signature, document, key and start. A repeated row adds nothing.
        place = pdf[["sig", "doc", "key", "start"]].to_numpy()
        pdf = pdf[np.concatenate(([True], (place[1:] != place[:-1]).any(axis=1)))]
        # A later copy of a whole segment is a repeat throughout; where only one kind of segment
        # has a gram, nothing else can be: the windows of one segment differ.
        copy = pdf.duplicated(["sig", "body"])
        whole_copies = pdf.loc[copy, ["doc", "key", "start", "last"]]
        pdf = pdf[~copy]
        sig = pdf["sig"].to_numpy()
        meet = sig[1:] == sig[:-1]
        pdf = pdf[np.concatenate(([False], meet)) | np.concatenate((meet, [False]))].reset_index(drop=True)
        if pdf.empty:
            return whole_copies
        parts = pdf["content"].tolist()
        size = np.array([len(x) for x in parts], np.int64)
        data, row = b"".join(parts), np.repeat(np.arange(len(pdf)), size)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        room = size[row] - inside
        first = _words_at(data + bytes(8))[: len(data)]
        short = np.flatnonzero(room < 8)
        first[short] &= ~np.uint64(0) << (8 * (8 - room[short])).astype(np.uint64)
        order, rank = _suffix_order(first, room, window)
        # Only whole windows count; the same place can stand in two segments, once as a window.
        whole = room >= window
        order = order[whole[order]]
        later = np.zeros(len(row), bool)
        place = np.cumsum(whole) - 1
        found = longest_previous(place[order], rank[whole], np.arange(int(whole.sum())))
        later[whole] = found
        at = np.flatnonzero(later)
        cut = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]]))) if len(at) else np.zeros(0, bool)
        begin = at[cut]
        end = np.append(at[np.flatnonzero(cut)[1:] - 1], at[-1:]) if len(at) else at
        start = pdf["start"].to_numpy()[row] + inside
        found = pd.DataFrame({"doc": pdf["doc"].to_numpy()[row[begin]], "key": pdf["key"].to_numpy()[row[begin]], "start": start[begin], "last": start[end]})
        return pd.concat([whole_copies, found], ignore_index=True)

    return work


def _finer(window: int, gram: int = GRAM):
    """Cuts segments by the place of the anchor in their windows, into narrower ranges at each level.

    The signature of a piece is what all windows with the anchor in that range hold around it.
    """

    def at(level: int):
        width = max(1, (window - gram + 1) >> 2 * level)

        def pieces(pdf: pd.DataFrame) -> pd.DataFrame:
            out, digest = [], xxhash.xxh3_64_intdigest
            for doc, key, start, data in zip(pdf["doc"], pdf["key"], pdf["start"], pdf["content"]):
                anchor = int(_anchors(data[:window], window, gram)[1][0])
                part = (anchor - np.arange(len(data) - window + 1)) // width
                for a, b in zip(*(x.tolist() for x in repeats.segments(part))):
                    low = int(part[a]) * width
                    high = min(low + width - 1, window - gram)
                    content = data[a : b + window]
                    out.append((digest(data[anchor - low : anchor - high + window], low), doc, key, start + a, start + b, digest(content), content))
            out = pd.DataFrame(out, columns=["sig", "doc", "key", "start", "last", "body", "content"])
            return out.assign(**{c: out[c].to_numpy(np.uint64).view(np.int64) for c in ("sig", "body")})

        return pieces

    return at


def repeated_windows(docs: DataFrame, window: int = WINDOW, hot: int = repeats.HOT) -> DataFrame:
    """``doc``, ``key``, ``start``, ``last``: ranges of windows whose bytes also start earlier."""
    rows, firsts, copies = repeats.copied_texts(repeats.keyed(docs))
    count = _signatures(rows, firsts, window).groupBy("sig").agg(F.count("*").alias("n"))
    known = repeats.shared_filter(count.where(F.col("n") > 1), hot)
    order = ["doc", "key", "start"]

    def compare(segments: DataFrame) -> DataFrame:
        return by_signature(segments, _compare(window), RANGES, *order, most=BATCH)

    found = copies.unionByName(compare(repeats.segments_of(rows, firsts, known, False, functools.partial(map, _read(window)))))
    if not known.hot.places.any():
        return found
    crowded = materialize(repeats.segments_of(rows, firsts, known, True, functools.partial(map, _read(window)), order), "crowded")
    return found.unionByName(repeats.by_finer_keys(crowded, order, compare, _finer(window), hot))


def remove_repeats(docs: DataFrame, window: int = WINDOW, hot: int = repeats.HOT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (bytes), ``kept_sha256`` of each row.

    Order is by doc_id (null first), then, among rows of one doc_id, by a hash of the text;
    rows equal in both count as one document and share its result. A null text is empty.
    Cuts may fall inside a character, so ``kept`` is binary. Other columns are ignored.
    """
    rows = repeats.with_ranges(docs, repeated_windows(docs, window, hot))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, starts, lasts in zip(pdf["text"], pdf["starts"], pdf["lasts"]):
                data = raw(text)
                gone = repeats.covered(len(data), window, starts, lasts)
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(gone) else 0
                out.append((len(data), int(gone.sum()), spans, kept, hashlib.sha256(kept).hexdigest()))
            done = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"], index=pdf.index)
            yield pd.concat([pdf[["doc_id"]], done], axis=1)

    ids = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(frugal(run), f"doc_id {ids}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
