"""Packing of token runs into sequences of a fixed capacity, by swap-based local search.

Pieces are dealt by hash into groups of about ``group_items``. Within a group a best-fit
start is improved by local search: a piece moves, or one or two pieces of an emptier bin
change places with one of a fuller bin, whenever the sum of squared fills rises, until no
exchange is left; bins run empty on the way and are dropped. A group wastes at most about a
bin more than one search over everything would.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize
from tidemark.llm.workers import frugal

CAPACITY = 2048
END_ID = 0
#: Words remembered per Python worker; beyond it the memory starts anew.
CACHE_WORDS = 1_000_000
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*#$%&]*)")
_BLANKS = "\t\n\v\f\r"


class WordTokenizer:
    """Token ids of a whole text, put together from those of its words.

    For tokenizers that drop white space and never join words: ids of a text are then those
    of its blank-separated words, which repeat and are remembered.
    """

    _loaded: dict[str, WordTokenizer] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(path)
        vocabulary = self.inner.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.last[i] = token.endswith("</w>")
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {"": b""}

    @classmethod
    def load(cls, path: str) -> WordTokenizer:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _learn(self, letters: set[str], others: set[str]) -> None:
        """Ids of parts that are not known yet: of plain letters many at a time, as each ends a word."""
        letters = [p for p in letters if p not in self.parts]
        for low in range(0, len(letters), 1000):
            some = letters[low : low + 1000]
            ids = np.array(self.inner.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            if len(ends) != len(some):
                raise ValueError("this tokenizer joins or splits words of letters")
            raw = ids.tobytes()
            for part, a, b in zip(some, [0, *ends], ends):
                self.parts[part] = raw[a:b]
        rest = [p for p in others if p not in self.parts]
        for part, found in zip(rest, self.inner.encode_batch_fast(rest, add_special_tokens=False)):
            self.parts[part] = np.array(found.ids, "<u4").tobytes()

    def _remember(self, new: set[str]) -> None:
        plain = {w: m for w in new if (m := _PLAIN.fullmatch(w))}
        self._learn({m[1].lower() for m in plain.values()}, {m[2] for m in plain.values()} | (new - plain.keys()))
        for w in new:
            m = plain.get(w)
            self.words[w] = self.parts[m[1].lower()] + self.parts[m[2]] if m else self.parts[w]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.words) > CACHE_WORDS:
            self.words, self.parts = {"": b""}, {"": b""}
        split, found, new, get = [], [], set(), self.words.get
        for text in texts:
            for blank in _BLANKS:
                text = text.replace(blank, " ")
            words = text.split(" ")
            known, at = list(map(get, words)), []
            try:
                while True:
                    at.append(known.index(None, at[-1] + 1 if at else 0))
            except ValueError:
                pass
            new.update([words[i] for i in at])
            split.append((words, at))
            found.append(known)
        self._remember(new)
        for (words, at), known in zip(split, found):
            for i in at:
                known[i] = self.words[words[i]]
        return [b"".join(known) for known in found]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_words: bool = True) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``: each text's ids and the end id, cut at ``capacity``.

    Without ``keep_words`` a worker forgets tokenizer and words after each task, for jobs in
    which other steps need its memory.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordTokenizer.load(tokenizer)
        step = 4 * capacity
        for pdf in batches:
            for low in range(0, len(pdf), 256):
                part, out = pdf.iloc[low : low + 256], []
                for doc_id, ids in zip(part["doc_id"], known.ids([t or "" for t in part["text"]])):
                    ids += END_ID.to_bytes(4, "little")
                    out += [(doc_id, i, at // 4, len(ids[at : at + step]) // 4, zlib.crc32(ids[at : at + step])) for i, at in enumerate(range(0, len(ids), step))]
                frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
                yield frame.astype({"doc_id": "object"}) if frame["doc_id"].isna().any() else frame
        if not keep_words:
            WordTokenizer._loaded.clear()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(frugal(run), "doc_id string, piece int, start long, length long, ids_crc32 long").withColumn("doc_id", F.col("doc_id").cast(kind))


def _best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items, largest first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has room r
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        above = rooms >> sizes[item]
        if above:
            room = sizes[item] + (above & -above).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = len(bins), capacity
            bins.append([])
        bins[b].append(item)
        room -= sizes[item]
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins


def local_search(sizes: list[int], capacity: int, bins: list[list[int]] | None = None, passes: int = 30) -> list[list[int]]:
    """Bins of item numbers. Every exchange raises the sum of squared fills, so it ends."""
    bins = [list(b) for b in (_best_fit(sizes, capacity) if bins is None else bins)]
    fill = [sum(sizes[i] for i in b) for b in bins]
    home = {i: b for b, own in enumerate(bins) for i in own}

    def exchange(b: int, out: int | None, into: tuple[int, ...], a: int) -> None:
        for i in into:
            bins[a].remove(i)
            bins[b].append(i)
            home[i] = b
        if out is not None:
            bins[b].remove(out)
            bins[a].append(out)
            home[out] = a
        gain = sum(sizes[i] for i in into) - (0 if out is None else sizes[out])
        fill[b] += gain
        fill[a] -= gain

    for _ in range(passes):
        open_bins = sorted((b for b in range(len(bins)) if 0 < fill[b] < capacity), key=lambda b: -fill[b])
        offers = []  # one or two pieces of one bin, by size
        for b in open_bins:
            own = bins[b]
            offers += [(sizes[i], (i,)) for i in own]
            offers += [(sizes[i] + sizes[j], (i, j)) for x, i in enumerate(own) for j in own[:x]]
        offers.sort()
        totals = [s for s, _ in offers]
        improved = False
        for b in open_bins:
            again = True
            while again and 0 < fill[b] < capacity:
                again, best = False, None
                for out in [None, *bins[b]]:
                    less = 0 if out is None else sizes[out]
                    at = bisect_right(totals, less + capacity - fill[b]) - 1
                    while at >= 0 and totals[at] > less and (best is None or totals[at] - less > best[0]):
                        into = offers[at][1]
                        a = home[into[0]]
                        gain = totals[at] - less
                        if a != b and home[into[-1]] == a and gain > fill[a] - fill[b]:
                            best = (gain, out, into, a)
                            break
                        at -= 1
                if best:
                    exchange(b, *best[1:])
                    again = improved = True
        if not improved:
            break
    return [b for b in bins if b]


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_items: int = 4096) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` says how much room each takes.

    Every row is placed once, repeated rows included; full pieces have sequences of their
    own. ``pieces`` is read twice, so pass a written table.
    """
    numbered = pieces.withColumn("uid", F.monotonically_increasing_id())
    whole = numbered.where(F.col("length") >= capacity)
    whole = whole.select(*pieces.columns, (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = numbered.where(F.col("length") < capacity)
    groups = max(1, round(part.count() / group_items))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid", ignore_index=True)
        sizes = pdf["length"].tolist()
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for n, own in enumerate(local_search(sizes, capacity)):
            sequence[own] = n
            offset[own] = np.cumsum([0, *(sizes[i] for i in own[:-1])])
        pdf["sequence_id"] = (pdf.pop("grp").to_numpy().astype(np.int64) << 32) + sequence
        return pdf.assign(offset=offset)

    # Where each row goes is worked out from its number alone; the other columns come back by it.
    dealt = part.select("uid", "length", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int").alias("grp"))
    placed = dealt.groupBy("grp").applyInPandas(solve, "uid long, length long, sequence_id long, offset long").drop("length")
    rest = part.join(placed, "uid").select(*pieces.columns, "sequence_id", "offset")
    return rest.unionByName(whole)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group_items: int = 4096, keep_words: bool = True) -> DataFrame:
    """Pieces of every row of ``docs`` and their places; a null text is an empty one, the end id alone."""
    return pack(materialize(pieces(docs, tokenizer, capacity, keep_words), "pieces"), capacity, group_items)
