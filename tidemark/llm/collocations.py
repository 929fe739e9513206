"""Collocations from a prefix-free parse.

A piece of text (words between stops) is cut where the hash of ``overlap`` consecutive words
is divisible by ``modulus``. A chunk runs from one such place to the next and on through the
words that triggered it, so neighbours overlap by exactly ``overlap`` words and where a chunk
ends depends on the words alone: repeated passages give the same chunks. Spark counts each
distinct chunk once (the dictionary, with its frequency in the parse), and phrases are counted
inside distinct chunks, times that frequency. A phrase belongs to the chunk that its first
word is in before the overlap; with ``overlap`` one less than the longest phrase it lies in that
chunk whole, so every occurrence counts exactly once.

A frequent phrase has frequent parts only. Words are counted first, then pairs of words that
a bitmap of frequent words lets through, then longer phrases whose pairs a bitmap of frequent
pairs lets through. A bitmap has at most 32 MB and errs to the safe side: what it lets through
wrongly is counted and dropped.

Odd input: a null text is empty, a null language is ``und``, texts without a word leave no
trace, equal rows count as often as they stand there, an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.repeats import Bitmap, bitmap
from tidemark.session import materialize

#: Fixed values of the splitting rule: stops, and what becomes of each byte.
STOPS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes(10 if b in STOPS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
#: Words of long pieces hashed at a time.
FLUSH_WORDS = 1 << 18
WIDE = "decimal(38,0)"


def _triggers(words: list[bytes], overlap: int, modulus: int) -> np.ndarray:
    """Whether a trigger starts at each word of a run of words (piece ends not considered)."""
    code = np.fromiter(map(crc32, words), np.uint64, len(words))
    out = np.zeros(len(words), bool)
    if len(words) >= overlap:
        window = np.zeros(len(words) - overlap + 1, np.uint64)
        for i in range(overlap):
            window = (window ^ (window >> np.uint64(29))) * _MIX[i % len(_MIX)] + code[i : i + len(window)]
        window = (window ^ (window >> np.uint64(32))) * _MIX[0]
        out[: len(window)] = (window >> np.uint64(33)) % np.uint64(modulus) == 0
    return out


class _Parser:
    """Chunks of the pieces it is given, counted."""

    def __init__(self, overlap: int, modulus: int):
        self.overlap, self.modulus = overlap, modulus
        self.found: Counter = Counter()
        self.words: list[bytes] = []
        self.pieces: list[tuple[str, int]] = []

    def add(self, lang: str, text: str) -> None:
        for piece in text.encode().translate(_BYTES).split(b"\n"):
            words = piece.split()
            if len(words) <= self.overlap:
                if words:
                    self.found[lang, b" ".join(words), len(words)] += 1
                continue
            self.words += words
            self.pieces.append((lang, len(words)))
            if len(self.words) > FLUSH_WORDS:
                self.cut()

    def cut(self) -> None:
        words, overlap = self.words, self.overlap
        starts = np.flatnonzero(_triggers(words, overlap, self.modulus))
        low = 0
        for lang, n in self.pieces:
            first, last = np.searchsorted(starts, (low + 1, low + n - overlap + 1))
            begin = low
            for at in starts[first:last].tolist():
                self.found[lang, b" ".join(words[begin : at + overlap]), at - begin] += 1
                begin = at
            self.found[lang, b" ".join(words[begin : low + n]), low + n - begin] += 1
            low += n
        self.words, self.pieces = [], []

    def take(self) -> pa.RecordBatch:
        self.cut()
        keys, times = list(self.found), list(self.found.values())
        self.found = Counter()
        lang, chunk, own = zip(*keys) if keys else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(chunk, pa.binary()).cast(pa.string()), pa.array(own, pa.int32()), pa.array(times, pa.int64())],
            names=["lang", "chunk", "own", "times"],
        )


def dictionary(docs: DataFrame, longest: int = 5, modulus: int = 24) -> DataFrame:
    """Distinct chunks: ``lang``, ``chunk`` (words joined by a space), ``own`` (how many of its
    words start phrases that belong to it) and ``times`` (its frequency in the parse)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parser = _Parser(longest - 1, modulus)
            for lang, text in zip(batch.column(0), batch.column(1)):
                parser.add(lang.as_py(), text.as_py())
            yield parser.take()

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    chunks = texts.mapInArrow(parse, "lang string, chunk string, own int, times long")
    return chunks.groupBy("lang", "chunk", "own").agg(F.sum("times").alias("times"))


def _word_counts(chunks: DataFrame) -> DataFrame:
    words = chunks.select("lang", "times", F.explode(F.slice(F.split("chunk", " "), F.lit(1), F.col("own"))).alias("phrase"))
    return words.groupBy("lang", "phrase").agg(F.sum("times").alias("f"))


def _allowed(langs: list[str], phrases: list[bytes], allowed: Bitmap) -> np.ndarray:
    """As ``xxhash64(lang, phrase)`` in Spark."""
    seed = {x: xxhash.xxh64_intdigest(x.encode(), 42) for x in set(langs)}
    hashed = (xxhash.xxh64_intdigest(p, seed[x]) for x, p in zip(langs, phrases))
    return allowed.has(np.fromiter(hashed, np.uint64, len(phrases)))


def _grams(batch: pa.RecordBatch, base: int, longest: int, allowed: Bitmap) -> Iterator[pa.RecordBatch]:
    """Phrases of base + 1 to longest words of a batch of chunks, all of whose ``base``-word parts are allowed."""
    lists = pc.split_pattern(batch.column(1), " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    word, texts = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.binary())
    chunk = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    left = (offsets[1:] - offsets[0])[chunk] - np.arange(len(word))  # words to the end of the chunk
    owned = np.arange(len(word)) - (offsets[:-1] - offsets[0])[chunk] < batch.column(2).to_numpy()[chunk]
    times = batch.column(3).to_numpy()[chunk]
    langs = batch.column(0).dictionary_encode()
    code, names = langs.indices.to_numpy().astype(np.int64)[chunk], langs.dictionary.to_pylist()
    lang_of = code

    def text_of(at: np.ndarray, k: int) -> pa.Array:
        return pc.binary_join_element_wise(*[texts.take(pa.array(word[at + i])) for i in range(k)], pa.scalar(b" "))

    at = np.arange(len(word))
    fits = None  # of the positions where the last level was allowed: whether the base gram there is
    for k in range(1, longest + 1):
        at = at[left[at] >= k]
        if k > base:  # both this place's and the next place's phrase of k - 1 words must have passed
            at = at[fits[at] & fits[np.minimum(at + 1, len(word) - 1)]]
        grown = code[at] * len(texts) + word[at + k - 1]
        distinct, first, which = np.unique(grown, return_index=True, return_inverse=True)
        code = np.zeros(len(word), np.int64)
        code[at] = which
        now = np.zeros(len(word), bool)
        if k == base and len(at):
            begin = at[first]
            good = _allowed([names[i] for i in lang_of[begin]], text_of(begin, k).to_pylist(), allowed)
            now[at] = good[which]
        elif k > base:
            now[at] = True
            mine = owned[at]
            total = np.bincount(which[mine], times[at][mine], len(distinct)).astype(np.int64)
            begin, total = at[first[total > 0]], total[total > 0]
            if len(begin):
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(lang_of[begin])), text_of(begin, k).cast(pa.string()), pa.array(np.full(len(begin), k, np.int32)), pa.array(total)],
                    names=["lang", "phrase", "k", "f"],
                )
        fits = now


def _phrase_counts(chunks: DataFrame, parts: DataFrame, base: int, longest: int, least: int) -> DataFrame:
    """Phrases of base + 1 to longest words with at least ``least`` occurrences."""
    allowed = bitmap(parts, F.xxhash64("lang", "phrase"), parts.count())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _grams(batch, base, longest, allowed)

    counted = chunks.mapInArrow(count, "lang string, phrase string, k int, f long")
    return counted.groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def phrase_counts(chunks: DataFrame, longest: int = 5, least: int = 100) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words with at least ``least`` occurrences (``lang``,
    ``phrase``, ``k`` words, ``f``), and the number ``n`` of words per language."""
    words = materialize(_word_counts(chunks), "collocation-words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    out = materialize(words.where(F.col("f") >= least).select("lang", "phrase", F.lit(1).alias("k"), "f"), "collocation-1")
    level = out
    for base, top in ((1, 2), (2, longest)):
        if top > base:
            level = materialize(_phrase_counts(chunks, level, base, top, least), f"collocation-{top}")
            out = out.unionByName(level)
    return out, totals


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases of two words or more with their weakest cut: ``lang``, ``phrase``, ``k``, ``a``, ``l``, ``r``, ``n``, ``score``.

    The score of a cut is floor(1000 * a * n / (l * r)), in 38-digit whole numbers.
    """
    part = counts.select("lang", "phrase", "f")
    words = F.split("phrase", " ")
    cuts = counts.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns(
        {"first": F.array_join(F.slice(words, F.lit(1), F.col("cut")), " "), "rest": F.array_join(F.slice(words, F.col("cut") + 1, F.col("k")), " ")}
    )
    sides = cuts.join(part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    sides = sides.join(part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(totals, "lang")
    score = F.expr("(1000BD * cast(a as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    cut = F.struct(score.alias("score"), "cut", "l", "r")
    best = sides.groupBy("lang", "phrase", "k", "a", "n").agg(F.min(cut).alias("c"))
    return best.select("lang", "phrase", "k", "a", "c.l", "c.r", "n", "c.score")


def without_parts(phrases: DataFrame, percent: int = 100) -> DataFrame:
    """Leaves out phrases inside a longer one with at least ``percent`` per cent of their occurrences.

    A part at a distance lies inside a phrase between the two that occurs at least as often as
    the longer one, so only phrases longer by one word need a look.
    """
    words = F.split("phrase", " ")
    inside = F.array(F.array_join(F.slice(words, F.lit(1), F.col("k") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("k") - 1), " "))
    longer = phrases.where("k > 2").select("lang", F.explode(inside).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = phrases.join(longer, ["lang", "phrase"], "left")
    covered = F.col("longer").cast(WIDE) * 100 >= F.col("a").cast(WIDE) * percent
    return kept.where(~F.coalesce(covered, F.lit(False))).drop("longer")


def best(phrases: DataFrame, top: int = 2000, parts: int = 256) -> DataFrame:
    """The first ``top`` of each language with ``rank``: by score and ``a`` falling, then phrase.

    A language's phrases are first cut to ``top`` in each of ``parts`` slices by hash, so what
    is ranked in one task has a bound.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slice_ = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    some = phrases.withColumn("slice", slice_).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order)))
    some = some.where(F.col("rank") <= top).drop("slice", "rank")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top)


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000, modulus: int = 24) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language by pointwise association."""
    chunks = materialize(dictionary(docs, longest, modulus), "chunks")
    counts, totals = phrase_counts(chunks, longest, least)
    phrases = materialize(scored(counts, totals), "collocations")
    found = best(without_parts(phrases), top)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
