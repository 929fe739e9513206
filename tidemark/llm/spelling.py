"""Spelling variants: words one edit apart, found by PartEnum signatures.

A word's letters are a binary vector with one place for each (letter, occurrence): "noon" has
n1, n2, o1, o2. One inserted, deleted or replaced letter changes at most two places. The places
are dealt into ``GROUPS`` groups by hash. Two vectors that differ in at most two places differ
in at most two groups, so of the signatures made of all groups but two (one for each choice of
the two), at least one is equal. Vectors are joined on equal signatures. Anagrams share one
vector and can't be one edit apart, so distinct vectors are joined, not words; the join itself
compares the sorted letters and passes on near vectors only. Their words are then compared
letter by letter. A signature adds 64-bit hashes of its places: a clash costs a comparison and
changes nothing.

Odd input: a null text has no words, a null doc_id counts as an empty one, equal rows count as
often as they stand there, ties of frequency go to the word that is smaller in code-point order,
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

#: Groups of vector places; a vector has a signature for each two of them.
GROUPS = 10
#: Fixed value: the letters of a word.
LETTERS = r"([A-Za-zÀ-ÿ]+)"
#: Words whose signatures are made at a time.
BLOCK = 4096


def lowered(text: Column) -> Column:
    """A-Z in lower case, and nothing else."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def letter_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` (text, null as empty) and ``run``, lower-cased, one row for each run of letters."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(F.regexp_extract_all("text", F.lit(LETTERS), 1)).alias("run"))
    return runs.select("doc_id", lowered(F.col("run")).alias("run"))


def misprinted(runs: DataFrame, one_in: int = 97) -> DataFrame:
    """``word``: the run, of which one in ``one_in`` by CRC-32 of ``<doc_id>:<run>`` loses a letter."""
    h = F.crc32(F.concat_ws(":", "doc_id", "run").cast("binary"))
    at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run")).alias("word"))


def word_counts(words: DataFrame, letters: int = 5, least: int = 3) -> DataFrame:
    """``word``, ``n`` of the words of at least ``letters`` letters that occur ``least`` times or more."""
    long_enough = words.where(F.char_length("word") >= letters)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(vectors: list[str], groups: int = GROUPS) -> np.ndarray:
    """One row of signatures for each word given with its letters sorted."""
    code = np.frombuffer("".join(vectors).encode("utf-32-le"), np.uint32).astype(np.int64)
    own = np.repeat(np.arange(len(vectors)), [len(v) for v in vectors])
    at = np.arange(len(code))
    begins = np.ones(len(code), bool)
    begins[1:] = (code[1:] != code[:-1]) | (own[1:] != own[:-1])
    occurrence = at - np.maximum.accumulate(np.where(begins, at, 0))
    place = _mix((code << 32 | occurrence).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    sums = np.zeros((len(vectors), groups), np.uint64)
    np.add.at(sums, (own, ((place >> np.uint64(7)) % np.uint64(groups)).astype(np.int64)), place)
    whole = sums.sum(axis=1)
    out = [_mix((whole - sums[:, i] - sums[:, j]) ^ np.uint64((i * groups + j) << 50)) for i, j in combinations(range(groups), 2)]
    return np.stack(out, axis=1).view(np.int64)


def near_vectors(vectors: DataFrame, groups: int = GROUPS) -> DataFrame:
    """Pairs ``va`` < ``vb`` of the distinct ``vector`` values (sorted letters) that may differ in two places at most."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for low in range(0, len(pdf), BLOCK):
                part = pdf["vector"].iloc[low : low + BLOCK].to_numpy()
                made = signatures(part.tolist(), groups)
                yield pd.DataFrame({"sig": made.ravel(), "vector": np.repeat(part, made.shape[1])})

    signed = vectors.mapInPandas(sign, "sig long, vector string")
    # Spark takes ``signed`` for as many rows as ``vectors`` has, not one for each signature: neither side may be sent to all.
    a, b = signed.select("sig", F.col("vector").alias("va")).hint("merge"), signed.select("sig", F.col("vector").alias("vb"))
    # Two places apart, sorted letters are at most one deletion and one insertion apart; -1: farther.
    near = (F.col("va") < F.col("vb")) & (F.abs(F.char_length("va") - F.char_length("vb")) <= 1) & (F.levenshtein("va", "vb", 2) >= 0)
    return a.join(b, (a["sig"] == b["sig"]) & near).select("va", "vb").distinct()


def near_words(counts: DataFrame, groups: int = GROUPS) -> DataFrame:
    """``word``, ``other``, ``other_n`` for all words of ``counts`` (``word``, ``n``) that differ by exactly one
    inserted, deleted or replaced letter; each pair in both directions."""
    words = materialize(counts.select("word", "n", F.array_join(F.array_sort(F.split("word", "")), "").alias("vector")), "spelling-words")
    pairs = materialize(near_vectors(words.select("vector").distinct(), groups), "spelling-vectors")
    left = words.select(F.col("vector").alias("va"), F.col("word").alias("a"), F.col("n").alias("an"))
    right = words.select(F.col("vector").alias("vb"), F.col("word").alias("b"), F.col("n").alias("bn"))
    one_apart = (F.abs(F.char_length("a") - F.char_length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)
    met = pairs.join(left, "va")
    found = met.join(right, (met["vb"] == right["vb"]) & one_apart)
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("bn").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("an").alias("other_n")),
    )
    return found.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` for a table of ``word``, ``form`` without cycles: forms followed to the last.

    Every round doubles the steps taken, so a chain of d forms needs log2(d) rounds. None keeps its table on the driver.
    """
    state = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = materialize(state.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        state = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return state


def variants(counts: DataFrame, ratio: int = 2, groups: int = GROUPS) -> DataFrame:
    """Each word of ``counts`` with the commoner word it is a variant of.

    ``form`` is its most frequent near word, if that is at least ``ratio`` times as frequent;
    ``root`` the end of the chain of forms, or the word itself. Columns: ``word``, ``form``,
    ``root``, ``n``, ``n_near``, ``form_n``.
    """
    counts = materialize(counts.select("word", "n"), "spelling-counts")
    first = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other")))
    met = near_words(counts, groups).groupBy("word").agg(F.count("*").alias("n_near"), first.alias("f"))
    joined = counts.join(met, "word", "left")
    enough = -F.col("f.m") >= F.col("n") * ratio
    table = materialize(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("f.other")).alias("form"), F.when(enough, -F.col("f.m")).alias("form_n"),
        ),
        "spelling-forms",
    )
    found = table.join(roots(table.where("form is not null")).hint("merge"), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
