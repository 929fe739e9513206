"""Language of a text by the nearest of several centroids per language.

A text becomes counts of hashed 1- to 3-grams of its lower-cased letters (anything else is
a gap), damped by a logarithm, weighted by inverse document frequency and scaled to unit
length. Document frequencies cover every learning row. Each language's centroids come from
spherical k-means over a sample of its learning rows (``sample_rows`` expected a language,
chosen by hash, at least one). Of equal cosines the first language by name counts. The prediction is the language of the centroid with the largest cosine; a
text farther from all centroids than the learnt radius is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.workers import frugal

DIM_BITS = 12
DIM = 1 << DIM_BITS
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_ALPHA: list[np.ndarray] = []


def _alpha() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.array([chr(i).isalpha() for i in range(1 << 16)] + [True]))
    return _ALPHA[0]


def counts(text: str | None) -> np.ndarray:
    """Occurrences of each hashed n-gram of a whole text."""
    code = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(_alpha()[np.minimum(code, 1 << 16)], code, np.uint32(32))
    code = code[~((code == 32) & np.concatenate(([False], code[:-1] == 32)))]
    out, shift = np.zeros(DIM, np.int64), np.uint32(32 - DIM_BITS)
    for low in range(0, len(code), 1 << 20):  # two characters of the next part complete the last n-grams
        part = code[low : low + (1 << 20) + 2]
        own = min(len(part), 1 << 20)
        hashed = part * _MIX[0]
        for n in (1, 2, 3):
            if n > 1:
                hashed = (hashed[: len(part) - n + 1] ^ (hashed[: len(part) - n + 1] >> np.uint32(15))) * _MIX[n - 1] + part[n - 1 :] * _MIX[0]
            out += np.bincount((hashed[:own] * _MIX[2]) >> shift, minlength=DIM)
    return out


def vectors(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    out = np.stack([np.log1p(counts(t)).astype(np.float32) for t in texts]) * idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def clusters(unit: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the mean and then the farthest rows."""
    centre = unit.mean(axis=0, keepdims=True)
    while len(centre) < min(k, len(unit)):
        centre = np.vstack([centre, unit[[(unit @ centre.T).max(axis=1).argmin()]]])
    for _ in range(rounds):
        centre = centre / np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
        own = (unit @ centre.T).argmax(axis=1)
        centre = np.stack([unit[own == i].mean(axis=0) if (own == i).any() else centre[i] for i in range(len(centre))])
    return centre / np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)


@dataclass
class CentroidModel:
    """Centroids (one row each), the language of each, weights, and the least accepted cosine."""

    languages: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    floor: float

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        best = np.zeros(len(texts))
        names = np.full(len(texts), UNKNOWN, object)
        own = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)]
        for low in range(0, len(own) if self.languages else 0, 64):
            rows = own[low : low + 64]
            cosine = vectors([texts[i] for i in rows], self.idf) @ self.centroids.T
            best[rows] = np.clip(cosine.max(axis=1), 0, 1)
            names[rows] = np.array(self.languages, object)[cosine.argmax(axis=1)]
        return pd.DataFrame({"lang_pred": names, "score": best, "rejected": (best < self.floor) | (names == UNKNOWN)})


def fit(rows: DataFrame, centroids: int = 4, sample_rows: int = 400, slack: float = 0.5) -> CentroidModel:
    """A model of rows with ``doc_id``, ``text`` and ``lang``; rows without lang or text are left out.

    ``sample_rows`` bounds, in expectation, the rows of a language that are clustered. A row is
    drawn by its hash, and a language's row of the least hash always is, so that none is left
    out. Repeated rows are drawn once. Languages are taken to be few: the model holds them all.
    The floor is ``slack`` times the least cosine of a sampled row.
    """
    rows = rows.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    mark = F.xxhash64("doc_id", "text")
    known = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(mark).alias("least")).collect()
    per_lang, least = {r["lang"]: r["n"] for r in known}, {r["lang"]: r["least"] for r in known}
    if not per_lang:
        return CentroidModel([], np.zeros((0, DIM), np.float32), np.ones(DIM, np.float32), 0.0)

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(DIM, np.int64)
        for pdf in batches:
            for text in pdf["text"]:
                total += counts(text) > 0
        yield pd.DataFrame({"bucket": np.arange(DIM), "n": total})

    frequency = np.zeros(DIM)
    found = rows.select("text").mapInPandas(frugal(seen), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in found.collect():  # DIM rows
        frequency[bucket] = n
    idf = np.log((1 + sum(per_lang.values())) / (1 + frequency)).astype(np.float32) + np.float32(0.05)

    rate = F.create_map(*[F.lit(x) for lang, n in per_lang.items() for x in (lang, min(1.0, sample_rows / n))])
    first = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])
    drawn = (F.pmod(mark, F.lit(1_000_003)) / 1_000_003 < rate[F.col("lang")]) | (mark == first[F.col("lang")])

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        unit = vectors(pdf.sort_values(["doc_id", "text"])["text"].tolist(), idf)
        centre = clusters(unit, centroids)
        least = float((unit @ centre.T).max(axis=1).min())
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "k": range(len(centre)), "centre": list(centre), "least": least})

    sampled = rows.where(drawn).distinct().groupBy("lang").applyInPandas(cluster, "lang string, k int, centre array<float>, least double")
    made = sorted(sampled.collect(), key=lambda r: (r["lang"], r["k"]))  # a few rows a language
    return CentroidModel([r["lang"] for r in made], np.array([r["centre"] for r in made], np.float32), idf, slack * min(r["least"] for r in made))


def predict(docs: DataFrame, model: CentroidModel) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine), ``rejected``, which replace columns of these names.

    A null text or one without a letter is ``und`` with score 0 and rejected. Rows keep their
    place: nothing is shuffled.
    """
    added = ("lang_pred", "score", "rejected")
    docs = docs.drop(*added)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = model.predict(pdf["text"].tolist())
            yield pdf.assign(**{c: found[c].to_numpy() for c in added})

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return docs.mapInPandas(frugal(run), schema)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the rows that is never learnt from; a null doc_id is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit_documents(docs: DataFrame, **options) -> CentroidModel:
    """The model of the rows that are not held out."""
    return fit(docs.where(~held_out(F.col("doc_id"))), **options)
