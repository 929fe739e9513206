"""Near duplicates by SimHash, found through anchor points of a covering code.

A fingerprint is cut into bands. Two fingerprints within ``threshold`` bits differ in at
most ``threshold // bands`` bits of some band. In each band the anchors are the words of a
covering code: a Hamming code on the low 15 bits, all values on the rest, so every value
has an anchor (its home) within one bit. If two values differ in at most ``r`` bits, the
home of one lies within ``1 + r`` bits of the other; every fingerprint is copied to all
anchors that near, and homes are compared with copies per anchor. Nothing is missed.

Exact copies meet as one fingerprint before anything is copied. An anchor with more than
``tile_rows`` copies is cut into tiles of about that many rows, each pair of slots meeting
in one tile. A tile gives a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.session import materialize

BITS = 64
CODE_BITS = 15
SEED = 42


def fingerprint(text: str | None, shingle: int = 4, seed: int = SEED) -> int:
    """SimHash of word shingles; zero for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    first, last = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(first), 65536):
        part = [digest(joined[a:b], seed) for a, b in zip(first[at : at + 65536], last[at : at + 65536])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``fp``, the fingerprint as a signed long, of each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = np.array([fingerprint(t, shingle) for t in pdf.pop("text")], np.uint64)
            yield pdf.assign(fp=out.view(np.int64))

    narrow = docs.select(*keep, "text")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.drop("text").schema)
    return narrow.mapInPandas(run, f"{kept}, fp long")


def _syndromes() -> np.ndarray:
    values = np.arange(1 << CODE_BITS)
    out = np.zeros(len(values), np.int64)
    for i in range(CODE_BITS):
        out ^= np.where(values >> i & 1, i + 1, 0)
    return out


def _flips(width: int, radius: int) -> list[np.ndarray]:
    """By syndrome: what leads from a value to each anchor within ``radius``, its home first."""
    syndrome, found = _syndromes(), [[] for _ in range(CODE_BITS + 1)]
    for weight in range(radius + 1):
        for places in combinations(range(width), weight):
            flip = sum(1 << p for p in places)
            found[syndrome[flip & ((1 << CODE_BITS) - 1)]].append(flip)
    for s, flips in enumerate(found[1:], 1):  # the home differs in the one bit that the syndrome names
        home = 1 << (s - 1)
        flips.remove(home)
        flips.insert(0, home)
    return [np.array(x, np.int64) for x in found]


def _bands(bands: int) -> list[tuple[int, int]]:
    edges = [BITS * i // bands for i in range(bands + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def anchor_entries(fps: DataFrame, threshold: int, bands: int = 3) -> DataFrame:
    """``anchor``, ``fp``, ``role`` (1: a copy, 3: a copy at its home) of each distinct ``fp``."""
    plan = _bands(bands)
    if min(w for _, w in plan) < CODE_BITS:
        raise ValueError(f"a band needs {CODE_BITS} bits; {bands} bands are too many")
    flips = {w: _flips(w, 1 + threshold // bands) for _, w in plan}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        syndrome = _syndromes()
        for pdf in batches:
            for low in range(0, len(pdf), 20_000):
                fp = pdf["fp"].to_numpy()[low : low + 20_000].view(np.uint64)
                for band, (shift, width) in enumerate(plan):
                    value = (fp >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64)
                    found = syndrome[value & ((1 << CODE_BITS) - 1)]
                    for s, steps in enumerate(flips[width]):
                        own = np.flatnonzero(found == s)
                        if len(own):
                            anchors = (value[own, None] ^ steps) | band << 40
                            role = np.ones(anchors.shape, np.int8)
                            role[:, 0] = 3
                            yield pd.DataFrame({"anchor": anchors.ravel(), "fp": np.repeat(fp[own].view(np.int64), len(steps)), "role": role.ravel()})

    return fps.select("fp").mapInPandas(run, "anchor long, fp long, role byte")


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the classes of linked rows; ``label`` points at each class's first row."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _forest(key: np.ndarray, fp: np.ndarray, role: np.ndarray, threshold: int, pairs: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest per key; homes are compared with copies, ``pairs`` at a time."""
    begin = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
    size = np.diff(np.append(begin, len(fp)))
    group = np.repeat(np.arange(len(begin)), size)
    homes = np.flatnonzero(role & 2)
    homes = homes[size[group[homes]] > 1]
    many = size[group[homes]]
    label, upto = np.arange(len(fp)), np.cumsum(many)
    at = 0
    while at < len(homes):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + pairs, "right")))
        own, n = homes[at:end], many[at:end]
        left = np.repeat(own, n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[group[own]], n)
        near = (np.bitwise_count(fp[left] ^ fp[right]) <= threshold) & (role[right] & 1 > 0) & (left != right)
        _merge(label, left[near], right[near])
        at = end
    u, v = fp.view(np.int64), fp[label].view(np.int64)
    return u[u != v], v[u != v]


def links(fps: DataFrame, threshold: int = 4, bands: int = 3, tile_rows: int = 4096) -> DataFrame:
    """Edges ``u``, ``v`` that join the same fingerprints as all pairs within ``threshold`` bits do."""
    entries = anchor_entries(fps, threshold, bands)
    # One row per crowded anchor: with three bands at most 2**19 anchors exist, whatever the data.
    crowded = (
        entries.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > tile_rows)
        .select("anchor", F.ceil(F.col("n") / tile_rows).cast("int").alias("tiles"))
    )
    crowded = F.broadcast(crowded) if sum(1 << (w - 4) for _, w in _bands(bands)) <= 1 << 20 else crowded
    slot = F.expr("cast(pmod(xxhash64(fp), tiles) as int)")
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    one = lambda tile, role: F.struct(tile.alias("tile"), role.cast("byte").alias("role"))
    spread = F.when(F.col("tiles").isNull(), F.array(one(F.lit(0), F.col("role")))).otherwise(
        F.concat(
            F.transform(every, lambda i: one(i * F.col("tiles") + slot, F.lit(1))),
            F.when(F.col("role") == 3, F.transform(every, lambda i: one(slot * F.col("tiles") + i, F.lit(2)))).otherwise(F.array().cast("array<struct<tile:int,role:tinyint>>")),
        )
    )
    tiles = (
        entries.join(crowded, "anchor", "left")
        .select("anchor", "fp", F.explode(spread).alias("t"))
        .select("anchor", "t.tile", "fp", "t.role")
        .repartition("anchor", "tile").sortWithinPartitions("anchor", "tile")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out(pdf):
            u, v = _forest(pdf[["anchor", "tile"]].to_numpy(), pdf["fp"].to_numpy().view(np.uint64), pdf["role"].to_numpy(), threshold)
            return pd.DataFrame({"u": u, "v": v}).drop_duplicates()

        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if pdf.empty:
                continue
            key = pdf[["anchor", "tile"]].to_numpy()
            cut = len(pdf) - int(np.argmax((key[::-1] != key[-1]).any(axis=1))) if (key != key[-1]).any() else 0
            if cut:
                yield out(pdf.iloc[:cut])
            rest = pdf.iloc[cut:]
        if rest is not None and len(rest):
            yield out(rest.reset_index(drop=True))

    return tiles.mapInPandas(run, "u long, v long")


def near_duplicates(docs: DataFrame, threshold: int = 4, shingle: int = 4, bands: int = 3, tile_rows: int = 4096) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` of each row.

    Words are cut at ASCII white space after lower-casing A-Z. A null, empty or wordless
    text has fingerprint zero and is linked like any other. Repeated rows stay; a class
    whose doc_ids are all null has a null component_id. Other columns are ignored.
    """
    fps = materialize(fingerprints(docs, shingle), "simhash")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(classes, threshold, bands, tile_rows)).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    component = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.select("fp", "root").join(component, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
