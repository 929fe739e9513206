"""Exact order statistics of many columns at once, without sorting or moving their values.

A double is read as a whole number that keeps the order (``order_code``). The values of a column
are counted in cells of equal code width, several thousand in the first pass. Only cells that
can still change the answer are cut finer in the next pass:

* a cell that holds a wanted rank and more than one distinct value;
* for the largest gap between two distribution functions, a cell in which the gap could exceed the
  best one found at a cell's end. Inside a cell it moves by the cell's two shares at most.

All columns share the passes. A pass exchanges one row per task and cell, and nothing is written; the driver
sees at most some thousand counts a column. A value shared by very many rows is one cell that is
done. Codes have 64 bits and a pass settles at least eight of them for a rank, so there are
few passes whatever the distribution.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells of a column in the first pass, and about how many its open cells are cut into later, as powers of two.
FIRST_BITS, LATER_BITS = 12, 14


def order_code(x: Column) -> Column:
    """A long that rises with the double: the bits of its magnitude, negated below zero; null for NaN."""
    a = F.abs(x)
    two = F.lit(2.0)
    guess = F.floor(F.log2(a)).cast("int")
    power = F.pow(two, guess.cast("double"))
    # The logarithm may be off by one next to a power of two.
    exponent = F.greatest(F.when(a < power, guess - 1).when(a / power >= 2, guess + 1).otherwise(guess), F.lit(-1022))
    mantissa = (a / F.pow(two, exponent.cast("double")) * F.lit(2.0**52)).cast("bigint")
    bits = F.shiftleft((exponent + 1022).cast("bigint"), 52) + mantissa
    whole = F.when(a == 0, F.lit(0).cast("bigint")).when(a == float("inf"), F.lit(2047 << 52).cast("bigint")).otherwise(bits)
    return F.when(~F.isnan(x), F.when(x < 0, -whole).otherwise(whole))


def code_of(x: float) -> int:
    """``order_code`` of a number on the driver."""
    bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -bits if x < 0 else bits


@contextmanager
def two_sides(reference: DataFrame, current: DataFrame | None, features: Sequence[str]) -> Iterator[DataFrame]:
    """(``side``, ``i``, ``x``, ``code``): one row for each value of both slices, ``i`` the place of the feature in the list.

    The executors keep it, on disk where memory ends, while several passes read it. What does not parse as a
    number, and NaN, is null.
    """

    def long(df: DataFrame, side: int) -> DataFrame:
        pairs = [F.struct(F.lit(i).alias("i"), F.col(f).try_cast("double").alias("x")) for i, f in enumerate(features)]
        return df.select(F.lit(side).alias("side"), F.inline(F.array(*pairs)))

    if not features:
        raise ValueError("no feature to look at")
    table = long(reference, 0) if current is None else long(reference, 0).unionAll(long(current, 1))
    x = F.col("x")
    table = table.withColumn("x", F.when(~F.isnan(x), x)).withColumn("code", order_code(x)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield table
    finally:
        table.unpersist()


@dataclass
class Profile:
    """What is known of a column: per side the rows of the slice, values, and their mean; and the extremes."""

    feature: str
    slice_rows: tuple[int, int] = (0, 0)
    rows: tuple[int, int] = (0, 0)
    mean: tuple[float | None, float | None] = (None, None)
    low: float | None = None
    high: float | None = None
    #: Value at each wanted 0-based rank of the reference.
    at_rank: dict[int, float] = field(default_factory=dict)
    #: Largest gap between the two distribution functions.
    distance: float = 0.0

    def quantile(self, level: float) -> float:
        """Interpolated linearly between the two ranks that ``ranks_of`` names."""
        place = (self.rows[0] - 1) * level
        low, high = self.at_rank[math.floor(place)], self.at_rank[math.ceil(place)]
        return low + (high - low) * (place - math.floor(place))


def ranks_of(n: int, levels: Sequence[float]) -> set[int]:
    """The 0-based ranks that linearly interpolated quantiles of n values need."""
    return {f((n - 1) * q) for q in levels for f in (math.floor, math.ceil)} if n else set()


@dataclass
class _Search:
    profile: Profile
    wanted: set[int]
    with_distance: bool
    shift: int
    before_shift: int = 0
    #: Open cells of the last pass, with the counts of both sides below them; none before the first pass.
    open: dict[int, tuple[int, int]] | None = None

    def gap(self, r: float, c: float) -> float:
        n, m = self.profile.rows
        return r / n - c / m

    def take(self, cells: list[tuple[int, int, int, float, float]]) -> None:
        """Counts of the cells in order: (cell, reference, current, least, largest)."""
        both = self.with_distance and all(self.profile.rows)
        below: list[tuple[int, int]] = []
        parent, r, c = None, 0, 0
        for cell, n, m, _, _ in cells:
            if self.open is not None and cell >> (self.before_shift - self.shift) != parent:
                parent = cell >> (self.before_shift - self.shift)
                r, c = self.open[parent]
            below.append((r, c))
            r, c = r + n, c + m
            if both:
                self.profile.distance = max(self.profile.distance, abs(self.gap(r, c)))
        now: dict[int, tuple[int, int]] = {}
        for (cell, n, m, least, largest), (r, c) in zip(cells, below):
            held = [x for x in self.wanted if r <= x < r + n]
            if least == largest:
                self.profile.at_rank.update(dict.fromkeys(held, least))
                self.wanted.difference_update(held)
            elif held or (both and max(abs(self.gap(r + n, c)), abs(self.gap(r, c + m))) > self.profile.distance):
                now[cell] = (r, c)
        self.open, self.before_shift = now, self.shift
        finer = max(8, LATER_BITS - max(1, len(now)).bit_length()) if len(now) < 64 else max(1, LATER_BITS - len(now).bit_length())
        self.shift = max(0, self.shift - finer)


def _described(table: DataFrame, features: Sequence[str]) -> list[Profile]:
    x = F.col("x")
    rows = (
        table.groupBy("i", "side")
        .agg(F.count(F.lit(1)).alias("rows"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.min(x).alias("low"), F.max(x).alias("high"))
        .collect()
    )
    out = [Profile(f) for f in features]
    for i, f in enumerate(features):
        two = [next((r for r in rows if r.i == i and r.side == s), None) for s in (0, 1)]
        known = [r for r in two if r is not None and r.n]
        out[i] = Profile(
            f,
            tuple(r["rows"] if r is not None else 0 for r in two),
            tuple(r.n if r is not None else 0 for r in two),
            tuple(r["mean"] if r is not None else None for r in two),
            min((r.low for r in known), default=None),
            max((r.high for r in known), default=None),
        )
    return out


def profiles(
    table: DataFrame, features: Sequence[str], ranks: Callable[[int], set[int]] = lambda n: set(), with_distance: bool = False
) -> list[Profile]:
    """Profiles of the columns of a frame made by ``two_sides``.

    ``ranks(n)`` names the wanted 0-based ranks among the n values of the reference.
    """
    made = _described(table, features)
    searches: dict[int, _Search] = {}
    for i, p in enumerate(made):
        wanted = ranks(p.rows[0])
        if p.low is None or not (wanted or (with_distance and all(p.rows))):
            continue
        if p.low == p.high:
            p.at_rank = dict.fromkeys(wanted, p.low)
            continue
        width = (code_of(p.high) - code_of(p.low)).bit_length()
        searches[i] = _Search(p, set(wanted), with_distance, max(0, width - FIRST_BITS))
    first = True
    while searches:
        cells = _counted(table, searches, first)
        for i, search in searches.items():
            search.take(cells.get(i, []))
        searches = {i: s for i, s in searches.items() if s.open}
        first = False
    return made


def _signed(x: int) -> int:
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


def _counted(table: DataFrame, searches: dict[int, _Search], first: bool) -> dict[int, list[tuple]]:
    """The counts of one pass: cells of every column that is still searched, in order."""
    by = F.element_at(F.create_map(*[F.lit(x) for i, s in searches.items() for x in (i, s.shift)]), F.col("i"))
    rows = table.where(F.col("code").isNotNull() & F.col("i").isin(*searches)).withColumn("cell", F.call_function("shiftright", "code", by))
    if not first:  # at most some thousand cells a column are open
        bits = max(searches).bit_length()
        over = F.element_at(F.create_map(*[F.lit(x) for i, s in searches.items() for x in (i, s.before_shift)]), F.col("i"))
        # One 64-bit key; where two cells meet on one, the driver leaves out the closed one.
        rows = rows.withColumn("key", F.shiftleft(F.call_function("shiftright", "code", over), bits).bitwiseOR(F.col("i").cast("bigint")))
        opened = [_signed((cell << bits) | i) for i, s in searches.items() for cell in s.open]
        rows = rows.join(F.broadcast(table.sparkSession.createDataFrame(pa.table({"key": pa.array(opened, pa.int64())}))), "key", "left_semi")
    ours = F.when(F.col("side") == 0, 1).otherwise(0)
    counted = rows.groupBy("i", "cell").agg(
        F.sum(ours).alias("n"), F.sum(1 - ours).alias("m"), F.min("x").alias("least"), F.max("x").alias("largest")
    )
    out: dict[int, list[tuple]] = {}
    for i, cell, *rest in sorted(map(tuple, counted.collect())):
        search = searches[i]
        if first or cell >> (search.before_shift - search.shift) in search.open:
            out.setdefault(i, []).append((cell, *rest))
    return out
