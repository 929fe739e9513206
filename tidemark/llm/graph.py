"""Connected components over an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node per node.

    ``edges`` has long columns ``u`` and ``v``; direction, repeats, loops and nulls do not
    matter. Returns ``node``, ``root`` for every node that has a root other than itself.
    Each round (large star, small star) is written to the shared scratch folder, so lineage
    stays short; the number of rounds grows with the logarithm of the longest path.
    """
    u, v = F.col("u"), F.col("v")
    current = materialize(
        edges.where(u != v)
        .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .distinct(),
        "edges",
    )
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.explode(F.array(F.struct(u.alias("u"), F.col("m").alias("v")), F.struct(v.alias("u"), F.col("m").alias("v"))))
        small = large.join(least, "u").select(pairs.alias("p")).select("p.u", "p.v").where(u != v)
        current = materialize(small.distinct(), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    return current.select(u.alias("node"), v.alias("root"))
