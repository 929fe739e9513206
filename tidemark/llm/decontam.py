"""Benchmark passages in documents, by a prefix-filtered set join in plain DataFrame terms.

An item's windows are its runs of ``window`` words (or the whole item, if shorter). Tokens
are shingles of three words (fewer in shorter windows), ordered by how often they occur in
all documents. A window that occurs in a document brings all its tokens there, so for exact
containment its prefix is one token, the rarest: documents are joined on that alone. The
token's place in the window then fixes where the window would start; it must fit into the
document (length and position bounds), and the words there must equal the window's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

WINDOW = 13
SHINGLE = 3
#: Up to so many windows are broadcast (about 200 bytes each); more are joined by shuffle.
BROADCAST_WINDOWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """ASCII digits, ASCII letters in lower case and everything beyond ASCII form words; null has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, NOT_WORD), "")


def _token(of: Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(of, at + i) for i in range(k)])


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id``, ``w`` (words), ``wid`` of every distinct window of every item."""
    split = items.select("item_id", words(F.col("text")).alias("ws"))
    n = F.size("ws")
    runs = F.when(n >= window, F.transform(F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1))), lambda i: F.slice("ws", i, window))).otherwise(F.array("ws"))
    found = split.where(n > 0).select("item_id", F.explode(runs).alias("w"))
    return found.withColumn("wid", F.md5(F.concat_ws(" ", "w"))).distinct()


def _occurrences(docs: DataFrame, sizes: list[int], table: DataFrame, small: bool) -> DataFrame:
    """Joins every token of every document with ``table`` on ``h``; keeps the document's words only if ``small``."""
    split = docs.select("doc_id", "row_key", words(F.col("text")).alias("ws"))
    out = None
    for k in sizes:
        n = F.size("ws")
        each = split.where(n >= k).select("*", F.explode(F.sequence(F.lit(0), n - k)).alias("pos"))
        each = each.select("doc_id", "row_key", "ws", "pos", _token(F.col("ws"), F.col("pos"), k).alias("h"))
        if not small:
            each = each.select("doc_id", "row_key", F.size("ws").alias("n_words"), "pos", "h")
        part = each.join(F.broadcast(table) if small else table, "h")
        out = part if out is None else out.unionByName(part)
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """Occurrences (``doc_id``, ``row_key``, ``wid``, ``start``, ``len``) and the windows table.

    Rows of ``docs`` that agree in doc_id and text share a key and their occurrences.
    """
    docs = _keyed(docs)
    windows = materialize(item_windows(items, window), "windows")
    distinct = windows.select("wid", "w").distinct()
    sizes = [r["k"] for r in distinct.select(F.least(F.size("w"), F.lit(SHINGLE)).alias("k")).distinct().collect()]  # at most SHINGLE values
    small = distinct.count() <= broadcast_windows
    if not sizes:
        empty = docs.select("doc_id", "row_key", F.lit("").alias("wid"), F.lit(0).alias("start"), F.lit(0).alias("len"))
        return empty.where(F.lit(False)), windows
    tokens = None
    for k in sizes:
        own = distinct.where(F.least(F.size("w"), F.lit(SHINGLE)) == k)
        own = own.select("wid", "w", F.explode(F.sequence(F.lit(0), F.size("w") - k)).alias("offset"))
        own = own.select("wid", "offset", _token(F.col("w"), F.col("offset"), k).alias("h"))
        tokens = own if tokens is None else tokens.unionByName(own)
    rarity = _occurrences(docs, sizes, tokens.select("h").distinct(), small).groupBy("h").agg(F.count("*").alias("n"))
    # A token that no document has rules its window out, so an inner join is enough only after the minimum.
    rarest = tokens.join(rarity, "h", "left").groupBy("wid").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "offset")).alias("t"))
    prefix = rarest.where("t.n > 0").select("wid", "t.h", "t.offset").join(distinct, "wid")
    prefix = materialize(prefix.select("h", "offset", "wid", "w", F.size("w").alias("len")), "prefix")
    start = F.col("pos") - F.col("offset")
    if small:
        found = _occurrences(docs, sizes, prefix, True).where((start >= 0) & (start + F.col("len") <= F.size("ws")))
        found = found.where(F.slice("ws", start + 1, F.col("len")) == F.col("w"))
        return found.select("doc_id", "row_key", "wid", start.alias("start"), "len"), windows
    found = _occurrences(docs, sizes, prefix.drop("w"), False).where((start >= 0) & (start + F.col("len") <= F.col("n_words")))
    found = found.select("row_key", "wid", start.alias("start"), "len").distinct()
    split = docs.dropDuplicates(["row_key"]).select("doc_id", "row_key", words(F.col("text")).alias("ws"))
    check = found.join(prefix.select("wid", "w"), "wid").join(split, "row_key").where(F.slice("ws", F.col("start") + 1, F.col("len")) == F.col("w"))
    return check.select("doc_id", "row_key", "wid", "start", "len"), windows


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS, share: int = 20) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``row_key``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    A word in any occurrence of a window is hit; a row is contaminated if one word in
    ``share`` is. Null texts and items without words match nothing. Repeated rows stay.
    """
    from pyspark.sql import Window

    found, windows = hits(docs, items, window, broadcast_windows)
    found = materialize(found.distinct(), "hits")
    # Occurrences of one document, in order: each adds what lies beyond the end of those before.
    spans = found.groupBy("row_key", "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    before = F.max("end").over(Window.partitionBy("row_key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    covered = spans.withColumn("before", F.coalesce(before, F.lit(0))).select("row_key", F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before")).alias("more"))
    n_hit = covered.groupBy("row_key").agg(F.sum("more").alias("n_hit"))
    names = found.select("row_key", "wid").distinct().join(windows.select("wid", "item_id"), "wid")
    names = names.select("row_key", F.col("item_id").cast("string").alias("item")).distinct()
    names = names.groupBy("row_key").agg(F.count("item").alias("n_items"), F.concat_ws(",", F.sort_array(F.collect_list("item"))).alias("items"))
    rows = _keyed(docs).select("doc_id", "row_key", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    out = rows.join(n_hit.join(names, "row_key"), "row_key", "left")
    n = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id", "row_key", "n_words", n.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        ((n > 0) & (share * n >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without its contaminated rows."""
    bad = contamination(docs, items, **options).where("contaminated").select("row_key").distinct()
    key = F.xxhash64("doc_id", "text")
    return docs.withColumn("__key", key).join(bad.withColumnRenamed("row_key", "__key"), "__key", "left_anti").select(*docs.columns)
