"""Hash-chained processing journals: writing, reading, verifying."""

from __future__ import annotations

import hashlib
import os
import socket
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tidemark.operators.privacy import PersonalDataInJournalError, checked_text, forbidden_schema_keys
from tidemark.schemas import JOURNAL_ENTRY, JOURNAL_SEED
from tidemark.session import materialize, scratch_path

#: Entries that a task sorts and chains at a time.
SLICE_ROWS = 1_000_000
_FOLDED = ["_part", "journal_id", "seq", "line", "state"]


def append(
    entries: DataFrame,
    order_by: Sequence[str],
    fields: Sequence[str] = ("timestamp", "event", "purpose", "outcome"),
    details: Sequence[str] = (),
    heads: DataFrame | None = None,
    host: str | None = None,
    pid: int | None = None,
) -> DataFrame:
    """Chain a batch of entries to the end of their journals.

    Every line holds the SHA-256 of the line before it, so one journal can only
    be written in order. Spark builds all of a line but that digest and sorts the lines, in parallel, into
    slices of SLICE_ROWS; a small fold streams through each slice that puts the
    digests in and holds nothing but the last one. Only the rest of a journal waits for the slice before, so a
    long journal takes one round a slice and no task holds all of it. ``heads`` (journal_id, seq, line) gives the last
    line of journals that already exist.

    ``details`` may be of any type; a column of JSON text is written as text. A forbidden key among them, at
    any depth and inside JSON text too, refuses the batch. ``host`` and ``pid`` are those of the
    process that writes, unless given.
    """
    jid = dict(entries.dtypes)["journal_id"]
    extra = entries.select(*details)
    found = forbidden_schema_keys(extra.schema)
    if found:
        raise PersonalDataInJournalError(f"forbidden keys in details: {found}")
    payload = {d: checked_text(F.col(d)) if t == "string" else F.col(d) for d, t in extra.dtypes}
    written = {"ignoreNullFields": "false"}
    origin = [F.lit(host or socket.gethostname()).alias("host"), F.lit(os.getpid() if pid is None else pid).cast("bigint").alias("pid")]
    head = F.to_json(F.struct(*[F.col(f).cast("string").alias(f) for f in fields], *origin), written)
    values = [v.cast("string").alias(d) if not _is_nested(extra, d) else v.alias(d) for d, v in payload.items()]
    tail = F.to_json(F.struct(*values), written) if values else F.lit("{}")
    batch = entries.select(
        "journal_id",
        F.struct(*order_by).alias("_order"),
        F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"previous_hash":"')).alias("_head"),
        F.concat(F.lit('","details":'), tail, F.lit("}")).alias("_tail"),
        F.lit(None).cast("bigint").alias("_seq"),
    )
    if heads is not None:
        known = heads.select("journal_id", "seq", F.sha2("line", 256).alias("_digest"))
        last = known.join(entries.select("journal_id").distinct(), "journal_id", "left_semi")
        batch = batch.unionByName(last.select("journal_id", F.col("_digest").alias("_head"), F.col("seq").alias("_seq")), allowMissingColumns=True)

    journal_order = ["journal_id", F.col("_tail").isNotNull(), "_order"]
    parts = max(1, -(-batch.count() // SLICE_ROWS))
    dealt = batch.repartitionByRange(parts, *journal_order).withColumn("_part", F.spark_partition_id())
    return _chained(materialize(dealt, "journal-slices"), journal_order, jid, parts)


def _fold(carried: dict):
    """Puts the digests into the sorted lines of slices; ``carried`` is where a slice's first journal stands.

    After a slice's lines comes a row of state: its last journal, the number that is next, the last digest.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, journal, seq, digest, sha256 = None, None, 0, JOURNAL_SEED, hashlib.sha256
        for pdf in batches:
            at, ids, tails = pdf["_part"].tolist(), pdf["journal_id"].tolist(), pdf["_tail"].tolist()
            states, lines, seqs, kept = [], [], [], []
            for i, head in enumerate(pdf["_head"].tolist()):
                if at[i] != part:
                    if part is not None:
                        states.append((part, journal, seq, digest, True))
                    part = at[i]
                    journal, seq, digest = carried.get(part, (None, 0, JOURNAL_SEED))
                if ids[i] != journal:
                    journal, seq, digest = ids[i], 0, JOURNAL_SEED
                if tails[i] is None:  # the head of a journal that exists: its digest and number
                    seq, digest = int(pdf["_seq"].iloc[i]) + 1, head
                    continue
                line = f"{head}{digest}{tails[i]}"
                kept.append(i)
                seqs.append(seq)
                lines.append(line)
                seq, digest = seq + 1, sha256(line.encode()).hexdigest()
            yield pdf[["_part", "journal_id"]].iloc[kept].assign(seq=seqs, line=lines, state=False)
            yield pd.DataFrame(states, columns=_FOLDED)
        if part is not None:
            yield pd.DataFrame([(part, journal, seq, digest, True)], columns=_FOLDED)

    return run


def _chained(slices: DataFrame, journal_order: list, jid: str, parts: int) -> DataFrame:
    """Chain slices of the journals in rounds: first all journals from where they begin, then what the next slice holds of them, and so on."""
    spark, path = slices.sparkSession, scratch_path(slices.sparkSession, "journal-lines")
    schema = f"_part int, journal_id {jid}, seq bigint, line string, state boolean"
    ends = slices.groupBy("_part").agg(F.min(F.struct("journal_id")).alias("first"), F.max(F.struct("journal_id")).alias("last"))
    begun: dict = {}  # of a part whose first journal goes on from the part before: its round, that part, that journal
    before = None
    for end in ends.orderBy("_part").collect():
        if before is not None and before["last"] == end["first"]:
            alone = before["first"] == before["last"]  # else the journal begins there, in the first round
            round_ = begun[before["_part"]][0] + 1 if alone and before["_part"] in begun else 1
            begun[end["_part"]] = (round_, before["_part"], end["first"][0])
        before = end
    going_on = spark.createDataFrame([(part, journal, i) for part, (i, _, journal) in begun.items()], f"_part int, _first {jid}, _round int")
    marked = slices.join(F.broadcast(going_on), "_part", "left")
    marked = marked.withColumn("_round", F.when(F.col("journal_id").eqNullSafe(F.col("_first")) & F.col("_round").isNotNull(), F.col("_round")).otherwise(0))
    known: dict = {}
    for i in range(1 + max((r for r, _, _ in begun.values()), default=0)):
        own = [part for part, (r, _, _) in begun.items() if r == i]
        carried = {part: known[begun[part][1:]] for part in own}
        rows = marked.where(F.col("_part").isin(own)) if i else marked
        rows = rows.where(F.col("_round") == i).repartition(max(1, len(own)) if i else parts, "_part").sortWithinPartitions("_part", *journal_order)
        out = f"{path}/step={i}"
        rows.select("_part", "journal_id", "_head", "_tail", "_seq").mapInPandas(_fold(carried), schema).write.parquet(out)
        for r in spark.read.schema(schema).parquet(out).where("state").collect():
            known[r["_part"], r["journal_id"]] = (r["journal_id"], r["seq"], r["line"])
    lines = spark.read.schema(schema + ", step int").parquet(path)
    return lines.where("not state").select("journal_id", "seq", "line")


def _is_nested(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (ArrayType, MapType, StructType))


def verify(lines: DataFrame) -> DataFrame:
    """Per journal: number of entries, whether the chain holds, index of the first break.

    ``lines`` is (journal_id, seq, line); gaps in ``seq`` are breaks where lines
    were removed only if the digests say so. Checking needs no order of work:
    entries are renumbered and reduced to two digests, and each one meets its
    predecessor in an equi-join on (journal, number), which spreads even a single
    long journal evenly.
    """
    numbered = materialize(
        _renumber(lines).select(
            "journal_id",
            "n",
            F.get_json_object("line", "$.previous_hash").alias("claimed"),
            F.sha2("line", 256).alias("actual"),
        ),
        "journal-digests",
    )
    here = numbered.select("journal_id", "n", "claimed")
    there = numbered.select("journal_id", (F.col("n") + 1).alias("n"), "actual")
    checked = here.join(there, ["journal_id", "n"], "left")
    expected = F.when(F.col("n") == 0, JOURNAL_SEED).otherwise(F.col("actual"))
    broken = ~F.col("claimed").eqNullSafe(expected)
    return (
        checked.groupBy("journal_id")
        .agg(F.count(F.lit(1)).alias("entries"), F.min(F.when(broken, F.col("n"))).alias("first_break"))
        .select("journal_id", "entries", F.col("first_break").isNull().alias("intact"), "first_break")
    )


def _renumber(lines: DataFrame, slice_by=None) -> DataFrame:
    """Gapless numbers from 0 per journal, counted slice by slice."""
    by = F.floor(F.col("seq") / 100_000) if slice_by is None else slice_by
    sliced = lines.filter(F.length(F.trim("line")) > 0).withColumn("_slice", by)
    before = Window.partitionBy("journal_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("journal_id", "_slice")
        .agg(F.count(F.lit(1)).alias("_c"))
        .select("journal_id", "_slice", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    )
    inside = Window.partitionBy("journal_id", "_slice").orderBy("seq")
    return (
        sliced.withColumn("_r", F.row_number().over(inside))
        .join(offsets, ["journal_id", "_slice"])
        .select("journal_id", F.trim("line").alias("line"), (F.col("_r") - 1 + F.col("_o")).alias("n"))
    )


def read_entries(lines: DataFrame) -> DataFrame:
    """Parsed entries of journal lines; blank lines are skipped."""
    return (
        lines.filter(F.length(F.trim("line")) > 0)
        .withColumn("entry", F.from_json("line", JOURNAL_ENTRY))
        .select("journal_id", "seq", "entry.*")
    )


def write_journal_files(lines: DataFrame, path: str) -> None:
    """A folder ``journal_id=...`` of JSONL files for each journal; its lines go on from file to file in order of the names."""
    parts = max(1, -(-lines.count() // SLICE_ROWS))
    in_order = lines.select("journal_id", "seq", "line").repartitionByRange(parts, "journal_id", "seq").sortWithinPartitions("journal_id", "seq")
    in_order.select("journal_id", "line").write.partitionBy("journal_id").text(path)


def read_journal_files(spark: SparkSession, path: str, folders: bool = False) -> DataFrame:
    """Lines of JSONL journals as (journal_id, seq, line); each file is a journal, or with ``folders`` each folder.

    A file may be read as several splits. Inside a split the running id follows
    the lines, and splits are ordered by where they start in the file. The files of a folder
    follow each other by name.
    """
    file = F.col("_metadata.file_path")
    raw = spark.read.text(path).select(
        (F.regexp_replace(file, "[^/]*$", "") if folders else file).alias("journal_id"),
        F.struct(file.alias("file"), F.col("_metadata.file_block_start").alias("at")).alias("_start"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )
    return _renumber(raw, F.col("_start")).select("journal_id", F.col("n").alias("seq"), "line")
