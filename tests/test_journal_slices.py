"""Journals chained slice by slice are the journals chained in one piece."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from queries.sources import journal_entries
from tests.helpers import rows
from tidemark.operators import journal

OPTIONS = {"order_by": ["at", "order_id"], "details": ["order_id", "priority"], "host": "spark", "pid": 1}


def _entries(spark, sf):
    return journal_entries(spark, sf).where("journal_id <= 40").withColumn("journal_id", F.col("outcome"))


def test_no_task_holds_a_whole_journal(spark, sf, monkeypatch, tmp_path):
    entries = _entries(spark, sf)
    whole = rows(journal.append(entries, **OPTIONS), "journal_id", "seq")
    last = {}
    for id_, seq, line in whole:
        assert f'"previous_hash":"{last.get(id_, "0" * 64)}"' in line
        last[id_] = hashlib.sha256(line.encode()).hexdigest()

    held, dealt = 40, journal._chained
    assert len(whole) > 4 * held

    def checked(slices, *rest):
        assert slices.groupBy("_part").count().agg(F.max("count")).first()[0] < 3 * held
        return dealt(slices, *rest)

    monkeypatch.setattr(journal, "_chained", checked)
    monkeypatch.setattr(journal, "SLICE_ROWS", held)
    cut = journal.append(entries, **OPTIONS)
    assert rows(cut, "journal_id", "seq") == whole

    journal.write_journal_files(cut, f"{tmp_path}/files")
    back = journal.read_journal_files(spark, f"{tmp_path}/files", folders=True)
    back = back.withColumn("journal_id", F.regexp_extract("journal_id", "journal_id=([^/]*)/", 1))
    assert rows(back, "journal_id", "seq") == whole


def test_slices_after_known_heads(spark, sf, monkeypatch):
    entries = _entries(spark, sf)
    cut = F.col("at") < F.lit("1996-01-01").cast("timestamp_ntz")
    first = journal.append(entries.where(cut), **OPTIONS)
    heads = first.groupBy("journal_id").agg(F.max_by(F.struct("seq", "line"), "seq").alias("h")).select("journal_id", "h.*")
    want = rows(journal.append(entries, **OPTIONS), "journal_id", "seq")
    monkeypatch.setattr(journal, "SLICE_ROWS", 7)
    more = journal.append(entries.where(~cut), heads=heads, **OPTIONS)
    assert rows(first.unionByName(more), "journal_id", "seq") == want
