"""The network's rounds read their own slice, and ranks are looked up without Python workers."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import secrets
from tidemark.operators.ordered import rows_at_ranks


def test_each_round_reads_its_slice_alone(spark):
    rows = spark.range(4000).select((F.col("id") % 3 == 0).alias("label"), F.abs(F.xxhash64("id")).alias("rank"), F.encode(F.col("id").cast("string"), "utf-8").alias("codes"))
    dealt = secrets._dealt(rows, 4, 120)
    want = rows.selectExpr("label", "rank", "codes", "rank div 16 % 120 part", "int(rank % 4 = 0) held", "rank div 4 % 4 slice")
    assert dealt.columns == want.columns and dealt.exceptAll(want).isEmpty() and want.exceptAll(dealt).isEmpty()
    own = dealt.where("held = 0").where(F.col("slice") == 2)
    assert 0 < len(own.inputFiles()) and own.count() == want.where("held = 0 and slice = 2").count()
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(held" in plan and "PushedFilters: []" in plan and "Filter (" not in plan


def test_ranks_need_no_python_worker(spark, monkeypatch):
    made, create = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **b: made.append(type(data)) or create(self, data, *a, **b))
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    assert rows_at_ranks(df, {"v": "v"}, ["v"], lambda n: [1, 700])["v"][700][0] == 699.0
    assert made == [pa.Table]


def test_many_windows_get_as_many_passes_and_made_up_tokens_as_few(spark, monkeypatch):
    rows = [(i, f'token = "{i:032x}" and order-{i * 7919:08d}-shipped') for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    taught, made = Counter(), []
    monkeypatch.setattr(secrets, "PASSES_FOR", 1)
    monkeypatch.setattr(secrets, "_round", lambda rows, model, share, n, *more: (taught.update(r["rank"] for r in rows.collect()), made.append(n)))
    monkeypatch.setattr(secrets, "_calibrate", lambda rows, model, recall, n, *more: made.append(n))
    secrets.fit(df, epochs=4)
    want = {r["rank"] for r in secrets.labelled_rows(df).collect() if r["rank"] % secrets.HELD_OF}
    assert set(taught) == want and set(taught.values()) == {4}
    assert set(made) == {secrets.MADE}


def test_the_pipeline_learns_from_all_windows_in_all_passes(spark, monkeypatch):
    rows = [(i, f'token = "{i:032x}" and order-{i * 7919:08d}-shipped') for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    taught, made = Counter(), []
    monkeypatch.setattr(secrets, "PASSES_FOR", 1)
    monkeypatch.setattr(secrets, "_round", lambda rows, model, share, n, *more: (taught.update(r["rank"] for r in rows.collect()), made.append(n)))
    monkeypatch.setattr(secrets, "_calibrate", lambda *more: None)
    corpus_pipeline.secret_scan(spark, df, "")
    want = {r["rank"] for r in secrets.labelled_rows(df).collect() if r["rank"] % secrets.HELD_OF}
    assert set(taught) == want and set(taught.values()) == {10} and set(made) == {secrets.MADE}
