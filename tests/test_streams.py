"""Streaming jobs: resumption, repeated batches, state tables, and agreement with the batch form."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from queries import common as c
from tests.helpers import at
from tidemark.operators.consent import apply_events
from tidemark.sources import star
from tidemark.streaming import jobs, runs

DATA = [(i, at(i / 4), i % 3, "purchase" if i % 2 else "view", 1.5, "{}") for i in range(80)]


@pytest.fixture
def parted(spark, tmp_path):
    """Events split by time over four files, read oldest first, one a micro-batch."""
    source = tmp_path / "in"
    source.mkdir()
    for part in range(4):
        spark.createDataFrame(DATA[part * 20 : part * 20 + 20], jobs.EVENTS).coalesce(1).write.parquet(str(tmp_path / f"p{part}"))
        for f in (tmp_path / f"p{part}").glob("part-*.parquet"):
            target = source / f"events-{part}.parquet"
            target.write_bytes(f.read_bytes())
            os.utime(target, (1_700_000_000 + part, 1_700_000_000 + part))
    return lambda: jobs.event_stream(spark, str(source), max_files=1)


def closed_days():
    mark = at(79 / 4) - dt.timedelta(days=1)
    want: dict = {}
    for _, ts, user, kind, *_ in DATA:
        day = ts.replace(hour=0, minute=0, second=0, microsecond=0)
        if day + dt.timedelta(days=1) <= mark:
            n, p = want.get((user, day), (0, 0))
            want[(user, day)] = (n + 1, p + (kind == "purchase"))
    return want


def days(df):
    rows = df.collect()
    assert len({(r.user_id, r.day) for r in rows}) == len(rows)
    return {(r.user_id, r.day): (r.events, r.purchases) for r in rows}


def stopped_after_a_batch(query):
    """Stops between two batches, as far as the polling allows; what is left is for the next run."""
    while query.isActive and not (query.lastProgress and query.lastProgress["batchId"] >= 0):
        time.sleep(0.02)
    query.stop()


def test_replayed_activity_counts_every_event(spark, sf):
    """Windows still open at the end of the table are emitted too."""
    from queries import streams

    events = star.table(spark, sf, "events")
    n, per_day = events.agg(F.count("*"), F.count_distinct(F.to_date("ts"))).first()
    daily = streams.stream_daily_activity(spark, sf)
    assert tuple(daily.agg(F.sum("events"), F.count_distinct("day")).first()) == (n, per_day)


def test_files_one_by_one_equal_one_batch(parted, tmp_path):
    assert days(runs.run_available(jobs.daily_activity(parted()), str(tmp_path / "job"))) == closed_days()


def test_activity_stopped_and_resumed(parted, tmp_path):
    folder = str(tmp_path / "job")
    stopped_after_a_batch(runs.start_appending(jobs.daily_activity(parted()), folder))
    resumed = runs.run_available(jobs.daily_activity(parted()), folder)
    assert days(resumed) == closed_days()
    assert days(runs.run_available(jobs.daily_activity(parted()), folder)) == closed_days()
    state = [f for _, _, files in os.walk(f"{folder}/checkpoint/state") for f in files]
    assert any(f.endswith((".zip", ".changelog")) for f in state)  # RocksDB, not the default store


def test_dedup_stopped_and_resumed(spark, parted, tmp_path):
    folder = str(tmp_path / "job")
    twice = lambda: jobs.dedup(parted().unionByName(parted()))
    stopped_after_a_batch(runs.start_appending(twice(), folder))
    out = runs.run_available(twice(), folder)
    assert sorted(r.event_id for r in out.collect()) == [r[0] for r in DATA]


def _as_consent(events):
    return jobs.consent_events(events.withColumn("event_type", F.when(F.col("event_type") == "view", "error").otherwise("signup")))


def test_consent_state_has_one_row_a_key(spark, parted, tmp_path):
    folder = str(tmp_path / "job")
    stopped_after_a_batch(jobs.consent_into(_as_consent(parted()), folder))
    runs.finish(jobs.consent_into(_as_consent(parted()), folder))
    rows = jobs.current_consent(spark, folder).collect()
    want = {u: tuple(max(ts for _, ts, x, k, *_ in DATA if x == u and k == kind) for kind in ("view", "purchase")) for u in range(3)}
    assert sorted((r.customer_id, r.objection_at, r.withdrawn_at) for r in rows) == sorted((u, *v) for u, v in want.items())
    assert len(runs._folders(spark, f"{folder}/state", "version")) <= 2


def test_upsert_of_one_version_twice(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k bigint, v string"
    make = lambda rows: spark.createDataFrame(rows, schema)
    empty = runs.newest(spark, path, make([]).schema)
    assert empty.count() == 0
    for rows, version in (([(1, "a"), (2, "b")], 0), ([(2, "c"), (3, "d")], 1), ([(2, "c"), (3, "d")], 1), ([(3, "e")], 2)):
        runs.upsert(make(rows), path, version, ["k"])
    assert sorted(map(tuple, runs.newest(spark, path, empty.schema).collect())) == [(1, "a"), (2, "c"), (3, "e")]
    os.remove(f"{path}/version=2/_SUCCESS")  # cut off while it was written
    assert sorted(map(tuple, runs.newest(spark, path, empty.schema).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_a_withdrawal_never_adds_a_person(spark):
    registry = spark.createDataFrame(
        [(1, "marketing_email", True, at(0), "formulaire_web", "v1", None, None)],
        "customer_id bigint, purpose string, opt_in boolean, consent_date timestamp_ntz, consent_source string, consent_wording_version string, withdrawn_at timestamp_ntz, objection_at timestamp_ntz",
    )
    states = spark.createDataFrame(
        [(1, "marketing_email", None, at(5)), (2, "marketing_email", None, at(5)), (3, "marketing_email", at(4), at(5))],
        "customer_id bigint, purpose string, objection_at timestamp_ntz, withdrawn_at timestamp_ntz",
    )
    out = {r.customer_id: r for r in jobs.consent_registry(registry, states).collect()}
    assert sorted(out) == [1, 3]
    assert not out[1].opt_in and out[1].withdrawn_at == at(5)
    assert out[3].objection_at == at(4) and out[3].withdrawn_at is None
    events = spark.createDataFrame([(1, "marketing_email", "withdrawal", at(5)), (2, "marketing_email", "withdrawal", at(5)), (3, "marketing_email", "objection", at(4)), (3, "marketing_email", "withdrawal", at(5))], "customer_id bigint, purpose string, kind string, at timestamp_ntz")
    assert sorted(map(str, apply_events(registry, events).collect())) == sorted(map(str, out.values()))


def test_a_scored_batch_run_again_replaces_its_rows(spark, sf, tmp_path, monkeypatch):
    """The job dies after its first table was written; the batch is run again under its number."""
    rows = c.features(spark, sf, "ends").withColumn("email_open_rate_30d", F.when(F.col("total_orders") > 5, 1.5).otherwise(F.col("email_open_rate_30d")))
    source, folder = str(tmp_path / "served"), str(tmp_path / "job")
    rows.write.parquet(source)
    read = lambda: spark.readStream.schema(rows.schema).parquet(source)
    write, calls = runs.replace_batch, []

    def dies(batch, path, batch_id):
        write(batch, path, batch_id)
        calls.append(path)
        if len(calls) == 1:
            raise RuntimeError("lost")

    monkeypatch.setattr(runs, "replace_batch", dies)
    with pytest.raises(Exception, match="lost"):
        runs.finish(jobs.score_into(read(), c.V1, c.THRESHOLD, folder))
    runs.finish(jobs.score_into(read(), c.V1, c.THRESHOLD, folder))
    assert [p.rsplit("/", 1)[1] for p in calls] == ["scored", "scored", "quarantined"]
    want = jobs.score_stream(rows, c.V1, c.THRESHOLD)
    got = {s: runs.read_batches(spark, f"{folder}/{s}", want.schema) for s in ("scored", "quarantined")}
    for status, table in got.items():
        assert sorted(map(str, table.collect())) == sorted(map(str, want.where(F.col("status") == status).collect())), status
    assert all(t.count() > 0 for t in got.values())
    runs.finish(jobs.score_into(read(), c.V1, c.THRESHOLD, folder))  # nothing new
    assert got["scored"].count() == want.where("status = 'scored'").count()


def test_no_batch_yet(spark, tmp_path):
    schema = spark.range(1).schema
    assert runs.read_batches(spark, str(tmp_path / "none"), schema).count() == 0


def test_upsert_evaluates_a_batch_once(spark, tmp_path):
    """A second evaluation of a stateful batch waits for the state stores that the first one holds."""
    seen = spark.sparkContext.accumulator(0)

    def row(k):
        seen.add(1)
        return k, "new"

    for version in (0, 1):
        changes = spark.createDataFrame(spark.sparkContext.parallelize(range(5), 1).map(row), "k bigint, v string")
        runs.upsert(changes, str(tmp_path), version, ["k"])
        assert seen.value == 5 * (version + 1)
    assert runs.newest(spark, str(tmp_path), changes.schema).count() == 5
