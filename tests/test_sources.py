"""Connectors that the queries do not cover."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import TX, at
from tidemark.functions.temporal import naive_utc
from tidemark.operators.features import snapshot_dataset
from tidemark.schemas import TRANSACTIONS
from tidemark.session import materialize, scratch_root
from tidemark.sources import files


def test_zoned_dates_become_wall_clock(spark, tmp_path):
    df = spark.createDataFrame([("a", at(0), 1.0, "x")], TX).withColumn("order_date", F.col("order_date").cast("timestamp"))
    df.write.parquet(str(tmp_path / "tx"))
    back = files.read_transactions(spark, str(tmp_path / "tx"))
    assert dict(back.dtypes)["order_date"] == "timestamp_ntz"
    assert snapshot_dataset(back, [at(5)]).first().days_since_last_order == 5


def test_malformed_csv_fails_when_strict(spark, tmp_path):
    header = ",".join(TRANSACTIONS.fieldNames())
    (tmp_path / "bad.csv").write_text(header + "\nC1,not a date,1.0,x,0,0,0\n")
    with pytest.raises(Exception, match="malformed record: order_date"):
        files.read_transactions(spark, str(tmp_path / "bad.csv"), strict=True).collect()
    assert files.read_transactions(spark, str(tmp_path / "bad.csv")).first().order_date is None


def test_transaction_files_of_other_shapes(spark, tmp_path):
    """Without flags, with a refund flag, other order, unknown columns, zones, words and bad values."""
    (tmp_path / "a.csv").write_text(
        "product_category,customer_id,order_value,order_date,is_refund,shop\n"
        "x,C1,1.5,2024-05-01 10:00:00+02,True,s1\nx,C2,n/a,2024-05-01T10:00:00z,0,s2\nx,C3,2,someday,,\n,,,,,\nx,C4,1\n"
    )
    checked = files.read_checked(spark, str(tmp_path / "a.csv"), TRANSACTIONS).collect()
    assert [list(r.unreadable) for r in checked] == [[], ["order_value"], ["order_date"], [], ["line"]]
    df = files.read_transactions(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["product_category", "customer_id", "order_value", "order_date", "is_refund", "shop"]
    got = [tuple(r) for r in df.collect()]
    assert got[0] == ("x", "C1", 1.5, dt.datetime(2024, 5, 1, 8), True, "s1")
    assert got[1] == ("x", "C2", None, dt.datetime(2024, 5, 1, 10), False, "s2")
    assert got[2][3] is None and got[3] == (None,) * 6
    assert [r.customer_id for r in files.bad_records(files.read_checked(spark, str(tmp_path / "a.csv"), TRANSACTIONS)).collect()] == ["C2", "C3", "C4"]
    (tmp_path / "b.csv").write_text("customer_id,order_date,order_value,product_category,email_opened,website_visit\nC1,2024-05-01,2,x,1.0,true\nC1,2024-05-01,2,x,0.5,2\n")
    assert [(r.email_opened, r.website_visit) for r in files.read_transactions(spark, str(tmp_path / "b.csv")).collect()] == [(1, 1), (None, 2)]
    (tmp_path / "c.csv").write_text("customer_id,order_value\nC1,2\n")
    with pytest.raises(files.MissingColumnsError, match="order_date"):
        files.read_transactions(spark, str(tmp_path / "c.csv"))


def test_unreadable_dates_reach_the_contract(spark, tmp_path):
    from tidemark.operators import contracts

    (tmp_path / "a.csv").write_text("customer_id,order_date,order_value,product_category\n" + "C1,2024-05-01,1,x\n" * 3 + "C1,soon,1,x\n")
    report = contracts.contract_transactions(files.read_transactions(spark, str(tmp_path / "a.csv")), dt.datetime(2024, 6, 1))
    assert {r.name: r.passed for r in report.collect()}["dates_parse"] is False


def test_erasure_files(spark, tmp_path):
    from tidemark.operators.retention import pending_erasures

    (tmp_path / "ids.csv").write_text("customer_id\nC1\nC2\n")
    (tmp_path / "both.csv").write_text("customer_id,processed_in_model_version\nC1,\nC2,v0001\nC3,\n")
    pending = lambda name: pending_erasures(files.read_erasure_requests(spark, str(tmp_path / name))).first().pending
    assert (pending("ids.csv"), pending("both.csv")) == (2, 2)


def test_consent_dates_with_zones(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "customer_id,purpose,opt_in,consent_date,consent_source,consent_wording_version,withdrawn_at,objection_at\n"
        "C1,marketing_email,True,2024-05-01T10:00:00+02:00,web,v1,,2024-06-01 10:00:00 Europe/Paris\nC2,marketing_sms,false,never,web,,,\n"
    )
    one, two = files.read_consent(spark, str(tmp_path / "c.csv")).collect()
    assert one.opt_in and one.consent_date == dt.datetime(2024, 5, 1, 8) and one.objection_at == dt.datetime(2024, 6, 1, 8) and one.withdrawn_at is None
    assert not two.opt_in and two.consent_date is None
    with pytest.raises(Exception, match="malformed record: consent_date"):
        files.read_consent(spark, str(tmp_path / "c.csv"), strict=True).collect()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_zones_of_texts(spark, zone):
    texts = {
        "2024-05-01 10:00:00+02:00": 8, "2024-05-01 10:00:00+02": 8, "2024-05-01 10:00:00+0200": 8, "2024-05-01T10:00:00z": 10,
        "2024-05-01 10:00:00 Europe/Paris": 8, "2024-05-01 10:00+02:00": 8, " 2024-05-01 10:00:00 UTC": 10, "2024-05-01 10:00": 10,
        "2024-05-01": 0, "2024-05-01 10:00:00 -05": 15, "nope": None, None: None,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = {r.t: r.u for r in df.select("t", naive_utc(F.col("t"), "string").alias("u")).collect()}
        fold = spark.sql("SELECT timestamp_micros(u) AS t, u FROM VALUES (1730611800000000), (1730615400000000) v(u)")  # the hour that New York has twice
        clock = [r.w for r in fold.select(naive_utc(F.col("t"), "timestamp").alias("w")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {t: None if h is None else dt.datetime(2024, 5, 1, h) for t, h in texts.items()}
    assert clock == [dt.datetime(2024, 11, 3, 5, 30), dt.datetime(2024, 11, 3, 6, 30)]


def test_staging_replaces_only_its_day(spark, tmp_path):
    df = spark.range(3)
    for day, rows in ((1, df), (2, df), (1, df.limit(1))):
        files.stage_daily(rows, str(tmp_path / "s"), dt.date(2024, 1, day))
    counts = spark.read.parquet(str(tmp_path / "s")).groupBy("ds").count().collect()
    assert {r.ds.day: r["count"] for r in counts} == {1: 1, 2: 3}


def test_date_filter_reads_one_folder(spark, tmp_path):
    data = [("a", at(i), 1.0, "x") for i in range(0, 100, 10)]
    path = str(tmp_path / "f")
    files.write_features(snapshot_dataset(spark.createDataFrame(data, TX), [at(30), at(60)]), path)
    back = files.read_features(spark, path)
    assert back.count() == 2
    one = back.filter(F.col("snapshot_date") == F.lit(at(30).isoformat(sep=" ")).cast("timestamp_ntz"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1 and "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_the_clusters_scratch_folder_is_used(spark):
    assert scratch_root(spark) == scratch_root(spark)
    df = materialize(spark.range(5), "t")
    assert df.count() == 5 and scratch_root(spark) in df.inputFiles()[0]


def test_side_by_side_refuses_a_second_row(spark):
    from tidemark.functions.frames import side_by_side

    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",), ("y",)], "b string")
    assert side_by_side(one, two.limit(1)).collect()[0]["a"] == 1
    with pytest.raises(Exception, match="more than one row"):
        side_by_side(one, two).collect()


def test_no_local_scratch_on_a_cluster():
    from types import SimpleNamespace

    from tidemark.session import scratch_root

    conf = SimpleNamespace(get=lambda key, default=None: default)
    far = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        scratch_root(far)
