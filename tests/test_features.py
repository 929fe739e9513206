"""Point-in-time features: boundaries, a naive loop, skew, leaks, single-date facts."""

from __future__ import annotations

import datetime as dt
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import TX, at, rows
from tidemark.operators import contracts, features as feat, snapshots as snap
from tidemark.schemas import MODEL_FEATURES

T = dt.datetime(2024, 8, 1)
DAY = dt.timedelta(days=1)
TICK = dt.timedelta(microseconds=1)
CFG = snap.SnapshotConfig()


def _tx(spark, data, schema=TX):
    return spark.createDataFrame(data, schema)


def naive(pdf: pd.DataFrame, t: dt.datetime, cfg=CFG) -> dict:
    """One snapshot by plain selections, for comparison."""
    out = {}
    day = pd.Timedelta(days=1)
    for cid, g in pdf.groupby("customer_id"):
        seen = g[g.order_date <= t].sort_values("order_date")
        if seen.empty or not (seen.order_date > t - cfg.activity_days * day).any():
            continue
        short = seen[seen.order_date >= t - cfg.short_days * day]
        long = seen[seen.order_date >= t - cfg.long_days * day]
        after = g[(g.order_date > t) & (g.order_date <= t + cfg.outcome_days * day)]
        gaps = seen.order_date.diff().dt.days
        out[cid] = {
            "days_since_first_order": (t - seen.order_date.min()).days,
            "days_since_last_order": (t - seen.order_date.max()).days,
            "purchase_frequency_30d": float(len(short)),
            "purchase_frequency_90d": float(len(long)),
            "avg_basket_value": 0.0 if short.order_value.count() == 0 else short.order_value.mean(),
            "product_category_diversity": float(long.product_category.nunique()),
            "avg_days_between_orders": None if gaps.count() == 0 else gaps.mean(),
            "total_revenue": seen.order_value.sum(),
            "total_orders": int(seen.order_value.count()),
            "churn": int(after.empty),
        }
    return out


def check(spark, data, dates, cfg=CFG):
    pdf = pd.DataFrame(data, columns=["customer_id", "order_date", "order_value", "product_category"])
    pdf["order_date"] = pd.to_datetime(pdf["order_date"])
    got = {}
    for r in feat.snapshot_dataset(_tx(spark, data), dates, cfg).collect():
        got.setdefault(r.snapshot_date, {})[r.customer_id] = r
    for t in dates:
        want = naive(pdf, t, cfg)
        assert set(got.get(t, {})) == set(want), t
        for cid, values in want.items():
            for name, value in values.items():
                found = got[t][cid][name]
                if value is None:
                    assert found is None, (t, cid, name)
                else:
                    assert found == pytest.approx(value, abs=1e-9), (t, cid, name)


def test_boundaries_of_every_window(spark):
    data = []
    for i, days in enumerate((0, 30, 90, 180, -30)):
        for j, nudge in enumerate((-TICK, dt.timedelta(0), TICK)):
            data.append((f"c{i}{j}", T - days * DAY + nudge, 10.0, "a"))
    data += [(f"c{i}{j}", T - 3 * DAY, 1.0, "b") for i in (4,) for j in range(3)]
    check(spark, data, [T])


def test_same_instant_missing_values_and_single_orders(spark):
    data = [
        ("two", T - 5 * DAY, 10.0, "a"),
        ("two", T - 5 * DAY, 20.0, "b"),
        ("one", T - 1 * DAY, 7.5, None),
        ("none", T - 2 * DAY, None, "a"),
        ("later", T + 3 * DAY, 5.0, "a"),
        ("both", T - 40 * DAY, 5.0, "a"),
        ("both", T + 30 * DAY, 5.0, "a"),
    ]
    check(spark, data, [T])


def test_missing_keys_and_dates_are_left_out(spark):
    data = [(None, T - DAY, 1.0, "a"), ("x", None, 1.0, "a"), ("x", T - DAY, 2.0, "a")]
    out = feat.snapshot_dataset(_tx(spark, data), [T]).collect()
    assert [(r.customer_id, r.total_revenue) for r in out] == [("x", 2.0)]


def test_random_history_equals_naive_loop_with_mixed_times_of_day(spark):
    rng = random.Random(7)
    data = [
        (f"c{rng.randrange(15)}", at(rng.random() * 540), round(rng.random() * 100, 2), rng.choice("abcd"))
        for _ in range(500)
    ]
    dates = [at(200), at(260.5), at(320), at(380.25)]
    check(spark, data, dates)


def test_short_activity_with_longer_look_back(spark):
    """The calendar reaches as far as the longest window, not only the activity window."""
    cfg = snap.SnapshotConfig(activity_days=20)
    data = [("a", T - d * DAY, 1.0, c) for d, c in ((85, "x"), (50, "y"), (10, "z"))]
    check(spark, data, [T], cfg)


def test_one_customer_holding_most_rows(spark):
    """A hot customer is cut into calendar cells before any per-customer step."""
    rng = random.Random(1)
    data = [("hot", at(rng.random() * 300), 1.0, rng.choice("abc")) for _ in range(3000)]
    data += [(f"c{i}", at(rng.random() * 300), 2.0, "a") for i in range(300)]
    check(spark, data, [at(240), at(270)])
    cells = feat.cells(_tx(spark, data), at(240), CFG)
    most = cells.groupBy("customer_id").count().agg(F.max("count")).first()[0]
    assert most <= 301 * 2 * 3


def test_optional_columns_decide_the_features(spark):
    bare = feat.snapshot_dataset(_tx(spark, [("a", T - DAY, 1.0, "x")]), [T])
    assert not {"refund_rate", "email_open_rate_30d", "website_visits_30d"} & set(bare.columns)
    full = _tx(
        spark,
        [("a", T - DAY, 1.0, "x", True, 1, 2, None), ("a", T - 2 * DAY, 1.0, "x", False, 0, 3, None)],
        TX + ", is_refund boolean, email_opened int, website_visit int, cart_abandoned int",
    )
    row = feat.snapshot_dataset(full, [T]).first()
    assert (row.refund_rate, row.email_open_rate_30d, row.website_visits_30d, row.cart_abandonment_rate) == (
        0.5, 0.5, 5.0, 0.0,
    )


def test_twenty_two_columns_in_contract_order(spark, sf):
    from queries import common as c

    names = c.features(spark, sf, "latest").columns
    assert names == [
        "customer_id", "first_order_date", "last_order_date", *MODEL_FEATURES, "churn", "snapshot_date",
    ]
    assert len(names) == 22


def test_future_orders_change_no_feature(spark):
    past = [("a", T - 10 * DAY, 1.0, "x"), ("b", T - 20 * DAY, 1.0, "x")]
    future = past + [("a", T + DAY, 9.0, "y"), ("b", T + 60 * DAY, 9.0, "y")]
    one = feat.snapshot_dataset(_tx(spark, past), [T]).drop("churn")
    two = feat.snapshot_dataset(_tx(spark, future), [T]).drop("churn")
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_hand_checked_single_date(spark):
    data = [("C001", at(0), 100.0, "a"), ("C001", at(30), 150.0, "b"), ("C001", at(60), 200.0, "a")]
    data += [("C002", at(0), 80.0, "a"), ("C002", at(15), 120.0, "b")]
    out = {r.customer_id: r for r in feat.features_at(_tx(spark, data), at(75)).collect()}
    assert (out["C001"].total_orders, out["C001"].total_revenue) == (3, 450.0)
    assert (out["C001"].avg_days_between_orders, out["C002"].avg_days_between_orders) == (30.0, 15.0)
    late = feat.features_at(_tx(spark, data), at(150), with_target=True)
    assert {r.churn for r in late.collect()} == {1}


def test_single_date_label_looks_from_the_last_order(spark):
    data = [("soon", at(0), 1.0, "a"), ("soon", at(70), 1.0, "a"), ("soon", at(100), 1.0, "a")]
    data += [("late", at(0), 1.0, "a"), ("late", at(70), 1.0, "a"), ("late", at(100, microseconds=1), 1.0, "a")]
    data += [("young", at(60), 1.0, "a")]
    labels = rows(feat.single_date_labels(_tx(spark, data), at(90)), "customer_id")
    assert labels == [("late", 1), ("soon", 0), ("young", 1)]
    kept = feat.features_at(_tx(spark, data), at(90), with_target=True)
    assert sorted(r.customer_id for r in kept.collect()) == ["late", "soon"]


def test_snapshot_dates_keep_the_time_of_day(spark):
    data = [("a", dt.datetime(2023, 1, 1, 9, 30), 1.0, "x"), ("a", dt.datetime(2023, 10, 15), 1.0, "x")]
    dates = snap.snapshot_dates(_tx(spark, data))
    assert dates == [dt.datetime(2023, 7, 1, 9, 30), dt.datetime(2023, 8, 1, 9, 30), dt.datetime(2023, 9, 1, 9, 30)]


def test_short_period_is_refused_and_a_narrow_one_gives_its_start(spark):
    with pytest.raises(snap.PeriodTooShortError):
        snap.snapshot_dates(_tx(spark, [("a", at(0), 1.0, "x"), ("a", at(209), 1.0, "x")]))
    narrow = _tx(spark, [("a", at(5), 1.0, "x"), ("a", at(220), 1.0, "x")])
    assert snap.snapshot_dates(narrow) == [at(185)]


def test_leak_guard_fails_on_a_negative_age(spark):
    bad = spark.createDataFrame([("a", -5, 3)], "customer_id string, days_since_last_order int, days_since_first_order int")
    assert contracts.temporal_leak_guard(bad).first().negative_days_since_last_order == 1
    with pytest.raises(Exception, match="temporal leak"):
        contracts.with_leak_guard(bad).collect()
    good = bad.withColumn("days_since_last_order", F.lit(1))
    assert contracts.with_leak_guard(good).count() == 1


@pytest.mark.parametrize("outcome, past", [(True, None), (False, 10), (True, 0)])
def test_expansion_equals_comparing_every_pair(spark, outcome, past):
    cfg = snap.SnapshotConfig(outcome_days=5, activity_days=20, short_days=3, long_days=25)
    dates = [at(d) for d in (0, 1, 2, 40, 41, 90, 400)]
    base = 2 * snap.grid_point(dates[0])
    df = spark.createDataFrame([(base + i,) for i in range(-90, 900)], "pos bigint")
    got = {(r.pos, r.snapshot_date): tuple(r)[2:] for r in snap.with_snapshots(df, dates, cfg, past, outcome).collect()}
    back = 25 if past is None else past
    want = {}
    for i in range(-90, 900):
        p = base + i
        for d in dates:
            g = 2 * snap.grid_point(d)
            if g - 2 * back <= p <= g + 2 * (5 if outcome else 0):
                want[p, d] = (p <= g, p <= g and p >= g - 6, p <= g and p >= g - 50, p <= g and p > g - 40, p > g)
    assert got == want


def test_ten_thousand_dates_need_no_join(spark):
    dates = [at(d) for d in range(10_000)]
    tx = _tx(spark, [("a", at(5), 1.0, "x"), ("a", at(9_990), 1.0, "x")])
    cfg = snap.SnapshotConfig(outcome_days=2, activity_days=3)
    labels = snap.churn_labels(tx, dates, cfg)
    plan = labels._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert sorted((r.snapshot_date, r.churn) for r in labels.collect()) == [(at(d), 1) for d in (5, 6, 7, 9990, 9991, 9992)]


def test_plan_has_two_shuffles_and_no_nested_loop(spark, sf):
    from queries import common as c

    plan = c.features(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan and "Cartesian" not in plan
    assert "PushedFilters: [LessThanOrEqual(o_orderdate" in plan


def test_running_state_and_gaps(spark):
    data = [("a", at(0, hours=12), 1.0, "x"), ("a", at(2), 2.0, "x"), ("a", at(2), 3.0, "x"), ("a", at(40), 4.0, "x")]
    out = rows(feat.running_state(_tx(spark, data)).select("orders_so_far", "revenue_so_far", "max_value_so_far"), "orders_so_far")
    assert out == [(1, 1.0, 1.0), (3, 6.0, 3.0), (4, 10.0, 4.0)]
    assert feat.order_gaps(_tx(spark, data)).first().avg_days_between_orders == pytest.approx((1 + 0 + 38) / 3)


def test_parts_of_the_replay_follow_the_rows(spark, sf, monkeypatch):
    from queries import common as c

    def parts(**given):
        plan = feat.snapshot_dataset(c.tx(spark, sf), c.dates(spark, sf), c.CFG, **given)._jdf.queryExecution().executedPlan().toString()
        return int(re.search(r"hashpartitioning\(customer_id#\d+L, (\d+)\), REPARTITION_BY_NUM", plan).group(1))

    monkeypatch.setattr(feat, "ROWS_A_PART", 100)
    assert parts() == 15 and parts(rows=30_000) == 300
    dealt = c.features(spark, sf)
    small = sorted(dealt.collect())
    monkeypatch.setattr(feat, "ROWS_A_PART", 100_000)
    assert parts() == 2 and sorted(c.features(spark, sf).collect()) == small
