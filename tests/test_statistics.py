"""Order statistics, metrics and drift against brute force."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tidemark.operators import drift, insights, metrics, quantiles, splits
from tidemark.operators.ordered import equal_slices, quantile_bucket, rows_at_ranks, running_totals


@pytest.mark.parametrize("kind", ["distinct", "one value", "a third tied", "few values"])
def test_rows_at_ranks(spark, kind):
    rng = random.Random(3)
    n = 2000
    value = {
        "distinct": lambda: rng.random(),
        "one value": lambda: 5.0,
        "a third tied": lambda: 0.0 if rng.random() < 0.4 else rng.random(),
        "few values": lambda: float(rng.randrange(3)),
    }[kind]
    data = [(i, value()) for i in rng.sample(range(10**6), n)]
    df = spark.createDataFrame(data, "id bigint, v double")
    ranks = [1, 2, n // 3, n // 2, n - 1, n]
    got = rows_at_ranks(df, {"v": "v"}, ["id"], lambda _: ranks, buckets=16)["v"]
    ordered = sorted((v, i) for i, v in data)
    assert got == {r: ordered[r - 1] for r in ranks}


def test_running_totals_across_buckets(spark):
    rng = random.Random(5)
    data = [(g, float(v), rng.randrange(100)) for g in "ab" for v in rng.sample(range(10000), 300)]
    df = spark.createDataFrame(data, "g string, v double, n bigint")
    out = running_totals(quantile_bucket(df, ["g"], "v", 2, buckets=8), ["g"], "v", ["n"])
    got = {(r.g, r.v): r.cum_n for r in out.collect()}
    for g in "ab":
        total = 0
        for _, v, n in sorted(x for x in data if x[0] == g):
            total += n
            assert got[(g, v)] == total


def _scores(spark, n=400, seed=2, digits=2):
    rng = random.Random(seed)
    data = [(i, round(rng.random(), digits)) for i in range(n)]
    data = [(i, p, int(rng.random() < p)) for i, p in data]
    return data, spark.createDataFrame(data, "customer_id bigint, churn_proba double, churn int").withColumn("m", F.lit("x"))


def test_auc_counts_ties_by_half(spark):
    data, df = _scores(spark)
    pos = [p for _, p, y in data if y]
    neg = [p for _, p, y in data if not y]
    area = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert metrics.roc_auc(df, ["m"]).first().roc_auc == pytest.approx(area, abs=5e-5)


def test_one_class_and_equal_scores(spark):
    one = spark.createDataFrame([("x", 0.4, 1), ("x", 0.9, 1)], "m string, churn_proba double, churn int")
    assert metrics.roc_auc(one, ["m"]).first().roc_auc == 0.0
    equal = spark.createDataFrame([("x", 0.4, 1), ("x", 0.4, 0)], "m string, churn_proba double, churn int")
    assert metrics.roc_auc(equal, ["m"]).first().roc_auc == 0.5


def test_nothing_predicted_gives_zero_metrics(spark):
    df = spark.createDataFrame([("x", 0.1, 1)], "m string, churn_proba double, churn int")
    r = metrics.classification_metrics(df, ["m"], 0.5).first()
    assert (r.f1, r.precision, r.recall) == (0.0, 0.0, 0.0)


def test_threshold_sweep_equals_91_scans(spark):
    data, df = _scores(spark, digits=4)
    grid = np.arange(0.05, 0.96, 0.01)
    assert len(grid) == 91
    want = {}
    for th in grid:
        hit = [(p, y) for _, p, y in data if p >= th]
        if hit and len(hit) / len(data) <= 0.35:
            tp = sum(y for _, y in hit)
            want[round(float(th), 2)] = (len(hit), tp * 75.0 - len(hit) * 27.0)
    got = {r.threshold: (r.contacted, r.net_value) for r in metrics.threshold_sweep(df, ["m"]).collect()}
    assert got == want
    best = metrics.best_threshold(df, ["m"]).first()
    assert best.threshold == min(t for t, v in want.items() if v[1] == max(x[1] for x in want.values()))


def test_scores_on_the_grid_are_counted_at_their_own_threshold(spark):
    grid = [0.05 + i * ((0.05 + 0.01) - 0.05) for i in range(91)]
    df = spark.createDataFrame([("x", p, 1) for p in grid], "m string, churn_proba double, churn int")
    got = {r.threshold: r.contacted for r in metrics.threshold_sweep(df, ["m"], max_contact_rate=1.0).collect()}
    assert got == {round(p, 2): 91 - i for i, p in enumerate(grid)}


def test_no_threshold_fits_the_capacity(spark):
    df = spark.createDataFrame([("x", 0.99, 1)] * 10, "m string, churn_proba double, churn int")
    best = metrics.best_threshold(df, ["m"]).first()
    assert (best.threshold, best.fallback) == (0.5, True)


def test_lift_takes_whole_ranks_through_ties(spark):
    data, df = _scores(spark, n=333, digits=1)
    ranked = sorted(data, key=lambda r: (-r[1], r[0]))
    base = sum(y for _, _, y in data) / len(data)
    for r in metrics.lift_at(df).collect():
        k = max(1, int(len(data) * {10: 0.1, 20: 0.2, 30: 0.3}[r.top_percent]))
        precision = sum(y for _, _, y in ranked[:k]) / k
        assert r.k == k
        assert r.precision_at_k == pytest.approx(precision, abs=5e-5)
        assert r.lift_at_k == pytest.approx(precision / base, abs=5e-5)


def test_calibration_edges_belong_to_the_lower_bucket(spark):
    df = spark.createDataFrame([(p, 0) for p in (0.0, 0.1, 0.10001, 0.3, 0.7, 1.0)], "churn_proba double, churn int")
    assert rows(metrics.calibration_table(df).select("bucket", "customers"), "bucket") == [(1, 2), (2, 1), (3, 1), (7, 1), (10, 1)]


# ---------------------------------------------------------------------- drift


def brute_psi(a, b):
    q = np.unique(np.quantile(a, np.linspace(0, 1, 11)))
    if len(q) < 3:
        return 0.0 if np.isclose(np.mean(a), np.mean(b)) else 1.0
    q[0], q[-1] = -np.inf, np.inf
    e = np.clip(np.histogram(a, q)[0] / len(a), 1e-6, None)
    c = np.clip(np.histogram(b, q)[0] / len(b), 1e-6, None)
    return float(np.sum((c - e) * np.log(c / e)))


def brute_ks(a, b):
    grid = np.concatenate([a, b])
    return max(abs(np.mean(a <= x) - np.mean(b <= x)) for x in grid)


def test_psi_and_ks_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    cases = {
        "shifted": (rng.normal(0, 1, 700), rng.normal(0.5, 1, 600)),
        "same": (rng.normal(0, 1, 700), rng.normal(0, 1, 600)),
        "integers": (rng.integers(0, 6, 700).astype(float), rng.integers(0, 8, 600).astype(float)),
        "mostly_zero": (np.where(rng.random(700) < 0.6, 0, rng.random(700)), rng.random(600)),
        "constant": (np.full(700, 3.0), np.full(600, 3.0)),
        "constant_moved": (np.full(700, 3.0), np.full(600, 4.0)),
    }
    frame = lambda i: spark.createDataFrame(
        [tuple(float(v[i][k]) for v in cases.values()) for k in range((700, 600)[i])],
        ", ".join(f"{n} double" for n in cases),
    )
    reference, current = frame(0), frame(1)
    got = {r.feature: r.psi for r in drift.psi(reference, current, list(cases)).collect()}
    distance = {r.feature: r.ks_distance for r in drift.ks_distance(reference, current, list(cases)).collect()}
    for name, (a, b) in cases.items():
        assert got[name] == pytest.approx(brute_psi(a, b), abs=1e-9), name
        assert distance[name] == pytest.approx(brute_ks(a, b), abs=1e-12), name


def test_absent_and_empty_features_are_reported_without_a_value(spark):
    reference = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, gone double")
    current = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, gone double")
    out = {r.feature: r for r in drift.feature_drift(reference, current, ["a", "gone", "missing"]).collect()}
    assert out["missing"].interpretation == "absente" and out["missing"].psi is None
    assert out["gone"].interpretation == "indeterminé" and not out["gone"].drifted
    assert drift.drift_summary(drift.feature_drift(reference, current, ["a", "missing"])).first().psi_max == 0.0


def test_text_numbers_are_coerced(spark):
    df = spark.createDataFrame([("1.5",), ("n/a",), (None,)], "x string")
    assert [r.x for r in drift.coerce_numeric(df, ["x"]).collect()] == [1.5, None, None]


def test_prediction_drift_of_disjoint_scores(spark):
    rng = random.Random(0)
    low = spark.createDataFrame([(rng.random() * 0.3,) for _ in range(500)], "churn_proba double")
    high = spark.createDataFrame([(0.7 + rng.random() * 0.3,) for _ in range(500)], "churn_proba double")
    out = drift.prediction_drift(low, high)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    r = out.first()
    assert r.drift_detected and r.interpretation == "dérive significative" and r.high_share_ref == 0.0


def test_ks_p_value_needs_rows(spark):
    few = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    assert drift.ks_distance(few, few, ["x"]).first().ks_pvalue is None
    many = spark.createDataFrame([(float(i),) for i in range(50)], "x double")
    assert drift.ks_distance(many, many, ["x"]).first().ks_pvalue == 1.0


# ------------------------------------------------------------------- insights


@pytest.mark.parametrize("n,sizes", [(7, (2, 2, 3)), (8, (3, 2, 3)), (9, (3, 3, 3)), (3, (1, 1, 1))])
def test_terciles(spark, n, sizes):
    df = spark.createDataFrame(
        [(i, i, 1.0, float(i), 0) for i in range(n)],
        "customer_id bigint, days_since_last_order int, purchase_frequency_30d double, total_revenue double, churn int",
    )
    got = insights.rfm_scores(df).collect()
    count = lambda col, s: sum(r[col] == s for r in got)
    assert tuple(count("M_score", s) for s in (1, 2, 3)) == sizes
    assert tuple(count("R_score", s) for s in (3, 2, 1)) == sizes
    assert tuple(count("F_score", s) for s in (1, 2, 3)) == sizes


def test_segment_listed_twice_takes_the_first_name(spark):
    codes = [("1", "1", "2"), ("3", "3", "3"), ("2", "3", "3"), ("2", "2", "1")]
    df = spark.createDataFrame(codes, "R_score string, F_score string, M_score string")
    assert [r.segment_name for r in insights.rfm_segments(df).collect()] == ["Perdus", "Champions", "Autres", "Clients fidèles"]


def test_frequency_zero_is_in_no_bin(spark):
    df = spark.createDataFrame(
        [(0.0, 1, 5.0), (1.0, 0, 5.0), (11.0, 1, 5.0)], "purchase_frequency_30d double, churn int, total_revenue double"
    )
    assert rows(insights.churn_by_frequency(df).select("bin", "customers"), "bin") == [("0-1", 1), (">10", 1)]


def test_recency_bin_edges(spark):
    df = spark.createDataFrame([(d, 1, 1.0) for d in (0, 30, 31, 180, 181)], "days_since_last_order int, churn int, total_revenue double")
    assert rows(insights.churn_by_recency(df).select("bin", "customers"), "bin") == [
        ("30-60j", 1), ("90-180j", 1), ("<30j", 2), (">180j", 1),
    ]


def test_constant_feature_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0), (1.0, 3.0, 1), (1.0, 4.0, 1)], "flat double, x double, churn int")
    got = {r.feature: r.correlation for r in insights.feature_correlation(df, ["flat", "x"]).collect()}
    assert got["flat"] is None and got["x"] == pytest.approx(math.sqrt(3) / 2, abs=1e-6)


def test_ordered_split(spark):
    df = spark.createDataFrame([(f"c{i:02d}",) for i in range(11)], "customer_id string")
    out = splits.ordered_split(df).groupBy("split").count()
    assert dict(rows(out)) == {"train": 8, "test": 3}


def test_training_queries_use_the_default_ensemble(monkeypatch, spark, sf):
    from queries import models
    from tidemark.plans import training

    seen = []
    monkeypatch.setattr(models.c, "features", lambda *a: None)
    monkeypatch.setattr(models.c, "dates", lambda *a: None)
    for name in ("train_model", "train_legacy"):
        monkeypatch.setattr(training, name, lambda f, cfg=training.TrainingConfig(), **more: seen.append(cfg) or training.Training(*[None] * 7))
    for query in (models.train_model, models.train_legacy, models.feature_importance):
        query(spark, sf)
    assert seen == [training.TrainingConfig()] * 3 and seen[0].trees == 200


def test_early_stop_waits_for_later_gains():
    from tidemark.plans.training import best_iteration

    assert best_iteration([0.9, 0.91, 0.89, 0.9, 0.95], 30) == 3
    assert best_iteration([0.9, 0.91, 0.92, 0.1], 2) == 1
    assert best_iteration([0.9, 0.8, 0.7], 1) == 3


# ---------------------------------------------------------- exact order statistics


def test_order_codes_rise_with_the_number(spark):
    rng = np.random.default_rng(3)
    xs = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"), 1.0, 2.0, np.nextafter(2.0, 0), np.nextafter(2.0, 3)]
    xs += [float(x) for k in range(-1074, 1024, 7) for x in (2.0**k, np.nextafter(2.0**k, 0), np.nextafter(2.0**k, np.inf))]
    xs += rng.normal(0, 1, 200).tolist() + (10.0 ** rng.uniform(-300, 300, 300)).tolist()
    xs = sorted({float(s * x) for x in xs for s in (-1, 1)})
    df = spark.createDataFrame([(x,) for x in xs] + [(float("nan"),), (None,)], "x double")
    got = {r.x: r.code for r in df.select("x", quantiles.order_code(F.col("x")).alias("code")).collect() if r.x is not None and not math.isnan(r.x)}
    assert [got[x] for x in xs] == [quantiles.code_of(x) for x in xs] == sorted(got.values())
    assert df.where("x is null or isnan(x)").select(quantiles.order_code(F.col("x")).alias("c")).where("c is not null").count() == 0


def _cases(rng, n, m):
    wide = lambda k: np.where(rng.random(k) < 0.5, 1, -1) * 10.0 ** rng.uniform(-300, 300, k)
    return {
        "wide": (wide(n), wide(m)),
        "same": (rng.normal(0, 1, n), rng.normal(0, 1, m)),
        "clustered": (0.5 + rng.random(n) * 1e-13, 0.5 + rng.random(m) * 1.5e-13),
        "one_value_mostly": (np.where(rng.random(n) < 0.7, 7.0, rng.random(n)), np.where(rng.random(m) < 0.7, 7.0, rng.random(m) * 20)),
        "outlier": (np.append(rng.random(n - 1), 1e300), rng.random(m)),
        "negative": (-(rng.random(n) ** 9), -(rng.random(m) ** 8)),
    }


@pytest.mark.parametrize("bits", [(12, 14), (2, 5)])
def test_profiles_equal_sorting(spark, monkeypatch, bits):
    monkeypatch.setattr(quantiles, "FIRST_BITS", bits[0])
    monkeypatch.setattr(quantiles, "LATER_BITS", bits[1])
    n, m = 701, 603
    cases = _cases(np.random.default_rng(5), n, m)
    frame = lambda i: spark.createDataFrame([tuple(float(v[i][k]) for v in cases.values()) + (None,) for k in range((n, m)[i])], ", ".join(f"{x} double" for x in [*cases, "gone"]))
    levels = [0, 0.1, 0.25, 1 / 3, 0.5, 0.9, 1]
    names = [*cases, "gone"]
    with quantiles.two_sides(frame(0), frame(1), names) as table:
        found = {p.feature: p for p in quantiles.profiles(table, names, lambda k: quantiles.ranks_of(k, levels), with_distance=True)}
    for name, (a, b) in cases.items():
        p, ordered = found[name], np.sort(a)
        assert p.rows == (n, m) and p.slice_rows == (n, m)
        assert p.at_rank == {r: ordered[r] for r in quantiles.ranks_of(n, levels)}, name
        assert p.distance == pytest.approx(brute_ks(a, b), abs=1e-12), name
    assert found["gone"].rows == (0, 0) and found["gone"].at_rank == {}


def test_drift_passes_exchange_counts_only(spark):
    """No value is an exchange key, and no pass writes a table."""
    df = spark.createDataFrame([(float(i), float(i % 7)) for i in range(500)], "a double, b double")
    plans = []
    with quantiles.two_sides(df, df, ["a", "b"]) as table:
        seen = quantiles._Search(quantiles.Profile("a", rows=(500, 500)), {3}, True, 40)
        collect = type(table).collect
        try:
            type(table).collect = lambda self: (plans.append(self._jdf.queryExecution().executedPlan().toString()), collect(self))[1]
            quantiles._counted(table, {0: seen}, True)
        finally:
            type(table).collect = collect
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plans[0])
    assert keys and all(re.fullmatch(r"i#\d+, cell#\d+L?, \d+", k) for k in keys)


def test_drift_report_is_sorted_and_counts_the_slices(spark):
    rng = np.random.default_rng(1)
    reference = spark.createDataFrame([(float(x), float(x)) for x in rng.normal(0, 1, 80)] + [(None, 1.0)], "a double, b double")
    current = spark.createDataFrame([(float(x) + 3, float(x)) for x in rng.normal(0, 1, 60)], "a double, b double")
    out = drift.feature_drift(reference, current, ["absent", "b", "a"]).collect()
    assert [r.feature for r in out] == ["a", "b", "absent"]
    assert {(r.reference_rows, r.current_rows) for r in out} == {(81, 60)}
    assert out[0].ks_pvalue < 1e-6 and out[2].ks_pvalue is None and out[2].psi is None
    assert drift.feature_drift(reference, current, ["absent"]).first().reference_rows == 81


def test_descriptions_equal_numpy(spark):
    rng = np.random.default_rng(2)
    values = {"a": rng.normal(0, 1, 400), "b": rng.integers(0, 5, 400).astype(float), "c": 10.0 ** rng.uniform(-2, 6, 400)}
    df = spark.createDataFrame([tuple(float(v[k]) for v in values.values()) + (None,) for k in range(400)], "a double, b double, c double, d double")
    out = {r.feature: r for r in insights.describe_features(df, ["a", "b", "c", "d"]).collect()}
    for name, v in values.items():
        want = (400, v.mean(), v.std(ddof=1), v.min(), v.max(), *np.quantile(v, (0.25, 0.5, 0.75)))
        assert tuple(out[name])[1:] == pytest.approx(want, abs=6e-5)
    assert tuple(out["d"]) == ("d", 0, None, None, None, None, None, None, None)


def test_slices_are_even_where_scores_cluster(spark):
    rng = np.random.default_rng(7)
    scores = np.unique(np.concatenate([0.5 + rng.random(9000) * 1e-9, rng.random(1000)]))
    df = spark.createDataFrame([("x", float(s)) for s in scores] + [("y", 0.5)], "g string, score double")
    cut = equal_slices(df, ["g"], "score", rows=200)
    sizes = [r["count"] for r in cut.where("g = 'x'").groupBy("_bucket").count().collect()]
    assert len(sizes) >= 45 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    spans = cut.where("g = 'x'").groupBy("_bucket").agg(F.min("score").alias("a"), F.max("score").alias("b")).orderBy("_bucket").collect()
    assert all(x.b < y.a for x, y in zip(spans, spans[1:]))


def test_metrics_without_groups(spark):
    df = spark.createDataFrame([("x", 0.9, 1), ("x", 0.8, 0), ("x", 0.3, 0), ("x", None, 1)], "m string, churn_proba double, churn int")
    want = metrics.evaluate(df, ["m"], 0.5, 0.1).drop("m").collect()
    assert metrics.evaluate(df, [], 0.5, 0.1).collect() == want and want[0].rows == 3
    assert metrics.roc_auc(df, []).first().roc_auc == metrics.roc_auc(df, ["m"]).first().roc_auc == 1.0
    assert metrics.best_threshold(df, [], max_contact_rate=1.0).first() == metrics.best_threshold(df, ["m"], max_contact_rate=1.0).drop("m").first()
    assert metrics.threshold_sweep(df, []).columns == metrics.threshold_sweep(df, ["m"]).drop("m").columns


def test_lift_with_fractional_keys_and_missing_scores(spark):
    df = spark.createDataFrame([(1.2, 0.5, 1), (1.7, 0.5, 0), (1.9, 0.5, 1), (0.1, None, 1)], "customer_id double, churn_proba double, churn int")
    out = {r.top_percent: r for r in metrics.lift_at(df, (0.34, 0.67)).collect()}
    assert out[34].k == 1 and out[34].precision_at_k == 1.0
    assert out[67].k == 2 and out[67].precision_at_k == 0.5 and out[67].base_rate == pytest.approx(2 / 3, abs=1e-4)


def test_training_grows_once_and_keeps_a_prefix(spark, sf, monkeypatch):
    from queries import common as c
    from tidemark.plans import training

    grown, fit = [], training._fit
    monkeypatch.setattr(training, "_fit", lambda names, cfg, train: grown.append(cfg.trees) or fit(names, cfg, train))
    table, dates = c.features(spark, sf, "all"), c.dates(spark, sf)
    run = training.train_model(table, training.TrainingConfig(trees=6, max_depth=2, patience=1), dates=dates)
    kept = run.model.stages[-1].getNumTrees
    assert grown == [6] and 1 <= kept <= 6
    shorter = training.train_model(table, training.TrainingConfig(trees=kept, max_depth=2, patience=99), dates=dates)
    key = lambda t: sorted(map(tuple, t.select("customer_id", "snapshot_date", "churn_proba").collect()))
    assert key(run.scored) == key(shorter.scored)
    r = run.record.first()
    assert r.best_iteration == kept - 1 and r.tuning == "tuned" and r.decision_threshold == run.threshold
    quality = {q.split: q for q in run.metrics.collect()}
    assert quality["test"].overfitting_gap_f1 == round(quality["train"].f1 - quality["test"].f1, 4)
    part = run.scored.where("split = 'test'").toPandas().sort_values(["churn_proba", "customer_id"], ascending=[False, True])
    k = max(1, int(len(part) * 0.1))
    assert quality["test"].precision_at_10 == pytest.approx(part["churn"][:k].mean(), abs=0.15)  # ties by hash of the key
    assert quality["test"].lift_at_10 == pytest.approx(quality["test"].precision_at_10 / part["churn"].mean(), abs=1e-3)


def test_monitoring_of_two_versions_without_requests(spark, sf):
    from queries import common as c
    from tidemark.plans import feature_build, monitoring

    table = c.features(spark, sf, "ends").persist()
    reference, current = feature_build.reference_and_current(table)
    score = lambda df, m: c.scoring.score_batch(df, m, 0.6, F.col("snapshot_date"), keep=["churn"])
    cohort = score(current, c.V1).unionByName(score(current, c.V2))
    report = monitoring.monitoring_report(reference, current, score(reference, c.V1), score(current, c.V1), cohort, 10, 0.5, 0.6, None).collect()
    assert sorted(r.model_version for r in report) == ["v0001", "v0002"] and {r.erasure_requests for r in report} == {0}
    assert len({r.psi_max for r in report}) == 1 and len({r.f1 for r in report}) == 2
    table.unpersist()
