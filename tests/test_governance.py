"""Consent rules, privacy, retention, journals, contracts and decisions on small tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import hmac
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import TX, at, rows
from tidemark.functions.temporal import naive_utc
from tidemark.operators import consent, contracts, decisions, journal, privacy, retention, scoring, splits
from tidemark.operators.scoring import LINEAR_V1, check_served_schema, served_row_problems
from tidemark.plans import feature_build, monitoring
from tidemark.schemas import CONSENT, MODEL_FEATURES, SERVED_ROW_BOUNDS

NOW = dt.datetime(2026, 1, 14)
AGO = lambda d: NOW - dt.timedelta(days=d)


def registry(spark, *data):
    return spark.createDataFrame([(*r, *(None,) * (8 - len(r))) for r in data], CONSENT)


@pytest.fixture
def people(spark):
    mail, score = "marketing_email", "churn_scoring"
    return registry(
        spark,
        ("valid", mail, True, AGO(10), "web", "v1", None, None),
        ("withdrawn", mail, True, AGO(100), "web", "v1", AGO(5), None),
        ("expired", mail, True, AGO(900), "web", "v1", None, None),
        ("never", mail, False, None, "none", None, None, None),
        ("today", mail, True, NOW, "web", "v2", None, None),
        ("limit", mail, True, AGO(750), "web", "v1", None, None),
        ("over", mail, True, AGO(751), "web", "v1", None, None),
        ("future", mail, True, AGO(-1), "web", "v1", None, None),
        ("twice", mail, True, AGO(900), "web", "v1", None, None),
        ("twice", mail, True, AGO(3), "web", "v1", None, None),
        ("objects", mail, True, AGO(10), "web", "v1", None, None),
        ("objects", score, False, None, "none", None, None, AGO(1)),
        ("later", score, False, None, "none", None, None, AGO(-1)),
    )


def ids(df):
    return {r.customer_id for r in df.collect()}


def test_valid_opt_ins(people):
    assert ids(consent.valid_opt_ins(people, NOW, "marketing_email")) == {"valid", "today", "limit", "twice", "objects"}
    worded = consent.ConsentPolicy(wording_version="v1")
    assert "today" not in ids(consent.valid_opt_ins(people, NOW, "marketing_email", worded))


def test_scoring_and_targeting_populations(spark, people):
    everyone = spark.createDataFrame([(c,) for c in ("valid", "objects", "later", "unknown")], "customer_id string")
    assert ids(consent.eligible_for_scoring(everyone, people, NOW)) == {"valid", "later", "unknown"}
    assert ids(consent.eligible_for_targeting(everyone, people, "marketing_email", NOW)) == {"valid", "objects"}
    with pytest.raises(consent.NotConsentBasedError):
        consent.eligible_for_targeting(everyone, people, "churn_scoring", NOW)


def test_zone_of_the_reference_date_does_not_matter(people):
    aware = NOW.replace(tzinfo=dt.timezone.utc).astimezone(dt.timezone(dt.timedelta(hours=9)))
    assert ids(consent.objected(people, aware, "churn_scoring")) == {"objects"}


def test_registry_columns_are_required(spark):
    with pytest.raises(consent.IncompleteRegistryError):
        consent.normalise(spark.createDataFrame([("a",)], "customer_id string"))


def test_consent_events(spark, people):
    events = spark.createDataFrame(
        [
            ("valid", "marketing_email", "withdrawal", AGO(1)),
            ("valid", "marketing_email", "withdrawal", AGO(2)),
            ("new", "marketing_sms", "objection", AGO(1)),
            ("ghost", "marketing_sms", "withdrawal", AGO(1)),
        ],
        "customer_id string, purpose string, kind string, at timestamp_ntz",
    )
    out = consent.apply_events(people, events)
    got = {(r.customer_id, r.purpose): r for r in out.collect()}
    assert not got[("valid", "marketing_email")].opt_in and got[("valid", "marketing_email")].withdrawn_at == AGO(1)
    new = got[("new", "marketing_sms")]
    assert (new.opt_in, new.objection_at, new.consent_source) == (False, AGO(1), "demande_personne_concernee")
    assert ("ghost", "marketing_sms") not in got
    assert out.count() == people.count() + 1


def test_text_dates_become_utc(spark):
    df = spark.createDataFrame([("2026-01-01 10:00:00+02:00",), ("2026-01-01 10:00:00",), ("soon",), (None,)], "d string")
    got = [r.x for r in df.select(naive_utc(F.col("d"), "string").alias("x")).collect()]
    assert got == [dt.datetime(2026, 1, 1, 8), dt.datetime(2026, 1, 1, 10), None, None]


# -------------------------------------------------------------------- privacy


@pytest.mark.parametrize("key", [b"k", b"x" * 64, b"y" * 100])
def test_pseudonym_is_hmac(spark, key):
    out = privacy.pseudonymize(spark.createDataFrame([("CUST_é",)], "customer_id string"), key).first()[0]
    assert out == "PSD_" + hmac.new(key, "CUST_é".encode(), hashlib.sha256).hexdigest()[:32]


def test_key_is_required(spark):
    with pytest.raises(ValueError):
        privacy.pseudonymize(spark.createDataFrame([("a",)], "customer_id string"), b"")


def test_minimise(spark):
    df = spark.createDataFrame([("a", "m", "p", 1.0)], "customer_id string, Email string, phone string, total double")
    out, record = privacy.minimize(df, b"k")
    assert out.columns == ["customer_id", "total"]
    assert record == {"dropped_identifiers": ["Email", "phone"], "forbidden_found": [], "pseudonymized": True}
    with pytest.raises(privacy.SpecialCategoryError):
        privacy.minimize(spark.createDataFrame([("a", "x")], "customer_id string, Health string"))


def test_k_anonymity_counts_null_groups(spark):
    df = spark.createDataFrame([("p", 30)] * 9 + [(None, 99)], "ville string, age int")
    r = privacy.k_anonymity(df, ["ville", "age", "absent"], 5).first()
    assert (r.k_observed, r.groups_under_k, r.persons_exposed, r.compliant) == (1, 1, 1, False)
    assert not privacy.k_anonymity(df, ["absent"]).first().applicable


def test_fingerprint_ignores_order_but_not_content_or_names(spark):
    def of(data, schema="x int, y string"):
        return privacy.data_fingerprint(spark.createDataFrame(data, schema)).first().fingerprint

    base = of([(1, "a"), (2, "b"), (2, "b")])
    assert of([(2, "b"), (1, "a"), (2, "b")]) == base
    assert len({base, of([(1, "a"), (2, "b")]), of([(1, "a"), (2, "b"), (2, "c")]), of([(1, "a"), (2, "b"), (2, "b")], "x int, z string")}) == 4


# ---------------------------------------------------------- retention, erasure


def test_retention_keeps_rows_without_a_date(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1), 1), (dt.datetime(2025, 6, 1), 2), (None, 3)], "d timestamp_ntz, v int")
    as_of = dt.datetime(2026, 1, 1)
    assert sorted(r.v for r in retention.retention_purge(df, "d", 1095, as_of).collect()) == [2, 3]
    assert retention.retention_trace(df, "d", 1095, as_of, "t").first().rows_purged == 1
    with pytest.raises(KeyError):
        retention.retention_purge(df, "nope", 1, as_of)


def test_erasure(spark):
    tx = spark.createDataFrame([("C1", 1), ("C1", 2), ("C2", 3)], "customer_id string, v int")
    other = spark.createDataFrame([(1,)], "x int")
    gone = spark.createDataFrame([("C1", None), ("C1", "v1")], "customer_id string, processed_in_model_version string")
    kept = retention.erase_customers({"tx": tx, "other": other}, gone)
    assert ids(kept["tx"]) == {"C2"} and kept["other"].count() == 1
    assert dict(rows(retention.erasure_trace({"tx": tx, "other": other}, gone))) == {"tx": 2, "other": 0}
    assert retention.pending_erasures(gone).first().pending == 1
    assert retention.pending_erasures(gone.drop("processed_in_model_version")).first().pending == 2
    assert retention.pending_erasures(None).first().pending == 0


# -------------------------------------------------------------------- journal


def entries(spark, n=5, ids=("j",)):
    data = [(j, i, "t%02d" % i, "run", "churn_scoring", "success", i * 10) for j in ids for i in range(n)]
    return spark.createDataFrame(data, "journal_id string, i int, timestamp string, event string, purpose string, outcome string, rows int")


def test_journal_chain_and_tampering(spark):
    lines = journal.append(entries(spark, ids=("j", "k")), ["i"], details=["rows"])
    got = sorted((r.journal_id, r.seq, r.line) for r in lines.collect())
    digest = "0" * 64
    for _, _, line in got[:5]:
        assert json.loads(line)["previous_hash"] == digest
        digest = hashlib.sha256(line.encode()).hexdigest()
    assert {tuple(r) for r in journal.verify(lines).collect()} == {("j", 5, True, None), ("k", 5, True, None)}
    cut = lines.filter("NOT (journal_id = 'j' AND seq = 1)")
    assert {tuple(r) for r in journal.verify(cut).collect()} == {("j", 4, False, 1), ("k", 5, True, None)}
    edited = lines.withColumn("line", F.when((F.col("seq") == 2) & (F.col("journal_id") == "k"), F.replace("line", F.lit("success"), F.lit("failure"))).otherwise(F.col("line")))
    assert {tuple(r) for r in journal.verify(edited).collect()} == {("j", 5, True, None), ("k", 5, False, 3)}


def test_journal_continues_from_its_head(spark):
    whole = journal.append(entries(spark), ["i"])
    first = journal.append(entries(spark).filter("i < 3"), ["i"])
    heads = first.orderBy(F.desc("seq")).limit(1)
    rest = journal.append(entries(spark).filter("i >= 3"), ["i"], heads=heads)
    assert rows(first.unionByName(rest), "seq") == rows(whole, "seq")


def test_journal_files(spark, tmp_path):
    lines = journal.append(entries(spark, 50), ["i"], details=["rows"])
    text = "\n".join(r.line for r in lines.orderBy("seq").collect()) + "\n\n"
    (tmp_path / "a.jsonl").write_text(text, encoding="utf-8")
    back = journal.read_journal_files(spark, str(tmp_path))
    assert [r.seq for r in back.orderBy("seq").collect()] == list(range(50))
    assert journal.verify(back).first().intact
    parsed = journal.read_entries(back).orderBy("seq").collect()
    assert parsed[3].details == {"rows": "30"} and parsed[3].event == "run"


def test_journal_refuses_personal_data(spark):
    nested = spark.createDataFrame([(1,)], "x int").select(F.struct(F.struct(F.lit("e").alias("EMAIL")).alias("a")).alias("details"))
    with pytest.raises(privacy.PersonalDataInJournalError, match="a.EMAIL"):
        privacy.assert_no_personal_data(nested)
    text = spark.createDataFrame([('{"a": [{"Phone" : 1}], "note": "email: x"}',)], "t string")
    assert text.select(privacy.json_forbidden_keys(F.col("t"))).first()[0] == ["phone"]


@pytest.mark.parametrize(
    "text, found",
    [
        ('{"\\u0065mail": 1}', ["email"]),
        ('[{"a": [{"a": 1}, {"a": {"ADDRESS": 2}}, 3]}, "x"]', ["address"]),
        ('{"note": "\\"email\\": x", "x`, phone: ": "email", "mail\\\\": "phone"}', []),
        ('{"first_name": {"last_name": null}}', ["first_name", "last_name"]),
        ('"email"', []),
        ("{broken", None),
        ('{"a": 1, "a": 2}', None),
        (None, None),
    ],
)
def test_forbidden_keys_are_read_as_json(spark, text, found):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(privacy.json_forbidden_keys(F.col("t"))).first()[0] == found


def test_journal_refuses_personal_details(spark):
    df = entries(spark).withColumns({"Email": F.lit("x"), "who": F.struct(F.lit(1).alias("customer_id")), "text": F.lit('{"\\u0070hone": 1}'), "bad": F.lit("[1"), "fine": F.lit("{email}: x".replace("{email}", "email"))})
    for column, message in (("Email", "Email"), ("who", "who.customer_id")):
        with pytest.raises(privacy.PersonalDataInJournalError, match=message):
            journal.append(df, ["i"], details=["rows", column])
    for column, message in (("text", "phone"), ("bad", "unreadable")):
        with pytest.raises(Exception, match=f"personal data in journal: {message}"):
            journal.append(df, ["i"], details=[column]).collect()
    line = json.loads(journal.append(df, ["i"], details=["fine", "rows"], host="h", pid=7).first().line)
    assert list(line) == ["timestamp", "event", "purpose", "outcome", "host", "pid", "previous_hash", "details"]
    assert line["host"] == "h" and line["pid"] == 7 and line["details"] == {"fine": "email: x", "rows": "0"}
    own = json.loads(journal.append(df, ["i"]).first().line)
    assert own["pid"] == os.getpid() and own["host"] and own["details"] == {}


def test_journal_keeps_nulls_and_order(spark):
    df = spark.createDataFrame([("j", i, None if i % 2 else "é\"\n", "e", "p", "o") for i in (3, 1, 2, 0)], "journal_id string, i int, timestamp string, event string, purpose string, outcome string")
    lines = [json.loads(r.line) for r in journal.append(df, ["i"], details=["i"]).orderBy("seq").collect()]
    assert [x["details"]["i"] for x in lines] == ["0", "1", "2", "3"] and [x["timestamp"] for x in lines] == ["é\"\n", None] * 2


# ------------------------------------------------------------------ contracts


def verdicts(df):
    return {r.name: r.passed for r in df.collect()}


def test_transaction_contract(spark):
    good = spark.createDataFrame([("a", at(0), 1.0, "x"), ("b", at(1), 0.0, "y")], TX)
    assert all(verdicts(contracts.contract_transactions(good, at(9))).values())
    bad = spark.createDataFrame([(None, at(0), -1.0, "x"), ("b", None, None, "y"), ("c", at(50), 1.0, "z"), ("c", at(50), 1.0, "z")], TX)
    got = verdicts(contracts.contract_transactions(bad, at(9)))
    assert {k for k, v in got.items() if not v} == {
        "customer_id_present", "dates_parse", "amounts_not_negative", "no_future_order", "few_duplicates",
    }
    with pytest.raises(contracts.ContractError, match="customer_id_present"):
        contracts.raise_if_failed(contracts.contract_transactions(bad, at(9)), "tx")


def test_missing_columns_fail_without_raising(spark):
    got = contracts.contract_transactions(spark.createDataFrame([(1,)], "x int"), at(0))
    failed = {r.name: r.error for r in got.collect() if not r.passed}
    assert "customer_id" in failed["customer_id_present"] and "required_columns" in failed
    with pytest.raises(contracts.ContractError):
        contracts.check_required_columns(spark.createDataFrame([(1,)], "x int"))


def test_text_dates_are_parsed_by_the_contract(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1.0, "x"), ("a", "nope", 1.0, "x")], TX.replace("order_date timestamp_ntz", "order_date string"))
    assert not verdicts(contracts.contract_transactions(df, at(9)))["dates_parse"]


def test_empty_table_fails(spark):
    assert not verdicts(contracts.contract_features(spark.createDataFrame([], "customer_id string, churn int")))["not_empty"]


def test_feature_contract_sees_negative_age_and_repeated_keys(spark):
    df = spark.createDataFrame([("a", 1, -5, 10, 1.0), ("a", 0, 3, 2, 1.0)], "customer_id string, churn int, days_since_last_order int, days_since_first_order int, total_revenue double")
    got = verdicts(contracts.contract_features(df))
    assert not got["recency_not_negative"] and not got["unique_key"] and not got["first_order_before_last"]
    assert got["two_classes"] and got["several_snapshots"]


def test_label_classes(spark):
    def of(*labels):
        got = verdicts(contracts.contract_features(spark.createDataFrame([("a", x) for x in labels], "customer_id string, churn int")))
        return got["label_binary"], got["two_classes"]

    assert of(0, 1, None) == (True, True)
    assert of(1, 1) == (True, False)
    assert of(0, 1, 2) == (False, False)
    assert of(1, 2) == (False, True)


def test_scoring_contract_wants_order_and_finite_values(spark):
    df = spark.createDataFrame([(1.0, float("inf"))], "b double, a double")
    assert verdicts(contracts.contract_scoring(df, ["a", "b"])) == {"schema_as_trained": False, "no_infinite_value": False, "recency_not_negative": True}
    with pytest.raises(scoring.ServedSchemaError):
        check_served_schema(df, ["a", "b"])


def test_user_checks_as_sql_text(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    got = verdicts(contracts.run_expectations(df, [contracts.Expectation("sum", "sum(x) = 3"), contracts.Expectation("max", "max(x) < 2")]))
    assert got == {"sum": True, "max": False}


def test_served_row_rules(spark):
    good = {n: 0.5 if n.endswith(("rate", "rate_30d")) else 1.0 for n in MODEL_FEATURES}
    cases = [good, {**good, "month": 13.0}, {**good, "email_open_rate_30d": 1.5}, {**good, "total_orders": -1.0}, {**good, "avg_days_between_orders": None}, {**good, "month": None}]
    df = spark.createDataFrame([tuple(c[n] for n in MODEL_FEATURES) for c in cases], ", ".join(f"{n} double" for n in MODEL_FEATURES))
    got = [r[0] for r in df.select(F.size(served_row_problems(df))).collect()]
    assert got == [0, 1, 1, 1, 0, 1]
    missing = df.drop("month").select(served_row_problems(df.drop("month"))).first()[0]
    assert missing == ["month: missing"]
    assert set(SERVED_ROW_BOUNDS) < set(MODEL_FEATURES)


# ------------------------------------------------------------------ decisions


@pytest.mark.parametrize(
    "signals,priority,reasons",
    [
        ((0, None, None, None, None), "aucune", []),
        ((1, None, None, None, None), "critique", ["erasure"]),
        ((0, -0.05, None, None, None), "haute", ["performance"]),
        ((0, -0.049, None, None, None), "aucune", []),
        ((0, None, 2, True, None), "haute", ["joint_drift"]),
        ((0, None, 5, False, None), "aucune", []),
        ((0, None, 1, True, None), "aucune", []),
        ((0, None, None, None, 90), "routine", ["age"]),
        ((0, -0.1, 3, True, 100), "haute", ["performance", "joint_drift", "age"]),
        ((2, -0.1, None, None, 100), "critique", ["erasure", "performance", "age"]),
    ],
)
def test_retraining_decision(spark, signals, priority, reasons):
    df = spark.createDataFrame([signals], "erasure_requests int, performance_delta double, features_drifted int, predictions_drifted boolean, model_age_days int")
    r = decisions.retraining_decision(df).first()
    assert (r.priority, r.reasons, r.should_retrain) == (priority, reasons, bool(reasons))


def test_promotion(spark):
    m = spark.createDataFrame([("v1", 0.5), ("v2", 0.4), ("v3", 0.6)], "model_version string, f1 double")
    versus = decisions.compare_to_champion(m, "f1", "v1")
    got = {r.candidate: r.promoted for r in decisions.promotion_verdict(versus, F.lit("haute")).collect()}
    assert got == {"v2": False, "v3": True}
    legal = decisions.promotion_verdict(versus, F.lit("critique")).collect()
    assert all(r.promoted and r.reason == "legal" for r in legal)
    first = decisions.compare_to_champion(m.limit(1), "f1", None)
    assert decisions.promotion_verdict(first, F.lit("routine")).first().promoted


def _history(spark, events):
    df = spark.createDataFrame([("m", v, at(i), k) for i, (k, v) in enumerate(events)], "model_name string, version string, promoted_at timestamp_ntz, kind string")
    history = decisions.production_history(df)
    got = [(r.version, r.promoted_from, r.rollback_to, r.stage) for r in history.orderBy("promoted_at").collect()]
    return got, [(r.current, r.rollback_to) for r in decisions.rollback_target(history).collect()]


def test_production_history(spark):
    e = spark.createDataFrame([("m", "v1", at(0)), ("m", "v2", at(1)), ("m", "v1", at(2))], "model_name string, version string, promoted_at timestamp_ntz")
    history = decisions.production_history(e)
    assert [(r.version, r.promoted_from, r.stage) for r in history.orderBy("promoted_at").collect()] == [
        ("v1", None, "archived"), ("v2", "v1", "archived"), ("v1", "v2", "production"),
    ]
    assert rows(decisions.rollback_target(history)) == [("m", "v1", "v2")]


def test_a_rollback_promotes_again_and_does_not_return(spark):
    up, back = (lambda v: ("promotion", v)), ("rollback", None)
    got, target = _history(spark, [up("v1"), up("v2"), up("v3"), back])
    assert got[-1] == ("v2", "v3", "v1", "production") and target == [("v2", "v1")]
    got, target = _history(spark, [up("v1"), up("v2"), up("v3"), back, back])
    assert got[-1] == ("v1", "v2", None, "production") and target == [("v1", None)]
    got, target = _history(spark, [up("v1"), back, up("v2"), back, up("v4")])
    assert [g[3] for g in got] == ["archived", "refused", "archived", "archived", "production"] and target == [("v4", "v1")]
    got, target = _history(spark, [up("v1"), up("v2"), up("v3"), up("v4"), ("rollback", "v2")])
    assert got[-1] == ("v2", "v4", "v1", "production") and target == [("v2", "v1")]
    assert sum(g[3] == "production" for g in got) == 1
    got, target = _history(spark, [back])
    assert got == [(None, None, None, "refused")] and target == []


# -------------------------------------------------------------- models of other libraries


class Shares:
    """Counts its own loads in a file beside the payload."""

    def __init__(self, log):
        self.log = log

    def __setstate__(self, state):
        self.__dict__ = state
        with open(self.log, "a") as f:
            f.write(f"{os.getpid()}\n")

    def predict_proba(self, frame):
        assert list(frame.columns) == ["a", "b"]
        p = (frame["a"] + frame["b"]).to_numpy() / 10
        return [[1 - x, x] for x in p]


def test_a_model_of_another_library(spark, tmp_path):
    data = [(str(i), float(i % 5), None if i % 3 else 1.0) for i in range(300)]
    df = spark.createDataFrame(data, "customer_id string, a double, b double").repartition(12)
    log = str(tmp_path / "loads")
    model = scoring.OutsideModel.of(Shares(log), "x1", ["a", "b"])
    out = scoring.score_batch(df, model, 0.35, F.lit(at(0).isoformat(sep=" ")).cast("timestamp_ntz"))
    got = {r.customer_id: (r.churn_proba, r.predicted_churn, r.model_version) for r in out.collect()}
    assert got == {i: (round((a + (b or 0)) / 10, 4), int((a + (b or 0)) / 10 >= 0.35), "x1") for i, a, b in data}
    with open(log) as f:
        loads = f.read().split()
    assert len(loads) == len(set(loads)) > 0  # once a worker process, whatever the number of tasks
    with pytest.raises(scoring.ServedSchemaError):
        scoring.score_batch(df.select("customer_id", "b", "a"), model, 0.5, F.current_timestamp())


def test_a_model_too_large_to_send(monkeypatch):
    monkeypatch.setattr(scoring, "MAX_MODEL_BYTES", 10)
    with pytest.raises(ValueError, match="too large"):
        scoring.OutsideModel("x", b"0" * 11, ("a",))


def test_cohort_must_be_mature(spark):
    scores = spark.createDataFrame([("a", 0.9, at(0)), ("b", 0.1, at(31))], "customer_id string, churn_proba double, scored_at timestamp_ntz")
    outcomes = spark.createDataFrame([("a", 1), ("b", 0)], "customer_id string, churn int")
    assert ids(monitoring.evaluation_cohort(scores, outcomes, at(60))) == {"a"}
    with pytest.raises(monitoring.CohortNotMatureError):
        monitoring.evaluation_cohort(scores, outcomes, at(29), require=True)


def test_splits_need_enough_dates(spark):
    df = spark.createDataFrame([(at(i),) for i in range(4)], "snapshot_date timestamp_ntz")
    assert [r.split for r in splits.split_by_snapshot(df).orderBy("snapshot_date").collect()] == ["train", "val", "test", "test"]
    with pytest.raises(splits.TooFewSnapshotsError):
        splits.split_by_snapshot(df.limit(3))


def test_time_series_split_clips_month_ends(spark):
    days = [dt.datetime(2024, 5, 31), dt.datetime(2024, 2, 29), dt.datetime(2024, 2, 28), dt.datetime(2023, 2, 28), dt.datetime(2023, 2, 27)]
    df = spark.createDataFrame([(d,) for d in days], "order_date timestamp_ntz")
    got = {r.order_date: r.split for r in splits.time_series_split(df).collect()}
    assert got == {days[0]: "test", days[1]: "test", days[2]: "train", days[3]: "train"}


def test_feature_build_needs_a_registry_and_a_clean_input(spark):
    tx = spark.createDataFrame([("a", at(0), -1.0, "x")], TX)
    with pytest.raises(feature_build.MissingConsentError):
        feature_build.build_features(tx, None)
    with pytest.raises(contracts.ContractError):
        feature_build.build_features(tx, registry(spark, ("a", "churn_scoring", False)))


def test_plugged_in_score_column(spark):
    df = spark.createDataFrame([("a", 0.7), ("b", 0.69999), ("c", 0.4)], "customer_id string, p double")
    out = scoring.score_batch(df, F.col("p"), 0.6, F.lit(NOW), model_version="outside")
    assert [(r.churn_proba, r.risk_level, r.predicted_churn) for r in out.orderBy("customer_id").collect()] == [
        (0.7, "eleve", 1), (0.7, "moyen", 1), (0.4, "moyen", 0),
    ]
    assert LINEAR_V1.version == "v0001"
