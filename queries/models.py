"""Training, scoring and life-cycle decisions."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from queries import common as c
from queries.aggregations import BY, ECONOMICS, _both_models, _CONFUSION, _DRIFT_ROWS, _F1, _MODELS, drift_sql
from queries.sources import journal_lines
from queries.windows import CHAIN, recursive
from tidemark.operators import decisions, metrics, roi as returns, scoring
from tidemark.plans import feature_build, monitoring, scoring_run, training
from tidemark.schemas import MODEL_FEATURES
from tidemark.session import materialize
from tidemark.sources import star


def train_model(spark, sf):
    """Quality and lift per split of a tree ensemble with early stopping, and the record of the run: threshold, gap, best iteration."""
    return training.train_model(c.features(spark, sf), dates=c.dates(spark, sf)).metrics


def train_legacy(spark, sf):
    return training.train_legacy(c.features(spark, sf), dates=c.dates(spark, sf)).metrics


def feature_importance(spark, sf):
    return training.train_model(c.features(spark, sf), tune=False, dates=c.dates(spark, sf), report=False).importance


def score_batch(spark, sf):
    return c.scores(spark, sf).drop("churn")


class _Logistic:
    """A model as other libraries make them: ``predict_proba`` of a frame of features, one column a class."""

    def __init__(self, model: scoring.LinearScorer, features):
        self.intercept = model.intercept
        self.weights = [model.weights.get(f, 0.0) for f in features]

    def predict_proba(self, frame):
        z = np.full(len(frame), self.intercept)
        for name, weight in zip(frame.columns, self.weights):
            z = z + weight * frame[name].to_numpy()
        p = 1.0 / (1.0 + np.exp(-z))
        return np.column_stack([1 - p, p])


def score_outside_model(spark, sf):
    model = scoring.OutsideModel.of(_Logistic(c.V1, MODEL_FEATURES), c.V1.version, MODEL_FEATURES)
    return scoring.score_batch(c.features(spark, sf, "latest"), model, c.THRESHOLD, F.col("snapshot_date"), keep=["snapshot_date"])


def run_scoring(spark, sf):
    """The contact list of the whole scoring chain."""
    run = scoring_run.run_scoring(
        c.features(spark, sf, "latest"),
        c.V1,
        MODEL_FEATURES,
        c.THRESHOLD,
        star.consent_registry(spark, sf),
        c.as_of(spark, sf),
        max_contacts=2000,
    )
    return run.targeting


def champion_challenger(spark, sf):
    quality = metrics.classification_metrics(_both_models(spark, sf), BY, c.THRESHOLD)
    return decisions.compare_to_champion(quality, "f1", "v0001")


def _signals(spark, sf):
    """One row of signals per order year, drawn from the orders of that year."""
    year = F.year("o_orderdate")
    yearly = star.table(spark, sf, "orders").groupBy(year.alias("year")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        F.count_if((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 499000)).alias("erasure_requests"),
    )
    share = F.col("f") / F.col("n")
    return yearly.select(
        "year",
        "erasure_requests",
        F.when(F.col("year") != 1997, (F.col("n") % 7 - 5).cast("double") / 20).alias("performance_delta"),
        (F.col("n") % 4).cast("int").alias("features_drifted"),
        (share > 0.33).alias("predictions_drifted"),
        ((F.lit(2001) - F.col("year")) * 40).cast("int").alias("model_age_days"),
    )


def retraining_decision(spark, sf):
    out = decisions.retraining_decision(_signals(spark, sf))
    return out.withColumn("reasons", F.concat_ws(",", "reasons"))


def promotion_verdict(spark, sf):
    quality = metrics.classification_metrics(_both_models(spark, sf), BY, c.THRESHOLD)
    comparison = decisions.compare_to_champion(quality, "f1", "v0001")
    routine = decisions.promotion_verdict(comparison, F.lit("routine"))
    return routine.unionByName(decisions.promotion_verdict(comparison, F.lit("critique")))


def production_history(spark, sf):
    """Promotions of one model per order priority: a new version with each year of orders; rolled back after 1997, and twice after 1999."""
    yearly = star.table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("model_name"), F.year("o_orderdate").alias("year")
    ).agg(F.max("o_orderdate").alias("at"))
    backs = F.when(F.col("year") == 1997, 1).when(F.col("year") == 1999, 2).otherwise(0)
    events = yearly.select(
        "model_name",
        F.explode(F.sequence(F.lit(0), backs)).alias("k"),
        F.concat(F.lit("v"), F.col("year").cast("string")).alias("version"),
        "at",
    )
    back = F.col("k") > 0
    return decisions.production_history(
        events.select(
            "model_name",
            F.when(~back, F.col("version")).alias("version"),
            (F.col("at") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("k"))).alias("promoted_at"),
            F.when(back, "rollback").otherwise("promotion").alias("kind"),
        )
    )


def rollback_target(spark, sf):
    return decisions.rollback_target(production_history(spark, sf))


def campaign_net_value(spark, sf):
    return metrics.campaign_value(_both_models(spark, sf), BY, c.THRESHOLD)


def roi_scenarios(spark, sf):
    return returns.roi_scenarios(c.scores(spark, sf, "latest"))


def monitoring_report(spark, sf):
    """Drift, scores, matured performance and decision between the first and last snapshot."""
    table = materialize(c.features(spark, sf, "ends"), "ends")
    reference, current = feature_build.reference_and_current(table)
    score = lambda df: scoring.score_batch(df, c.V1, c.THRESHOLD, F.col("snapshot_date"), keep=["churn"])
    report = monitoring.monitoring_report(
        reference,
        current,
        score(reference),
        score(current),
        score(current),
        model_age_days=120,
        baseline_f1=0.9,
        threshold=c.THRESHOLD,
        erasures=star.erasure_requests(spark, sf),
    )
    return report.withColumn("reasons", F.concat_ws(",", "reasons"))


def compliance_checks(spark, sf):
    return monitoring.compliance_checks(
        materialize(journal_lines(spark, sf), "journal"), star.consent_registry(spark, sf), star.erasure_requests(spark, sf), c.as_of(spark, sf)
    )


def build_features(spark, sf):
    """The whole chain from raw orders: contract, retention, legal basis, minimisation, replay, contract."""
    from tidemark.session import scratch_path

    built = feature_build.build_features(
        c.tx(spark, sf),
        star.consent_registry(spark, sf),
        c.CFG,
        output_path=scratch_path(spark, "built"),
        today=dt.datetime(2001, 9, 1),
    )
    return built.traces["snapshots"]


QUERIES = {
    f.__name__: f
    for f in (
        train_model,
        train_legacy,
        feature_importance,
        score_batch,
        score_outside_model,
        run_scoring,
        champion_challenger,
        retraining_decision,
        promotion_verdict,
        production_history,
        rollback_target,
        campaign_net_value,
        roi_scenarios,
        monitoring_report,
        compliance_checks,
        build_features,
    )
}

H = c.half_even
_VERSUS = f"""SELECT b.model_version AS candidate, 'v0001' AS champion, b.f1 AS candidate_value, a.f1 AS champion_value,
       {H('b.f1 - a.f1', 4)} AS gain, b.f1 - a.f1 > 0 AS promote
FROM (SELECT model_version, {H(_F1, 4)} AS f1 FROM ({_CONFUSION})) a, (SELECT model_version, {H(_F1, 4)} AS f1 FROM ({_CONFUSION})) b
WHERE a.model_version = 'v0001' AND b.model_version <> 'v0001'"""
#: The fold as recursion: ``stack`` holds the versions a rollback may still go to.
_HISTORY = """WITH RECURSIVE yearly AS (SELECT o_orderpriority AS model_name, year(o_orderdate) AS y, max(o_orderdate) AS done FROM orders GROUP BY 1, 2),
ev AS (SELECT model_name, CASE WHEN k = 0 THEN 'v' || y END AS version, done + CAST(k AS INT) * INTERVAL 1 MINUTE AS promoted_at, k > 0 AS back,
              row_number() OVER (PARTITION BY model_name ORDER BY done + CAST(k AS INT) * INTERVAL 1 MINUTE) AS i,
              count(*) OVER (PARTITION BY model_name) AS n
       FROM yearly, range(0, 3) r(k) WHERE k = 0 OR (y = 1997 AND k = 1) OR y = 1999),
walk AS (
  SELECT model_name, i, n, version, promoted_at, back, CAST(NULL AS VARCHAR) AS promoted_from, CAST([] AS VARCHAR[]) AS stack FROM ev WHERE i = 1
  UNION ALL
  SELECT e.model_name, e.i, e.n, CASE WHEN e.back THEN w.stack[-1] ELSE e.version END, e.promoted_at, e.back, w.version,
         CASE WHEN e.back THEN w.stack[:-2] ELSE list_append(w.stack, w.version) END
  FROM walk w JOIN ev e ON e.model_name = w.model_name AND e.i = w.i + 1)
SELECT model_name, version, promoted_at, CASE WHEN back THEN 'rollback' ELSE 'promotion' END AS promoted_by, promoted_from, stack[-1] AS rollback_to,
       CASE WHEN i = n THEN 'production' ELSE 'archived' END AS stage FROM walk"""
_SIGNALS = """SELECT CAST(year AS INT) AS year, u AS erasure_requests, CASE WHEN year <> 1997 THEN CAST(n % 7 - 5 AS DOUBLE) / 20 END AS performance_delta,
       CAST(n % 4 AS INT) AS features_drifted, f / n > 0.33 AS predictions_drifted, CAST((2001 - year) * 40 AS INT) AS model_age_days
FROM (SELECT year(o_orderdate) AS year, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f,
             count(*) FILTER (o_orderpriority = '1-URGENT' AND o_totalprice > 499000) AS u FROM orders GROUP BY 1)"""

ORACLES = {
    "score_batch": c.sql(*c.BASE, c.FEATS, c.scores_sql(c.V1), select="SELECT * EXCLUDE (churn) FROM scores"),
    "run_scoring": c.sql(
        *c.BASE,
        c.FEATS_LAST,
        c.scores_sql(c.V1),
        c.CONSENT,
        c.OPTED_IN,
        select="""SELECT * EXCLUDE (churn, snapshot_date) REPLACE ((SELECT max(order_date) FROM tx) AS scored_at),
       'marketing_email' AS canal, 'consentement' AS base_legale
FROM scores WHERE customer_id IN (SELECT customer_id FROM opted_in WHERE purpose = 'marketing_email')
ORDER BY churn_proba DESC, customer_id LIMIT 2000""",
    ),
    "champion_challenger": c.sql(*_MODELS, select=_VERSUS),
    "retraining_decision": f"""SELECT *, should, CASE WHEN e THEN 'critique' WHEN w OR m THEN 'haute' WHEN o THEN 'routine' ELSE 'aucune' END AS priority,
       concat_ws(',', CASE WHEN e THEN 'erasure' END, CASE WHEN w THEN 'performance' END, CASE WHEN m THEN 'joint_drift' END, CASE WHEN o THEN 'age' END) AS reasons
FROM (SELECT *, e OR w OR m OR o AS should FROM (SELECT *, erasure_requests > 0 AS e, coalesce(performance_delta <= -0.05, false) AS w,
      features_drifted >= 2 AND predictions_drifted AS m, model_age_days >= 90 AS o FROM ({_SIGNALS})))""".replace(
        "SELECT *, should,", "SELECT * EXCLUDE (e, w, m, o, should), should AS should_retrain,", 1
    ),
    "promotion_verdict": c.sql(
        *_MODELS,
        f"versus AS ({_VERSUS})",
        select="""SELECT *, 'routine' AS priority, promote AND gain > 0 AS promoted,
       CASE WHEN promote AND gain > 0 THEN 'gain' ELSE 'insufficient_gain' END AS reason FROM versus
UNION ALL SELECT *, 'critique', true, 'legal' FROM versus""",
    ),
    "score_outside_model": c.sql(*c.BASE, c.FEATS_LAST, c.scores_sql(c.V1), select="SELECT * EXCLUDE (churn) FROM scores"),
    "production_history": _HISTORY,
    "rollback_target": f"SELECT model_name, version AS current, rollback_to FROM ({_HISTORY}) WHERE stage = 'production'",
    "campaign_net_value": c.sql(
        *_MODELS,
        select=f"""SELECT model_version, tp + fp AS contacted, tp AS true_positives,
       {H('tp * 0.3::DOUBLE * 1000.0::DOUBLE * 0.25::DOUBLE - (tp + fp) * 27.0::DOUBLE', 2)} AS net_value FROM ({_CONFUSION})""",
    ),
    "roi_scenarios": c.sql(
        *c.BASE,
        c.FEATS_LAST,
        c.scores_sql(c.V1),
        select=ECONOMICS.format(
            extra="scenario, success AS success_rate, ",
            cases="(SELECT unnest(['optimistic', 'realistic', 'pessimistic']) AS scenario, unnest([0.8, 0.65, 0.5]::DOUBLE[]) AS success)",
        ),
    ),
    "monitoring_report": c.sql(
        *c.BASE,
        c.FEATS_ENDS,
        c.scores_sql(c.V1),
        "both_scores AS (SELECT * FROM scores WHERE snapshot_date = (SELECT max(t) FROM snap))",
        f"d AS (WITH {drift_sql(MODEL_FEATURES)} SELECT count(*) AS features_analysed, count(*) FILTER (drifted) AS features_drifted, bool_or(drifted) AS drift_detected, max(psi) AS psi_max FROM ({_DRIFT_ROWS}))",
        f"p AS (WITH {drift_sql(['churn_proba'], 'scores')} SELECT {H('psi', 4)} AS psi_predictions, coalesce(psi >= 0.2, false) AS predictions_drifted FROM psi)",
        f"e AS (SELECT model_version, n AS rows, {H(_F1, 4)} AS f1, {H(H(_F1, 4) + ' - 0.9::DOUBLE', 4)} AS performance_delta FROM ({_CONFUSION}))",
        "r AS (SELECT count(*) AS erasure_requests FROM customer WHERE c_custkey % 97 = 0 AND c_custkey % 2 = 0)",
        select="""SELECT *, 120 AS model_age_days, true AS should_retrain,
       CASE WHEN erasure_requests > 0 THEN 'critique' WHEN performance_delta <= -0.05 OR (features_drifted >= 2 AND predictions_drifted) THEN 'haute' ELSE 'routine' END AS priority,
       concat_ws(',', CASE WHEN erasure_requests > 0 THEN 'erasure' END, CASE WHEN performance_delta <= -0.05 THEN 'performance' END,
                 CASE WHEN features_drifted >= 2 AND predictions_drifted THEN 'joint_drift' END, 'age') AS reasons
FROM d, p, e, r""",
    ),
    "compliance_checks": recursive(
        CHAIN,
        c.CONSENT,
        c.OPTED_IN,
        c.OBJECTED,
        select="""SELECT 'broken_journals' AS "check", CAST(count(*) AS BIGINT) AS value FROM (
    SELECT DISTINCT journal_id FROM (SELECT journal_id, regexp_extract(line, '"previous_hash":"([0-9a-f]*)"', 1)
      <> coalesce(sha256(lag(line) OVER (PARTITION BY journal_id ORDER BY seq)), repeat('0', 64)) AS broken FROM chain) WHERE broken)
UNION ALL SELECT 'journal_entries', count(*) FROM chain
UNION ALL SELECT 'pending_erasures', count(*) FROM customer WHERE c_custkey % 97 = 0 AND c_custkey % 2 = 0
UNION ALL SELECT 'valid_opt_ins_' || purpose, (SELECT count(*) FROM opted_in o WHERE o.purpose = p.purpose) FROM purposes p
UNION ALL SELECT 'objections_' || purpose, (SELECT count(*) FROM objected o WHERE o.purpose = p.purpose) FROM purposes p""",
    ),
    "build_features": c.sql(
        c.TX,
        c.CONSENT,
        c.OBJECTED,
        """kept AS (SELECT * FROM tx WHERE order_date >= (SELECT max(order_date) FROM tx) - INTERVAL 1095 DAY
  AND customer_id NOT IN (SELECT customer_id FROM objected WHERE purpose = 'churn_scoring'))""",
        c.SNAP.replace("FROM tx)", "FROM kept)", 1),
        c.feats_sql(tx="kept"),
        select=f"""SELECT snapshot_date, count(*) AS population, CAST(sum(churn) AS BIGINT) AS leavers,
       {H('sum(churn) / count(*)', 4)} AS churn_rate FROM feats GROUP BY ROLLUP (snapshot_date)""",
    ),
}
