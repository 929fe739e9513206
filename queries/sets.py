"""Set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import common as c
from queries.ranking import _EMAIL, _LAST_SCORES
from tidemark.operators import consent, features as feat, targeting
from tidemark.sources import star


def stack_snapshots(spark, sf):
    """The table of all but the last date, with the last date appended."""
    at = c.dates(spark, sf)
    old = feat.snapshot_dataset(c.tx(spark, sf), at[:-1], c.CFG)
    return feat.append_snapshot(old, c.features(spark, sf, "latest"))


def scorable_except(spark, sf):
    people = c.tx(spark, sf).select("customer_id").distinct()
    return consent.eligible_for_scoring(people, star.consent_registry(spark, sf), c.as_of(spark, sf))


def contactable_intersect(spark, sf):
    """Scored customers at high risk who may be written to."""
    risky = c.scores(spark, sf, "latest").filter(F.col("risk_level") == "eleve").select("customer_id")
    return consent.eligible_for_targeting(
        risky, star.consent_registry(spark, sf), "marketing_email", c.as_of(spark, sf)
    )


def score_vs_contact_gap(spark, sf):
    """Scored, contactable and excluded customers for each channel."""
    scores = c.scores(spark, sf, "latest")
    registry, at = star.consent_registry(spark, sf), c.as_of(spark, sf)
    one = targeting.targeting_trace(scores, registry, "marketing_email", at)
    two = targeting.targeting_trace(scores, registry, "marketing_sms", at)
    return one.unionByName(two).select("purpose", "scored", "consenting", "excluded_without_consent")


QUERIES = {
    f.__name__: f for f in (stack_snapshots, scorable_except, contactable_intersect, score_vs_contact_gap)
}

ORACLES = {
    "stack_snapshots": c.sql(*c.BASE, c.FEATS, select="SELECT * FROM feats"),
    "scorable_except": c.sql(
        c.TX,
        c.CONSENT,
        c.OBJECTED,
        select="SELECT customer_id FROM tx EXCEPT SELECT customer_id FROM objected WHERE purpose = 'churn_scoring'",
    ),
    "contactable_intersect": c.sql(
        *_LAST_SCORES,
        select="""SELECT customer_id FROM scores WHERE risk_level = 'eleve'
INTERSECT SELECT customer_id FROM opted_in WHERE purpose = 'marketing_email'""",
    ),
    "score_vs_contact_gap": c.sql(
        *_LAST_SCORES,
        select=" UNION ALL ".join(
            f"""SELECT '{p}' AS purpose, count(*) AS scored, count(*) FILTER ({_EMAIL.replace('marketing_email', p)}) AS consenting,
       count(*) FILTER (NOT ({_EMAIL.replace('marketing_email', p)})) AS excluded_without_consent FROM scores"""
            for p in ("marketing_email", "marketing_sms")
        ),
    ),
}
