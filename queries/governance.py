"""Consent, privacy, retention and journals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from queries import common as c
from queries.ranking import _LAST_SCORES
from queries.sources import journal_entries, journal_lines
from queries.windows import CHAIN, recursive
from tidemark.operators import consent, journal, privacy
from tidemark.session import materialize
from tidemark.sources import star

#: A key for the comparison with SQL; a real one comes from the caller's secret store.
TEST_KEY = b"tidemark-test-key"
#: Where the journal of the two-batch query is cut.
SPLIT_AT = dt.datetime(1998, 1, 1)


def valid_opt_ins(spark, sf):
    return consent.valid_opt_ins(star.consent_registry(spark, sf), c.as_of(spark, sf))


def valid_opt_ins_worded(spark, sf):
    """Only consents given under one version of the wording."""
    policy = consent.ConsentPolicy(wording_version="v1")
    return consent.valid_opt_ins(star.consent_registry(spark, sf), c.as_of(spark, sf), policy=policy)


def objected_customers(spark, sf):
    return consent.objected(star.consent_registry(spark, sf), c.as_of(spark, sf))


def _events(spark, sf):
    """Error events as objections and signups as withdrawals, for users that may be unknown."""
    kind = F.when(F.col("event_type") == "error", "objection").when(F.col("event_type") == "signup", "withdrawal")
    return (
        star.table(spark, sf, "events")
        .withColumn("kind", kind)
        .filter(F.col("kind").isNotNull())
        .select(
            (F.col("user_id") * 20).alias("customer_id"), F.lit("marketing_email").alias("purpose"), "kind",
            F.col("ts").alias("at"),
        )
    )


def apply_consent_events(spark, sf):
    return consent.apply_events(star.consent_registry(spark, sf), _events(spark, sf))


def pseudonymize(spark, sf):
    return privacy.pseudonymize(c.tx(spark, sf).select("order_id", "customer_id"), TEST_KEY)


def minimize(spark, sf):
    named = star.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"), F.col("c_acctbal").alias("balance")
    )
    return privacy.minimize(named, TEST_KEY)[0]


def minimization_report(spark, sf):
    named = star.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name")
    )
    out, record = privacy.minimize(named, TEST_KEY)
    return out.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(",".join(record["dropped_identifiers"])).alias("dropped_identifiers"),
        F.lit(record["pseudonymized"]).alias("pseudonymized"),
    )


def journal_no_personal_data(spark, sf):
    """Event payloads whose key is renamed to a forbidden one for two kinds of event."""
    payload = F.when(
        F.col("event_type") == "signup",
        F.concat(F.lit(r'{"details": [1, {"\u0045mail": "\"phone\":"}], "more": '), F.col("props"), F.lit("}")),
    ).when(F.col("event_type") == "error", F.regexp_replace("props", '"k"', '"customer_id"')).otherwise(F.col("props"))
    return star.table(spark, sf, "events").select(
        "event_id", F.concat_ws(",", privacy.json_forbidden_keys(payload)).alias("forbidden")
    )


def journal_append(spark, sf):
    return journal_lines(spark, sf)


def journal_append_to_existing(spark, sf):
    """The same chain written in two batches: orders before 1998, then the rest onto the heads."""
    entries = journal_entries(spark, sf)
    old = entries.filter(F.col("at") < c.ntz(SPLIT_AT))
    new = entries.filter(F.col("at") >= c.ntz(SPLIT_AT))
    options = {"order_by": ["at", "order_id"], "details": ["order_id", "priority"], "host": "spark", "pid": 1}
    first = materialize(journal.append(old, **options), "journal")
    heads = first.groupBy("journal_id").agg(F.max("seq").alias("seq"), F.max_by("line", "seq").alias("line"))
    return first.unionByName(journal.append(new, heads=heads, **options))


def data_fingerprint(spark, sf):
    df = c.tx(spark, sf).select("customer_id", "order_id", "product_category", "email_opened")
    return privacy.data_fingerprint(df)


def contactability_by_channel(spark, sf):
    """Valid opt-ins per channel within the scored population."""
    scored = c.scores(spark, sf, "latest").select("customer_id")
    granted = consent.valid_opt_ins(star.consent_registry(spark, sf), c.as_of(spark, sf))
    total = scored.count()
    return (
        granted.join(scored, "customer_id", "left_semi")
        .groupBy("purpose")
        .agg(F.count(F.lit(1)).alias("contactable"))
        .withColumn("scored", F.lit(total).cast("bigint"))
    )


QUERIES = {
    f.__name__: f
    for f in (
        valid_opt_ins,
        valid_opt_ins_worded,
        objected_customers,
        apply_consent_events,
        pseudonymize,
        minimize,
        minimization_report,
        journal_no_personal_data,
        journal_append,
        journal_append_to_existing,
        data_fingerprint,
        contactability_by_channel,
    )
}


def _hmac(message: str) -> str:
    """HMAC-SHA256 over hex text: DuckDB hashes the bytes of a blob."""
    padded = TEST_KEY.ljust(64, b"\0")
    inner = "".join(f"\\x{b ^ 0x36:02X}" for b in padded)
    outer = "".join(f"\\x{b ^ 0x5C:02X}" for b in padded)
    return f"sha256('{outer}'::BLOB || unhex(sha256('{inner}'::BLOB || encode({message}))))"


_PSEUDONYM = "'PSD_' || left(" + _hmac("CAST({id} AS VARCHAR)") + ", 32)"
_CHAIN_SELECT = "SELECT journal_id, seq, line FROM chain"

ORACLES = {
    "valid_opt_ins": c.sql(c.CONSENT, c.OPTED_IN, select="SELECT purpose, customer_id FROM opted_in"),
    "valid_opt_ins_worded": c.sql(
        c.CONSENT,
        c.OPTED_IN.replace("WHERE opt_in", "WHERE consent_wording_version = 'v1' AND opt_in"),
        select="SELECT purpose, customer_id FROM opted_in",
    ),
    "objected_customers": c.sql(c.CONSENT, c.OBJECTED, select="SELECT purpose, customer_id FROM objected"),
    "apply_consent_events": c.sql(
        c.CONSENT,
        """ev AS (SELECT user_id * 20 AS customer_id, 'marketing_email' AS purpose,
  max(ts) FILTER (event_type = 'error') AS o, max(ts) FILTER (event_type = 'signup') AS w
  FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1)""",
        select="""SELECT customer_id, purpose, opt_in AND w IS NULL AS opt_in, consent_date, consent_source, consent_wording_version,
       coalesce(w, withdrawn_at) AS withdrawn_at, coalesce(o, objection_at) AS objection_at
FROM consent LEFT JOIN ev USING (customer_id, purpose)
UNION ALL
SELECT customer_id, purpose, false, NULL, 'demande_personne_concernee', NULL, NULL, o
FROM ev ANTI JOIN consent USING (customer_id, purpose) WHERE o IS NOT NULL""",
    ),
    "pseudonymize": "SELECT o_orderkey AS order_id, " + _PSEUDONYM.format(id="o_custkey") + " AS customer_id FROM orders",
    "minimize": "SELECT " + _PSEUDONYM.format(id="c_custkey") + " AS customer_id, c_acctbal AS balance FROM customer",
    "minimization_report": "SELECT count(*) AS rows, 'full_name' AS dropped_identifiers, true AS pseudonymized FROM customer",
    "journal_no_personal_data": """SELECT event_id, CASE event_type WHEN 'signup' THEN 'email' WHEN 'error' THEN 'customer_id' ELSE '' END AS forbidden
FROM events""",
    "journal_append": recursive(CHAIN, select=_CHAIN_SELECT),
    "journal_append_to_existing": recursive(CHAIN, select=_CHAIN_SELECT),
    "data_fingerprint": c.sql(
        c.TX,
        """h AS (SELECT CAST('0x' || left(sha256('customer_id=' || customer_id || chr(31) || 'order_id=' || order_id || chr(31)
  || 'product_category=' || product_category || chr(31) || 'email_opened=' || email_opened), 15) AS BIGINT) AS h FROM tx)""",
        select="""SELECT count(*) AS row_count, sha256(count(*) || '|' || CAST(sum(h) AS VARCHAR) || '|' || bit_xor(h)
  || '|customer_id:bigint|order_id:bigint|product_category:string|email_opened:int') AS fingerprint FROM h""",
    ),
    "contactability_by_channel": c.sql(
        *_LAST_SCORES,
        select="""SELECT purpose, count(*) AS contactable, (SELECT count(*) FROM scores) AS scored
FROM opted_in SEMI JOIN scores USING (customer_id) GROUP BY purpose""",
    ),
}
