"""Window-shaped operators: gaps, running state, terciles, chains, timelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import common as c
from queries.aggregations import RFM
from queries.sources import journal_lines
from tidemark.operators import features as feat, insights, journal, roi as returns
from tidemark.session import materialize
from tidemark.sources import star


def order_gaps(spark, sf):
    return feat.order_gaps(c.tx(spark, sf))


def order_gaps_events(spark, sf):
    """Gaps between sub-day instants: elapsed days, not calendar days."""
    return feat.order_gaps(star.event_transactions(spark, sf))


def running_customer_state(spark, sf):
    return feat.running_state(c.tx(spark, sf), c.CFG)


def rfm_scores(spark, sf):
    return insights.rfm_scores(c.features(spark, sf, "latest")).select(
        "customer_id", "R_score", "F_score", "M_score"
    )


def rfm_segments(spark, sf):
    return insights.rfm_segments(insights.rfm_scores(c.features(spark, sf, "latest"))).select(
        "customer_id", "RFM_segment", "segment_name"
    )


def verify_journal(spark, sf):
    """Journals whose urgent entries were removed after writing."""
    lines = materialize(journal_lines(spark, sf), "journal")
    tampered = lines.filter(F.get_json_object("line", "$.details.priority") != "1-URGENT")
    return journal.verify(tampered)


def verify_journal_intact(spark, sf):
    return journal.verify(materialize(journal_lines(spark, sf), "journal"))


def roi_timeline(spark, sf):
    return returns.roi_timeline(c.scores(spark, sf, "latest"))


QUERIES = {
    f.__name__: f
    for f in (
        order_gaps,
        order_gaps_events,
        running_customer_state,
        rfm_scores,
        rfm_segments,
        verify_journal,
        verify_journal_intact,
        roi_timeline,
    )
}

H = c.half_even


def _gaps(table: str) -> str:
    return f"""SELECT customer_id, count(*) AS orders, avg(gap) AS avg_days_between_orders FROM (
  SELECT customer_id, date_sub('day', lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date), order_date) AS gap FROM {table})
GROUP BY customer_id"""


#: The journal rewritten as SQL: each line needs the digest of the one before it.
CHAIN = """numbered AS (
  SELECT o_custkey AS journal_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS seq,
         '{"timestamp":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '","event":"order","purpose":"churn_scoring","outcome":"'
           || o_orderstatus || '","host":"spark","pid":1,"previous_hash":"' AS head,
         '","details":{"order_id":"' || o_orderkey || '","priority":"' || o_orderpriority || '"}}' AS tail,
         o_orderpriority AS priority
  FROM orders),
chain AS (
  SELECT journal_id, seq, priority, head || repeat('0', 64) || tail AS line FROM numbered WHERE seq = 0
  UNION ALL
  SELECT n.journal_id, n.seq, n.priority, head || sha256(chain.line) || tail FROM chain JOIN numbered n
    ON n.journal_id = chain.journal_id AND n.seq = chain.seq + 1)"""

_VERIFY = """SELECT journal_id, count(*) AS entries, min(n) FILTER (broken) IS NULL AS intact, min(n) FILTER (broken) AS first_break
FROM (SELECT journal_id, n, regexp_extract(line, '"previous_hash":"([0-9a-f]*)"', 1)
             <> coalesce(sha256(lag(line) OVER (PARTITION BY journal_id ORDER BY n)), repeat('0', 64)) AS broken
      FROM (SELECT journal_id, line, row_number() OVER (PARTITION BY journal_id ORDER BY seq) - 1 AS n FROM chain {where}))
GROUP BY journal_id"""


def recursive(*parts: str, select: str) -> str:
    return c.sql(*parts, select=select).replace("WITH ", "WITH RECURSIVE ", 1)


ORACLES = {
    "order_gaps": c.sql(c.TX, select=_gaps("tx")),
    "order_gaps_events": c.sql(c.TX_EVENTS, select=_gaps("txe")),
    "running_customer_state": c.sql(
        c.TX,
        select="""SELECT DISTINCT customer_id, order_date, count(*) OVER w AS orders_so_far,
       CAST(sum(CAST(order_value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS revenue_so_far,
       CAST(sum(CAST(order_value AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(order_value) OVER w AS avg_value_so_far,
       max(order_value) OVER w AS max_value_so_far, min(order_date) OVER w AS first_order_date
FROM tx WINDOW w AS (PARTITION BY customer_id ORDER BY order_date RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ),
    "rfm_scores": c.sql(*c.BASE, c.FEATS_LAST, RFM, select="SELECT customer_id, R_score, F_score, M_score FROM rfm"),
    "rfm_segments": c.sql(
        *c.BASE, c.FEATS_LAST, RFM, select="SELECT customer_id, code AS RFM_segment, segment_name FROM segments"
    ),
    "verify_journal": recursive(CHAIN, select=_VERIFY.format(where="WHERE priority <> '1-URGENT'")),
    "verify_journal_intact": recursive(CHAIN, select=_VERIFY.format(where="")),
    "roi_timeline": c.sql(
        *c.BASE,
        c.FEATS_LAST,
        c.scores_sql(c.V1),
        "base AS (SELECT *, CAST(floor(k * 0.65::DOUBLE) AS BIGINT) AS saved FROM (SELECT count(*) AS n, count(*) FILTER (churn_proba >= 0.7) AS k FROM scores))",
        f"""line AS (SELECT CAST(m AS INT) AS month, least(1.0::DOUBLE, m / 6.0::DOUBLE) AS ramp, saved * 1000.0::DOUBLE / 12.0::DOUBLE AS gain,
          k * 15.0::DOUBLE / 12.0::DOUBLE AS cost, 0.18::DOUBLE * (saved / n) AS reduction FROM base, (SELECT unnest(range(1, 13)) AS m))""",
        f"""sums AS (SELECT month, 'M' || month AS month_label, {H('0.18::DOUBLE - reduction * ramp', 6)} AS churn_rate,
          {H('gain * ramp', 4)} AS monthly_revenue_saved,
          {H('sum(gain * ramp) OVER (ORDER BY month)', 4)} AS cumulative_revenue_saved,
          {H('25000.0::DOUBLE + sum(cost) OVER (ORDER BY month)', 4)} AS cumulative_cost FROM line)""",
        select=f"""SELECT *, {H('cumulative_revenue_saved - cumulative_cost', 4)} AS net_benefit,
       {H('(cumulative_revenue_saved - cumulative_cost) / 25000.0::DOUBLE * 100', 4)} AS roi FROM sums""",
    ),
}
