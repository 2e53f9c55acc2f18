"""SQL for the queries in ``state_queries``: what one pass over the whole tables gives."""

from __future__ import annotations

from sparkvigil.checks.ml_oracle import HISTORY, run
from sparkvigil.checks.oracle import ORACLES, tx

ADVANCED = run(f"""
SELECT transaction_id,
       coalesce(n + row_number() OVER (PARTITION BY known_id ORDER BY transaction_timestamp, transaction_id), 10)
         AS customer_transaction_count,
       coalesce(frauds, 0) AS customer_fraud_count
FROM batch LEFT JOIN ({HISTORY}) h ON h.customer_id = known_id""")

# A label of the first third of the time is known at once, any other 36 hours later.
LATE_LABELS = tx("""
, cut AS (SELECT *, epoch_us(transaction_timestamp) AS us, min(epoch_us(transaction_timestamp)) OVER () AS low,
                 max(epoch_us(transaction_timestamp)) OVER () AS high FROM tx),
 r AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY transaction_timestamp, transaction_id) AS nth,
              us - low < (high - low) // 3 + 1 AS old FROM cut),
 seen AS (
   SELECT a.customer_id, a.transaction_id, b.nth, a.nth AS own,
          CASE WHEN b.nth < a.nth AND (b.old OR b.transaction_timestamp + INTERVAL 36 HOUR < a.transaction_timestamp)
               THEN b.is_fraud END AS label
   FROM r a JOIN r b ON b.customer_id = a.customer_id AND b.nth <= a.nth WHERE NOT a.old)
SELECT customer_id, transaction_id,
       round(coalesce(avg(label) FILTER (nth >= own - 100), 0), 6) AS customer_fraud_rate,
       max(own) AS customer_transaction_count, CAST(coalesce(sum(label), 0) AS BIGINT) AS customer_fraud_count
FROM seen GROUP BY customer_id, transaction_id""")

STATE_ORACLES: dict[str, str] = {
    "stream_history": ORACLES["customer_history"],
    "stream_late_labels": LATE_LABELS,
    "stream_rejects": ORACLES["batch_rejects"],
    "stream_folded": ORACLES["score_stream"],
    "shuffled_rows": tx("SELECT transaction_id, amount, true AS order_is_random FROM tx"),
    "batch_contract": tx("""
SELECT column_name, CASE WHEN needed THEN true END AS refused,
       CASE WHEN NOT needed THEN (SELECT count(*) FROM tx) END AS rows_without, true AS template_has_it
FROM (VALUES ('customer_id', false), ('transaction_id', false), ('transaction_timestamp', true), ('amount', true),
             ('merchant_category', true)) c(column_name, needed)"""),
    "serving_history": ADVANCED,
    "serving_history_split": ADVANCED,
    "artifact_versions": run("""
SELECT step, CAST(version AS INTEGER) AS version, CAST(3 AS INTEGER) AS models,
       CASE WHEN step = 'saved without history' THEN 0 ELSE (SELECT count(DISTINCT customer_id) FROM known) END AS profile_rows,
       (SELECT count(DISTINCT merchant_category) FROM tx) AS categories
FROM (VALUES ('saved', 1), ('broken off', 1), ('saved without history', 2), ('first again', 1)) s(step, version)"""),
    "snapshot_profile": ORACLES["customer_profile"],
    "snapshot_merchants": ORACLES["merchant_stats"],
    "stored_quantiles": tx("""
SELECT merchant_category, count(*) AS row_count, true AS q25_holds, true AS q50_holds, true AS q75_holds
FROM tx GROUP BY merchant_category"""),
    "stored_preprocessing": tx("""
SELECT count(*) AS row_count, true AS low_holds, true AS high_holds, count(DISTINCT merchant_category) AS categories
FROM tx"""),
    "history_bucketed": ORACLES["customer_history"],
    "join_bucketed": ORACLES["join_customers"],
}
