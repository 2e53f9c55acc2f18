"""SQL for the keys, sizes and promises of the queries in ``ml_queries``."""

from __future__ import annotations

from sparkvigil.checks.oracle import KNOWN, TX, fraction, tx, zscore
from sparkvigil.sources.schemas import FEATURES

FIT_ROWS = 1_000
TREES = "VALUES ('Random Forest'), ('Gradient Boosted Trees')"
MODELS = "VALUES ('Random Forest'), ('Gradient Boosted Trees'), ('Logistic Regression')"
SCENARIO_NAMES = (
    "VALUES ('Normal Transaction'), ('Slightly Suspicious'), ('Highly Suspicious'), ('Your Test Case')"
)

# The rows of the mixed batch that can be read.
BATCH = """
SELECT transaction_id::VARCHAR AS transaction_id,
       CASE transaction_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'C-' || customer_id WHEN 2 THEN 'N/A'
            ELSE customer_id::VARCHAR END AS customer_id,
       CASE WHEN transaction_id % 5 >= 3 THEN customer_id END AS known_id,
       amount, merchant_category, transaction_timestamp
FROM tx WHERE transaction_id % 50 NOT IN (7, 11)"""

TRAIN = f"SELECT * FROM known WHERE {fraction('transaction_id', 'split42')} < 0.8e0"


def run(body: str) -> str:
    return f"WITH tx AS ({TX}), known AS ({KNOWN}), train AS ({TRAIN}), batch AS ({BATCH})\n{body}"


HISTORY = """
SELECT customer_id, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS frauds,
       avg(is_fraud) FILTER (newest <= 100) AS rate
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY transaction_timestamp DESC, transaction_id DESC) AS newest FROM known)
GROUP BY customer_id"""

BALANCED_ROWS = f"""
SELECT CAST(sum(CASE WHEN is_fraud = 1 AND n1 < {FIT_ROWS} THEN floor({FIT_ROWS}e0 / n1)
                  + CASE WHEN {fraction('transaction_id', 'over42')} < {FIT_ROWS}e0 / n1 - floor({FIT_ROWS}e0 / n1)
                         THEN 1 ELSE 0 END
                WHEN is_fraud = 1 THEN
                  CASE WHEN n1 = {FIT_ROWS} OR {fraction('transaction_id', 'under42')} < {FIT_ROWS}e0 / n1 THEN 1 ELSE 0 END
                WHEN n0 <= {FIT_ROWS} THEN 1
                WHEN {fraction('transaction_id', 'under42')} < {FIT_ROWS}e0 / n0 THEN 1 ELSE 0 END) AS BIGINT)
FROM train, (SELECT count(*) FILTER (is_fraud = 0) AS n0, count(*) FILTER (is_fraud = 1) AS n1 FROM train)"""

SCORED_BATCH = run("""
SELECT transaction_id, coalesce(customer_id, NULL) AS customer_id, amount,
       upper(merchant_category[1]) || merchant_category[2:] AS merchant_category,
       CAST(hour(transaction_timestamp) AS INTEGER) AS hour,
       true AS probability_holds, true AS prediction_holds, true AS level_holds
FROM batch""")

SCALED = ", ".join(
    f"round(CASE WHEN s{i} > 0 THEN ({c} - m{i}) / s{i} ELSE 0 END, 6) AS scaled_{c}" for i, c in enumerate(FEATURES)
)

ML_ORACLES: dict[str, str] = {
    "score_batch": SCORED_BATCH,
    "serving_features": run(f"""
SELECT transaction_id, coalesce(n + 1, 10) AS customer_transaction_count,
       coalesce(frauds, 0) AS customer_fraud_count, round(coalesce(rate, 0.02e0), 6) AS customer_fraud_rate,
       round(m.rate0, 6) AS merchant_fraud_rate, round(m.volatility, 6) AS merchant_fraud_volatility
FROM batch LEFT JOIN ({HISTORY}) h ON h.customer_id = known_id
JOIN (SELECT merchant_category, avg(is_fraud) AS rate0, coalesce(stddev_samp(is_fraud), 0) AS volatility
      FROM train GROUP BY merchant_category) m USING (merchant_category)"""),
    "compare_models_ml": tx("""
SELECT transaction_id, CAST(3 AS INTEGER) AS models_total, true AS flags_hold, true AS decision_holds,
       true AS mean_holds, true AS leader_holds FROM tx"""),
    "feature_importance": f"""
SELECT model, CAST(i AS INTEGER) AS importance_rank, true AS feature_known, CAST(8 AS INTEGER) AS features,
       true AS total_holds, true AS order_holds FROM ({TREES}) t(model), range(1, 9) r(i)""",
    "scenario_scores": f"""
SELECT scenario, model, true AS probability_holds, true AS prediction_holds
FROM ({SCENARIO_NAMES}) s(scenario), ({MODELS}) m(model)""",
    "train_evaluate": run(f"""
SELECT model, (SELECT count(*) FROM known) - (SELECT count(*) FROM train) AS test_rows, true AS accuracy_holds,
       true AS precision_holds, true AS recall_holds, true AS f1_holds, true AS auc_holds
FROM ({MODELS}) m(model)"""),
    "run_summary": run(f"""
SELECT CAST((SELECT count(*) FROM known WHERE amount IS NULL OR is_fraud IS NULL) AS BIGINT) AS incomplete_rows,
       (SELECT count(*) FROM known) AS original_rows, (SELECT count(*) FROM known) AS after_capping_rows,
       ({BALANCED_ROWS}) AS after_balancing_rows,
       (SELECT count(*) FROM known) - (SELECT count(*) FROM train) AS test_rows,
       CAST(8 AS INTEGER) AS feature_count, CAST(3 AS INTEGER) AS model_count, true AS best_holds"""),
    "amount_quantiles_approx": """
SELECT quartile, true AS rank_holds FROM (VALUES ('q25'), ('q50'), ('q75')) q(quartile)""",
    "balance_native": """
SELECT CAST(0 AS BIGINT) AS rows_from_elsewhere, CAST(0 AS BIGINT) AS legit_repeated, true AS legit_size_holds,
       true AS fraud_bound_holds, true AS fraud_size_holds""",
    "split_native": tx("""
SELECT count(*) AS rows, count(*) AS split_rows, CAST(0 AS BIGINT) AS on_both_sides, CAST(0 AS BIGINT) AS lost,
       true AS share_holds FROM tx"""),
    "artifacts_round_trip": run("SELECT 3 * count(*) AS scores, CAST(0 AS BIGINT) AS differences FROM batch"),
    "model_registry": run(f"""
SELECT model, CAST(8 AS INTEGER) AS feature_count,
       (SELECT round(count(*) FILTER (is_fraud = 0)::DOUBLE / count(*) FILTER (is_fraud = 1), 6) FROM train) AS fraud_weight,
       true AS date_holds, true AS metrics_hold FROM ({MODELS}) m(model)"""),
    "processed_table": zscore(f"""
SELECT customer_id, transaction_id, amount, merchant_category, hour, day_of_week, amount_category,
       round(customer_fraud_rate, 6) AS customer_fraud_rate, round(merchant_fraud_rate, 6) AS merchant_fraud_rate,
       customer_transaction_count, customer_fraud_count,
       round(merchant_fraud_volatility, 6) AS merchant_fraud_volatility, target,
       round(CASE WHEN target = 0 THEN 1e0
             ELSE (SELECT count(*) FILTER (target = 0)::DOUBLE / count(*) FILTER (target = 1) FROM feats) END, 6) AS class_weight,
       {SCALED}
FROM feats, z"""),
    "schema_overview": f"""
WITH tx AS ({TX}), d AS (SELECT row_number() OVER () - 1 AS i, column_name AS c, column_type AS t FROM (DESCRIBE SELECT * FROM ({TX})))
SELECT CAST(i AS INTEGER) AS position, c AS column_name,
       CASE t WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
              ELSE lower(t) END AS data_type, c = 'amount' AS is_feature FROM d""",
    "kept_stages": run("""
SELECT transaction_id, CAST(8 AS INTEGER) AS raw_features, true AS amount_first, true AS probability_holds FROM batch"""),
    "csv_intake": tx("""
SELECT transaction_id,
       CASE WHEN transaction_id % 50 IN (9, 13, 17) THEN NULL
            WHEN transaction_id % 50 = 3 THEN 'the "best" ' || merchant_category
            WHEN transaction_id % 50 = 5 THEN merchant_category || chr(10) || 'next line'
            ELSE merchant_category END AS merchant_category,
       CASE WHEN transaction_id % 50 IN (9, 13) THEN 'malformed_line'
            WHEN transaction_id % 50 = 17 THEN 'missing_amount' END AS reject_reason
FROM tx"""),
}
