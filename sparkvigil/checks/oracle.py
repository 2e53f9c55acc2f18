"""The registered queries as SQL for an independent engine, written from the definitions."""

from __future__ import annotations

from sparkvigil.functions import rules
from sparkvigil.sources.schemas import FEATURES

SPAN = 16**13

# ---- shared tables ------------------------------------------------------------------------------

TX = """
SELECT user_id AS customer_id, event_id AS transaction_id, ts AS transaction_timestamp,
       round(value * 20, 2) AS amount,
       CASE event_type WHEN 'click' THEN 'groceries' WHEN 'view' THEN 'fashion'
                       WHEN 'purchase' THEN 'electronics' WHEN 'signup' THEN 'travel'
                       ELSE 'gaming' END AS merchant_category,
       CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) >= 99
              OR (round(value * 20, 2) >= 2400 AND hour(ts) < 6)
            THEN 1 ELSE 0 END AS is_fraud
FROM events"""

JOINED = """
SELECT tx.*, c_acctbal, c_mktsegment FROM tx JOIN customer ON c_custkey = customer_id
WHERE c_acctbal >= 0"""
KNOWN = "SELECT tx.* FROM tx JOIN customer ON c_custkey = customer_id"


def timed(source: str) -> str:
    return f"""
SELECT *, CAST(hour(transaction_timestamp) AS INTEGER) AS hour,
       CAST(dayofweek(transaction_timestamp) + 1 AS INTEGER) AS day_of_week
FROM {source}"""


def history(source: str, frame: int = 100, end: int = 0) -> str:
    last = "CURRENT ROW" if end == 0 else "1 PRECEDING"
    order = "PARTITION BY customer_id ORDER BY transaction_timestamp, transaction_id"
    upto = f"({order} ROWS BETWEEN UNBOUNDED PRECEDING AND {last})"
    return f"""
SELECT *, coalesce(avg(is_fraud) OVER ({order} ROWS BETWEEN {frame} PRECEDING AND 1 PRECEDING), 0)
            AS customer_fraud_rate,
       CAST(count(*) OVER {upto} AS BIGINT) AS customer_transaction_count,
       CAST(coalesce(sum(is_fraud) OVER {upto}, 0) AS BIGINT) AS customer_fraud_count
FROM {source}"""


def stats(source: str) -> str:
    return f"""
SELECT merchant_category, avg(is_fraud) AS merchant_fraud_rate,
       coalesce(stddev_samp(is_fraud), 0) AS merchant_fraud_volatility
FROM {source} GROUP BY merchant_category"""


def quartiles(source: str) -> str:
    return f"""
SELECT quantile_disc(amount, 0.25) AS q25, quantile_disc(amount, 0.5) AS q50,
       quantile_disc(amount, 0.75) AS q75 FROM {source}"""


def bounds(source: str) -> str:
    return f"""
SELECT quantile_disc(amount, 0.005) AS lower_bound, quantile_disc(amount, 0.995) AS upper_bound
FROM {source}"""


CATEGORY = """CASE WHEN amount <= q25 THEN 'small' WHEN amount <= q50 THEN 'medium'
                WHEN amount <= q75 THEN 'large' ELSE 'very_large' END"""
CAPPED = """CASE WHEN amount < lower_bound THEN lower_bound
              WHEN amount > upper_bound THEN upper_bound ELSE amount END"""

FEATS = f"""
SELECT customer_id, transaction_id, {CAPPED} AS amount, h.merchant_category, hour, day_of_week,
       {CATEGORY} AS amount_category, customer_fraud_rate, merchant_fraud_rate,
       customer_transaction_count, customer_fraud_count, merchant_fraud_volatility,
       CAST(is_fraud AS DOUBLE) AS target
FROM h JOIN stats ON stats.merchant_category = h.merchant_category, q, b"""


def tx(body: str) -> str:
    return f"WITH tx AS ({TX})\n{body}"


def timed_tx(body: str) -> str:
    return f"WITH tx AS ({TX}), t AS ({timed('tx')})\n{body}"


def feats(body: str) -> str:
    return (
        f"WITH tx AS ({TX}), joined AS ({KNOWN}), t AS ({timed('joined')}), h AS ({history('t')}), "
        f"stats AS ({stats('joined')}), q AS ({quartiles('joined')}), b AS ({bounds('joined')}), "
        f"feats AS ({FEATS})\n{body}"
    )


def hashed(key: str, purpose: str) -> str:
    return f"CAST(('0x' || substr(md5('{purpose}:' || {key}::VARCHAR), 1, 13)) AS BIGINT)"


def fraction(key: str, purpose: str) -> str:
    return f"(CAST({hashed(key, purpose)} AS DOUBLE) / {SPAN}e0)"


ROUNDED_FEATS = """
SELECT customer_id, transaction_id, amount, merchant_category, hour, day_of_week, amount_category,
       round(customer_fraud_rate, 6) AS customer_fraud_rate,
       round(merchant_fraud_rate, 6) AS merchant_fraud_rate,
       customer_transaction_count, customer_fraud_count,
       round(merchant_fraud_volatility, 6) AS merchant_fraud_volatility, target FROM feats"""

# ---- rule scores and batch results --------------------------------------------------------------

RULES = """
SELECT *, least(1e0, 0.15e0 + CASE WHEN amount >= 2400 THEN 0.5e0 ELSE 0e0 END
                  + CASE WHEN hour < 6 THEN 0.3e0 ELSE 0e0 END
                  + CASE WHEN merchant_category = 'gaming' THEN 0.1e0 ELSE 0e0 END) AS pa,
       0.1e0 + CASE WHEN amount >= 2400 THEN 0.6e0 ELSE 0e0 END
             + CASE WHEN merchant_category IN ('electronics', 'travel') THEN 0.2e0 ELSE 0e0 END AS pb,
       0.06e0 + CASE WHEN hour < 6 THEN 0.45e0 ELSE 0e0 END
              + CASE WHEN amount >= 1000 THEN 0.3e0 ELSE 0e0 END AS pc
FROM {source}"""

LONG = """
SELECT transaction_id, is_fraud AS label, hour, amount, 'rule_a' AS model,
       CAST(pa >= 0.4e0 AS INTEGER) AS prediction, pa AS fraud_probability FROM r
UNION ALL SELECT transaction_id, is_fraud, hour, amount, 'rule_b', CAST(pb >= 0.55e0 AS INTEGER), pb FROM r
UNION ALL SELECT transaction_id, is_fraud, hour, amount, 'rule_c', CAST(pc >= 0.5e0 AS INTEGER), pc FROM r"""

CONFUSION = """
SELECT model, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
       count(*) FILTER (label = 0 AND prediction = 1) AS fp,
       count(*) FILTER (label = 1 AND prediction = 0) AS fn,
       count(*) FILTER (label = 1 AND prediction = 1) AS tp
FROM s GROUP BY model"""

# From precision and recall, unlike the library, which uses the closed form.
CLASS_METRICS = """
SELECT model,
       (f1_legit * (tn + fp) + f1_fraud * (tp + fn)) / (tn + fp + fn + tp) AS f1_weighted,
       f1_fraud, precision_fraud, recall_fraud, (tn + tp) / (tn + fp + fn + tp) AS accuracy
FROM (SELECT *, CASE WHEN precision_fraud + recall_fraud > 0 THEN
             2 * precision_fraud * recall_fraud / (precision_fraud + recall_fraud) ELSE 0 END AS f1_fraud,
             CASE WHEN precision_legit + recall_legit > 0 THEN
             2 * precision_legit * recall_legit / (precision_legit + recall_legit) ELSE 0 END AS f1_legit
      FROM (SELECT model, tn::DOUBLE AS tn, fp::DOUBLE AS fp, fn::DOUBLE AS fn, tp::DOUBLE AS tp,
                   coalesce(tp / nullif(tp + fp, 0), 0) AS precision_fraud,
                   coalesce(tp / nullif(tp + fn, 0), 0) AS recall_fraud,
                   coalesce(tn / nullif(tn + fn, 0), 0) AS precision_legit,
                   coalesce(tn / nullif(tn + fp, 0), 0) AS recall_legit
            FROM c))"""

AUC = """
SELECT model, (sum(r) FILTER (label = 1) - np * (np + 1) / 2e0) / (np::DOUBLE * nn) AS auc_roc
FROM (SELECT model, label,
             rank() OVER (PARTITION BY model ORDER BY fraud_probability)
               + (count(*) OVER (PARTITION BY model, fraud_probability) - 1) / 2e0 AS r,
             count(*) FILTER (label = 1) OVER (PARTITION BY model) AS np,
             count(*) FILTER (label = 0) OVER (PARTITION BY model) AS nn
      FROM s) GROUP BY model, np, nn"""


def ruled(body: str) -> str:
    return timed_tx("").rstrip() + f", r AS ({RULES.format(source='t')})\n{body}"


def scored(body: str) -> str:
    return ruled("").rstrip() + f", s AS ({LONG})\n{body}"


def confusion(body: str) -> str:
    return scored("").rstrip() + f", c AS ({CONFUSION})\n{body}"


def metrics(body: str) -> str:
    return (
        confusion("").rstrip()
        + f", cm AS ({CLASS_METRICS}), auc AS ({AUC}), m AS (SELECT * FROM cm JOIN auc USING (model))\n{body}"
    )


BATCH = """
SELECT customer_id::VARCHAR AS customer_id, transaction_id::VARCHAR AS transaction_id,
       transaction_timestamp, amount, merchant_category,
       CASE WHEN transaction_id % 50 = 7 THEN 'bad_transaction_timestamp'
            WHEN transaction_id % 50 = 11 THEN 'bad_amount' END AS reject_reason FROM tx"""

RESULT = """
SELECT transaction_id, customer_id, amount,
       upper(substr(merchant_category, 1, 1)) || substr(merchant_category, 2) AS merchant_category,
       strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS transaction_time, hour,
       dayname(transaction_timestamp) AS day_of_week,
       CASE WHEN pa >= 0.4e0 THEN 'FRAUD' ELSE 'LEGITIMATE' END AS prediction, pa AS confidence,
       CASE WHEN NOT pa >= 0.4e0 THEN 'LEGIT' WHEN pa >= 0.9e0 THEN 'CRITICAL'
            WHEN pa >= 0.7e0 THEN 'HIGH' WHEN pa >= 0.5e0 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
       CASE WHEN NOT pa >= 0.4e0 THEN '✅' WHEN pa >= 0.9e0 THEN '🔴'
            WHEN pa >= 0.7e0 THEN '🟠' WHEN pa >= 0.5e0 THEN '🟡' ELSE '🔵' END AS risk_emoji
FROM r"""


def result(body: str) -> str:
    return (
        f"WITH tx AS ({TX}), batch AS ({BATCH}), good AS (SELECT * FROM batch WHERE reject_reason IS NULL), "
        f"t AS ({timed('good')}), r AS ({RULES.format(source='t')}), result AS ({RESULT})\n{body}"
    )


MONEY = "format('${:,.2f}', amount)"
PERCENT = "format('{:.1f}%', confidence * 100e0)"
REPORT = f"""
SELECT transaction_id, customer_id, {MONEY} AS amount, merchant_category, transaction_time, hour,
       day_of_week, prediction, {PERCENT} AS confidence, risk_level, risk_emoji FROM result"""
SUMMARY = f"""
SELECT transaction_id, customer_id, {MONEY} AS amount, merchant_category, prediction,
       {PERCENT} AS confidence FROM result"""


def rate_by(column: str) -> str:
    return f"""
SELECT {column}, count(*) AS total, count(*) FILTER (prediction = 'FRAUD') AS fraud_count,
       round(100e0 * count(*) FILTER (prediction = 'FRAUD') / count(*), 6) AS fraud_rate
FROM result GROUP BY {column}"""


# ---- generated fragments ------------------------------------------------------------------------

DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
DAY_NAME = (
    "CASE day_of_week " + " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DAYS, 1)) + " END"
)
PRIOR = (
    "CASE merchant_category "
    + " ".join(f"WHEN '{m}' THEN {rate}e0" for m, rate in rules.MERCHANT_PRIOR.items())
    + f" ELSE {rules.DEFAULT_MERCHANT_RATE}e0 END"
)
# The amount ranges.
AMOUNT_RANGE = """CASE WHEN amount > 0 AND amount <= 100 THEN '<$100' WHEN amount > 100 AND amount <= 500 THEN '$100-500'
     WHEN amount > 500 AND amount <= 1000 THEN '$500-1000'
     WHEN amount > 1000 AND amount <= 5000 THEN '$1000-5000' WHEN amount > 5000 THEN '>$5000' END"""


def zscore(select: str) -> str:
    moments = ", ".join(
        f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(FEATURES)
    )
    return feats("").rstrip() + f", z AS (SELECT {moments} FROM feats)\n{select}"


ZSCORES = "SELECT transaction_id, " + ", ".join(
    f"round(CASE WHEN s{i} > 0 THEN ({c} - m{i}) / s{i} ELSE 0 END, 6) AS {c}"
    for i, c in enumerate(FEATURES)
) + " FROM feats, z"


def describe(column: str, digits: str = "round({}, 6)") -> str:
    value = lambda f: digits.format(f"{f}({column})")
    return (
        f"SELECT '{column}' AS column_name, count({column}) AS n, {value('avg')} AS mean, "
        f"{value('stddev_samp')} AS stddev, round(min({column})::DOUBLE, 6) AS min, "
        f"round(max({column})::DOUBLE, 6) AS max FROM feats"
    )


def feature_describe() -> str:
    parts = []
    for c in FEATURES:
        v = f"{c}::DOUBLE"
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS n, round_even(avg({v}), 4) AS mean, "
            f"round_even(stddev_samp({v}), 4) AS stddev, round_even(min({v}), 4) AS min, "
            f"round_even(quantile_cont({v}, 0.25), 4) AS q25, round_even(quantile_cont({v}, 0.5), 4) AS q50, "
            f"round_even(quantile_cont({v}, 0.75), 4) AS q75, round_even(max({v}), 4) AS max FROM feats"
        )
    return feats(" UNION ALL ".join(parts))


def correlation() -> str:
    names = [*FEATURES, "target"]
    parts = []
    for a in names:
        for b in names:
            value = (
                f"CASE WHEN stddev_samp({a}) > 0 THEN 1e0 END"
                if a == b
                else f"CASE WHEN NOT isnan(corr({a}, {b})) THEN round(corr({a}, {b}), 6) END"
            )
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {value} AS correlation FROM feats")
    return feats(" UNION ALL ".join(parts))


def histogram(column: str) -> str:
    return feats(f"""
SELECT bin, round(lo + bin * ((hi - lo) / 50), 6) AS bin_low,
       round(lo + (bin + 1) * ((hi - lo) / 50), 6) AS bin_high, count(*) AS row_count
FROM (SELECT lo, hi, CAST(least(coalesce(floor(({column} - lo) / nullif((hi - lo) / 50, 0)), 0), 49)
                          AS INTEGER) AS bin
      FROM feats, (SELECT min({column}) AS lo, max({column}) AS hi FROM feats))
GROUP BY bin, lo, hi""")


def box(column: str) -> str:
    return feats(f"""
SELECT target, round(lo, 6) AS min, round(a, 6) AS q25, round(m, 6) AS median, round(z, 6) AS q75,
       round(hi, 6) AS max, round(a - 1.5e0 * (z - a), 6) AS lower_fence,
       round(z + 1.5e0 * (z - a), 6) AS upper_fence
FROM (SELECT target, min({column}) AS lo, quantile_cont({column}, 0.25) AS a,
             quantile_cont({column}, 0.5) AS m, quantile_cont({column}, 0.75) AS z,
             max({column}) AS hi FROM feats GROUP BY target)""")


TXN_BIN = "1 + " + " + ".join(
    f"CAST(x > lo + {i} * ((hi - lo) / 10e0) AS INTEGER)" for i in range(1, 10)
)

# The scenario rows, features in model order.
SCENARIOS = """VALUES ('Normal Transaction', [50, 14, 3, 0.01, 0.01, 100, 0, 0.005]::DOUBLE[]),
       ('Slightly Suspicious', [500, 22, 6, 0.05, 0.03, 10, 1, 0.02]::DOUBLE[]),
       ('Highly Suspicious', [5000, 3, 7, 0.3, 0.05, 3, 2, 0.04]::DOUBLE[]),
       ('Your Test Case', [150, 14, 4, 0.02, 0.03, 10, 0, 0.01]::DOUBLE[])"""


def scaled_features() -> str:
    parts = [
        f"SELECT scenario, CAST({i} AS INTEGER) AS position, '{c}' AS feature, v[{i + 1}] AS raw_value, "
        f"round(CASE WHEN s{i} > 0 THEN (v[{i + 1}] - m{i}) / s{i} ELSE 0 END, 6) AS scaled_value FROM sc, z"
        for i, c in enumerate(FEATURES)
    ]
    return zscore("").rstrip() + f", sc(scenario, v) AS ({SCENARIOS})\n" + " UNION ALL ".join(parts)


# Thresholds, texts and levels of the risk factors.
RISK_FACTORS = """
SELECT transaction_id, f.factor AS factor, f.level AS level FROM (
  SELECT transaction_id, unnest([
    CASE WHEN amount > 5000 THEN {'factor': '💰 Exceptionally high amount (>$5000)', 'level': 'high'}
         WHEN amount > 2000 THEN {'factor': '💰 Very high amount (>$2000)', 'level': 'high'}
         WHEN amount > 1000 THEN {'factor': '💰 High amount (>$1000)', 'level': 'medium'} END,
    CASE WHEN merchant_category IN ('electronics', 'travel', 'jewelry')
         THEN {'factor': '🏪 High-risk merchant category', 'level': 'high'} END,
    CASE WHEN hour < 6 OR hour > 22 THEN {'factor': '⏰ Unusual transaction time', 'level': 'medium'} END,
    CASE WHEN customer_fraud_count > 0
         THEN {'factor': '👤 Customer has ' || customer_fraud_count || ' previous frauds', 'level': 'high'} END,
    CASE WHEN pa >= 0.4e0 AND pa > 0.7e0
         THEN {'factor': '🤖 High model confidence in fraud', 'level': 'high'} END]) AS f FROM r)
WHERE f IS NOT NULL"""

AGREEMENT = """
SELECT transaction_id, CAST(sum(prediction) AS INTEGER) AS models_flagging,
       CAST(count(*) AS INTEGER) AS models_total,
       round(avg(fraud_probability), 6) AS mean_confidence,
       first(model ORDER BY fraud_probability DESC, model) AS most_confident_model
FROM s GROUP BY transaction_id"""

BALANCED = f"""
SELECT transaction_id, is_fraud, amount
FROM (SELECT tx.*, n0, n1,
             CASE WHEN is_fraud = 1 AND n1 < 1000 THEN CAST(floor(1000e0 / n1) AS BIGINT)
                    + CASE WHEN {fraction('transaction_id', 'over42')} < 1000e0 / n1 - floor(1000e0 / n1)
                           THEN 1 ELSE 0 END
                  WHEN is_fraud = 1 OR n0 <= 1000 THEN 1
                  WHEN {fraction('transaction_id', 'under42')} < 1000e0 / n0 THEN 1 ELSE 0 END AS copies
      FROM tx, (SELECT count(*) FILTER (is_fraud = 0) AS n0, count(*) FILTER (is_fraud = 1) AS n1 FROM tx)),
     generate_series(1, 100000) AS g(i)
WHERE i <= copies"""

PROFILE = """
SELECT customer_id, round(avg(is_fraud) FILTER (newest <= 20), 6) AS customer_fraud_rate,
       count(*) AS customer_transaction_count, CAST(sum(is_fraud) AS BIGINT) AS customer_fraud_count
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY transaction_timestamp DESC, transaction_id DESC) AS newest FROM tx)
GROUP BY customer_id"""

INDEX = """
SELECT merchant_category, count(*) AS row_count,
       CAST(row_number() OVER (ORDER BY count(*) DESC, merchant_category) - 1 AS DOUBLE) AS category_index
FROM tx GROUP BY merchant_category"""

HISTORY_COLUMNS = """
SELECT customer_id, transaction_id, round(customer_fraud_rate, 6) AS customer_fraud_rate,
       customer_transaction_count, customer_fraud_count FROM h"""


def with_history(**options) -> str:
    return timed_tx("").rstrip() + f", h AS ({history('t', **options)})\n{HISTORY_COLUMNS}"


JOIN_COLUMNS = tx(f"""
SELECT customer_id, transaction_id, amount, merchant_category, is_fraud, c_acctbal, c_mktsegment
FROM ({JOINED})""")

ORACLES: dict[str, str] = {
    "join_customers": JOIN_COLUMNS,
    "join_customers_split": JOIN_COLUMNS,
    "csv_transactions": tx(f"""
SELECT customer_id, transaction_id, amount, merchant_category, is_fraud,
       strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS transaction_time FROM ({JOINED})"""),
    "csv_batch": result(SUMMARY),
    "processed_round_trip": feats(ROUNDED_FEATS),
    "preview": tx("""
SELECT customer_id, transaction_id, amount, merchant_category, is_fraud FROM tx
ORDER BY transaction_id LIMIT 50"""),
    "row_count": tx(f"SELECT count(*) AS row_count FROM ({JOINED})"),
    "preprocessing_state": tx(f"""
SELECT q25, q50, q75, lower_bound, upper_bound,
       round((SELECT count(*) FILTER (is_fraud = 0)::DOUBLE / count(*) FILTER (is_fraud = 1) FROM ({KNOWN})), 6)
         AS fraud_weight,
       CAST(8 AS INTEGER) AS feature_count, 0.5e0 AS target_ratio
FROM ({quartiles(f'({KNOWN})')}), ({bounds(f'({KNOWN})')})"""),
    "merchant_categories": tx("SELECT DISTINCT merchant_category FROM tx"),
    "time_features": timed_tx("""
SELECT transaction_id, hour, day_of_week,
       strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS transaction_time FROM t"""),
    "dow_conventions": timed_tx("""
SELECT transaction_id, day_of_week AS sunday1, CAST(isodow(transaction_timestamp) AS INTEGER) AS monday1,
       dayname(transaction_timestamp) AS day_name, dayname(transaction_timestamp) AS day_name_monday1
FROM t"""),
    "amount_quantiles": tx(quartiles("tx")),
    "amount_category": tx(f"""
SELECT transaction_id, amount, {CATEGORY} AS amount_category FROM tx, ({quartiles('tx')})"""),
    "customer_history": with_history(),
    "customer_history_5": with_history(frame=5),
    "customer_history_no_leak": with_history(end=-1),
    "customer_history_split": with_history(frame=5),
    "customer_profile": tx(PROFILE),
    "merchant_stats": tx(f"""
SELECT merchant_category, round(merchant_fraud_rate, 6) AS merchant_fraud_rate,
       round(merchant_fraud_volatility, 6) AS merchant_fraud_volatility FROM ({stats('tx')})"""),
    "with_merchant_stats": tx(f"""
SELECT transaction_id, merchant_category, round(merchant_fraud_rate, 6) AS merchant_fraud_rate,
       round(merchant_fraud_volatility, 6) AS merchant_fraud_volatility
FROM tx LEFT JOIN ({stats('tx')}) USING (merchant_category)"""),
    "outlier_bounds": tx(bounds("tx")),
    "outlier_count": tx(f"""
SELECT count(*) FILTER (amount < lower_bound OR amount > upper_bound) AS outlier_count
FROM tx, ({bounds('tx')})"""),
    "cap_outliers": tx(f"""
SELECT transaction_id, {CAPPED} AS amount, amount AS amount_original,
       CASE WHEN amount < lower_bound OR amount > upper_bound THEN 1 ELSE 0 END AS was_outlier
FROM tx, ({bounds('tx')})"""),
    "feature_table": feats(ROUNDED_FEATS),
    "zscore_features": zscore(ZSCORES),
    "standardized_features": zscore(ZSCORES),
    "category_index": tx(INDEX),
    "category_encoded_ml": tx(
        f"SELECT merchant_category, category_index AS merchant_category_index FROM ({INDEX})"
    ),
    "category_onehot": tx(f"""
SELECT transaction_id, merchant_category, category_index,
       (SELECT string_agg(CASE WHEN i = category_index THEN '1' ELSE '0' END, ',' ORDER BY i)
        FROM generate_series(0, (SELECT count(DISTINCT merchant_category) FROM tx) - 2) AS g(i)) AS onehot
FROM tx JOIN ({INDEX}) USING (merchant_category)"""),
    "class_counts": tx("SELECT is_fraud AS label, count(*) AS row_count FROM tx GROUP BY is_fraud"),
    "class_weights": tx("""
SELECT 0e0 AS label, 1e0 AS class_weight UNION ALL
SELECT 1e0, round(count(*) FILTER (is_fraud = 0)::DOUBLE / count(*) FILTER (is_fraud = 1), 6) FROM tx"""),
    "label_distribution": tx(f"""
SELECT table_name, is_fraud AS label, count(*) AS row_count
FROM (SELECT is_fraud, 'full' AS table_name FROM tx UNION ALL
      SELECT is_fraud, CASE WHEN {fraction('transaction_id', 'split42')} < 0.8e0
                            THEN 'train' ELSE 'test' END FROM tx)
GROUP BY table_name, is_fraud"""),
    "balance_hash": tx(BALANCED),
    "split_hash": tx(f"""
SELECT transaction_id, CASE WHEN {fraction('transaction_id', 'split42')} < 0.8e0
                            THEN 'train' ELSE 'test' END AS split FROM tx"""),
    "sample_n_hash": feats(f"""
SELECT transaction_id, customer_transaction_count, customer_fraud_count, target FROM feats
ORDER BY {hashed('transaction_id', 'sample42')}, transaction_id LIMIT 500"""),
    "describe_amount": feats(describe("amount")),
    "describe_rates": feats(describe("customer_fraud_rate") + " UNION ALL " + describe("merchant_fraud_rate")),
    "feature_describe": feature_describe(),
    "amount_stats": feats("""
SELECT round(avg(amount), 6) AS mean_amount, round(quantile_cont(amount, 0.5), 6) AS median_amount,
       max(amount) AS max_amount, min(amount) AS min_amount FROM feats"""),
    "amount_category_counts": feats(
        "SELECT amount_category, count(*) AS row_count FROM feats GROUP BY amount_category"
    ),
    "txn_by_hour": feats("SELECT hour, count(*) AS row_count FROM feats GROUP BY hour"),
    "txn_by_dow": feats(f"""
SELECT day_of_week, count(*) AS row_count, {DAY_NAME} AS day_name FROM feats GROUP BY day_of_week"""),
    "fraud_rate_by_hour": feats(
        "SELECT hour, round(avg(target), 6) AS fraud_rate FROM feats GROUP BY hour"
    ),
    "fraud_rate_by_dow": feats(f"""
SELECT day_of_week, round(avg(target), 6) AS fraud_rate, {DAY_NAME} AS day_name
FROM feats GROUP BY day_of_week"""),
    "fraud_overview": feats("""
SELECT count(*) AS total, CAST(sum(target) AS BIGINT) AS fraud_count,
       count(*) - CAST(sum(target) AS BIGINT) AS legit_count,
       round(avg(target) * 100, 6) AS fraud_rate_pct,
       round(coalesce((count(*) - sum(target)) / nullif(sum(target), 0), 0), 6) AS legit_per_fraud
FROM feats"""),
    "target_distribution": feats("""
SELECT CASE target WHEN 0 THEN 'Legitimate' WHEN 1 THEN 'Fraud' END AS target_label,
       count(*) AS row_count FROM feats GROUP BY target"""),
    "missing_values": tx("""
SELECT 'transaction_timestamp' AS column_name, count(*) FILTER (transaction_id % 50 = 7) AS missing_count FROM tx
UNION ALL SELECT 'amount', count(*) FILTER (transaction_id % 50 = 11) FROM tx
UNION ALL SELECT 'reject_reason', count(*) FILTER (transaction_id % 50 NOT IN (7, 11)) FROM tx"""),
    "fraud_by_amount_range": feats(f"""
SELECT amount_range, round(avg(target), 6) AS fraud_rate
FROM (SELECT *, {AMOUNT_RANGE} AS amount_range FROM feats) WHERE amount_range IS NOT NULL
GROUP BY amount_range"""),
    "fraud_by_txn_bin": feats(f"""
SELECT bin, round(CASE WHEN bin = 1 THEN lo - (hi - lo) * 0.001e0
                       ELSE lo + (bin - 1) * ((hi - lo) / 10e0) END, 6) AS bin_low,
       round(CASE WHEN bin = 10 THEN hi ELSE lo + bin * ((hi - lo) / 10e0) END, 6) AS bin_high,
       count(*) AS row_count, round(avg(target), 6) AS fraud_rate
FROM (SELECT target, lo, hi, CAST({TXN_BIN} AS INTEGER) AS bin
      FROM (SELECT target, customer_transaction_count::DOUBLE AS x,
                   min(customer_transaction_count) OVER ()::DOUBLE AS lo,
                   max(customer_transaction_count) OVER ()::DOUBLE AS hi FROM feats))
GROUP BY bin, lo, hi"""),
    "top_merchants": feats("""
SELECT merchant_category, count(*) AS row_count FROM feats GROUP BY merchant_category
ORDER BY row_count DESC, merchant_category LIMIT 10"""),
    "top_risk_merchants": feats("""
SELECT merchant_category, round(avg(target), 6) AS fraud_rate FROM feats GROUP BY merchant_category
ORDER BY avg(target) DESC, merchant_category LIMIT 10"""),
    "merchant_risk_profile": feats("""
SELECT merchant_category, round(max(merchant_fraud_rate), 6) AS merchant_fraud_rate,
       round(max(merchant_fraud_volatility), 6) AS merchant_fraud_volatility,
       round(avg(target), 6) AS observed_fraud_rate FROM feats GROUP BY merchant_category"""),
    "correlation_matrix": correlation(),
    "histogram_amount": histogram("amount"),
    "histogram_rate": histogram("customer_fraud_rate"),
    "box_stats_amount": box("amount"),
    "box_stats_rate": box("customer_fraud_rate"),
    "score_batch_rule": result("SELECT * FROM result"),
    "score_stream": result("SELECT * FROM result"),
    "batch_rejects": tx(f"""
SELECT transaction_id, customer_id, merchant_category, reject_reason FROM ({BATCH})
WHERE reject_reason IS NOT NULL"""),
    "merchant_prior": tx(
        f"SELECT transaction_id, merchant_category, {PRIOR} AS merchant_prior_rate FROM tx"
    ),
    "risk_factors": timed_tx("").rstrip()
    + f", h AS ({history('t', end=-1)}), r AS ({RULES.format(source='h')})\n{RISK_FACTORS}",
    "probability_band": ruled("""
SELECT transaction_id, CAST(pa >= 0.4e0 AS INTEGER) AS prediction, pa AS fraud_probability,
       CASE WHEN pa > 0.8e0 THEN 'high' WHEN pa > 0.5e0 THEN 'medium' ELSE 'low' END AS band FROM r"""),
    "verdict": ruled("""
SELECT transaction_id, CAST(pa >= 0.4e0 AS INTEGER) AS prediction, pa AS fraud_probability,
       CASE WHEN pa >= 0.4e0 AND pa > 0.7e0 THEN 'HIGH RISK' WHEN pa >= 0.4e0 THEN 'SUSPICIOUS'
            ELSE 'LEGITIMATE' END AS verdict FROM r"""),
    "batch_overview": tx("""
SELECT count(*) AS total_records, CAST(5 AS INTEGER) AS column_count,
       round(sum(amount) FILTER (transaction_id % 50 <> 11), 2) AS total_amount FROM tx"""),
    "batch_kpis": result("""
SELECT count(*) AS total_transactions, count(*) FILTER (prediction = 'FRAUD') AS fraud_count,
       round(100e0 * count(*) FILTER (prediction = 'FRAUD') / count(*), 6) AS fraud_rate_pct,
       round(100e0 * count(*) FILTER (prediction = 'FRAUD' AND confidence >= 0.8e0) / count(*), 6)
         AS high_risk_pct,
       round(avg(confidence) * 100, 6) AS mean_confidence_pct FROM result"""),
    "batch_rate_by_hour": result(rate_by("hour")),
    "batch_rate_by_merchant": result(
        rate_by("merchant_category") + " ORDER BY fraud_rate DESC, merchant_category LIMIT 10"
    ),
    "risk_level_distribution": result("""
SELECT risk_level, count(*) AS row_count FROM result WHERE prediction = 'FRAUD' GROUP BY risk_level"""),
    "repeat_offenders": result("""
SELECT customer_id, count(*) AS fraud_count FROM result WHERE prediction = 'FRAUD'
GROUP BY customer_id HAVING count(*) > 1 ORDER BY fraud_count DESC, customer_id LIMIT 5"""),
    "high_risk_rows": result("""
SELECT * FROM result WHERE prediction = 'FRAUD' AND confidence >= 0.8e0"""),
    "high_value_frauds": result("""
SELECT transaction_id, customer_id, amount, merchant_category FROM result
WHERE prediction = 'FRAUD' AND amount > 1000"""),
    "late_night_frauds": result("""
SELECT * FROM result WHERE prediction = 'FRAUD' AND (hour <= 5 OR hour >= 22)"""),
    "summary_report": result(SUMMARY),
    "full_report": result(REPORT),
    "high_risk_report": result(REPORT + " WHERE prediction = 'FRAUD' AND result.confidence >= 0.8e0"),
    "detailed_results": result(f"""
SELECT transaction_id, customer_id, {MONEY} AS amount, merchant_category, transaction_time, hour,
       day_of_week, CASE prediction WHEN 'FRAUD' THEN '🚨 FRAUD' ELSE '✅ LEGITIMATE' END AS prediction,
       {PERCENT} AS confidence, risk_level, risk_emoji FROM result"""),
    "high_risk_table": result(f"""
SELECT transaction_id, customer_id, {MONEY} AS amount, merchant_category, {PERCENT} AS confidence,
       risk_level FROM result WHERE prediction = 'FRAUD' AND result.confidence >= 0.8e0"""),
    "confusion_matrix": confusion("SELECT * FROM c"),
    "classification_metrics": metrics("""
SELECT model, round(f1_weighted, 6) AS f1_weighted, round(f1_fraud, 6) AS f1_fraud,
       round(precision_fraud, 6) AS precision_fraud, round(recall_fraud, 6) AS recall_fraud,
       round(accuracy, 6) AS accuracy FROM cm"""),
    "auc_roc": metrics("SELECT model, round(auc_roc, 6) AS auc_roc FROM auc"),
    "quality_band": metrics("""
SELECT model, CASE WHEN f1_weighted > 0.7e0 THEN 'good' WHEN f1_weighted > 0.5e0 THEN 'acceptable'
                   ELSE 'needs improvement' END AS quality FROM cm"""),
    "metrics_long": metrics(
        " UNION ALL ".join(
            f"SELECT model, '{name}' AS metric, round({name}, 6) AS value FROM m"
            for name in ["f1_weighted", "f1_fraud", "precision_fraud", "recall_fraud", "accuracy", "auc_roc"]
        )
    ),
    "metrics_wide": metrics("""
SELECT model, round_even(f1_weighted, 4) AS f1_weighted, round_even(f1_fraud, 4) AS f1_fraud,
       round_even(precision_fraud, 4) AS precision_fraud, round_even(recall_fraud, 4) AS recall_fraud,
       round_even(accuracy, 4) AS accuracy, round_even(auc_roc, 4) AS auc_roc FROM m"""),
    "best_model": metrics("""
SELECT first(model ORDER BY f1_weighted DESC, model) AS best_by_f1, round(max(f1_weighted), 6) AS best_f1,
       first(model ORDER BY auc_roc DESC, model) AS best_by_auc, round(max(auc_roc), 6) AS best_auc
FROM m"""),
    "score_all_models": scored("SELECT transaction_id, model, prediction, fraud_probability FROM s"),
    "model_agreement": scored(AGREEMENT),
    "vote_decision": scored(f"""
SELECT transaction_id, models_flagging,
       CASE WHEN models_flagging >= 2 THEN 'block' WHEN models_flagging = 1 THEN 'review'
            ELSE 'approve' END AS decision FROM ({AGREEMENT})"""),
    "discrimination_check": scored("""
SELECT *, CASE WHEN suspicious_flagged < suspicious_cases THEN 'suspicious not flagged'
               WHEN normal_flagged > 0 THEN 'normal flagged' ELSE 'distinguishes' END AS outcome
FROM (SELECT model, count(*) FILTER (normal) AS normal_cases,
             count(*) FILTER (normal AND prediction = 1) AS normal_flagged,
             count(*) FILTER (suspicious) AS suspicious_cases,
             count(*) FILTER (suspicious AND prediction = 1) AS suspicious_flagged
      FROM (SELECT *, amount <= 100 AND hour BETWEEN 8 AND 20 AS normal,
                   amount >= 2000 AND hour < 6 AS suspicious FROM s) GROUP BY model)"""),
    "scaled_features": scaled_features(),
}
