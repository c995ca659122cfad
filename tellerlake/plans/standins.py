"""Bank-shaped views over the test tables, in SQL that Spark and DuckDB both read.

Each view yields all-text columns as bronze does. ``{name}`` refers to a table or an earlier view.
The JSON access and the way a second copy of a row is made differ by engine; the rest is shared.
"""

from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Columns of the test tables the views read (fixed values).
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
#: Tables that stay as small as they are.
FIXED = ("nation", "region")

VIEWS = {
    "branches_in": """
SELECT 'BR' || cast(1000 + n_nationkey AS string) AS branch_id, n_name AS branch_name, n_name AS city,
       r_name AS province, CASE WHEN n_nationkey % 4 = 0 THEN 'Urban' ELSE 'Suburban' END AS region,
       '20' || lpad(cast(n_nationkey % 20 AS string), 2, '0') || '-01-15' AS opened_date, 'True' AS is_active,
       '2024-01-31T00:00:00' AS _ingestion_ts, 'b1' AS _batch_id
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "merchants_in": """
SELECT 'MER' || lpad(cast(s_suppkey AS string), cast(greatest(4, length(cast(s_suppkey AS string))) AS int), '0') AS merchant_id,
       s_name AS merchant_name, 'CAT' || cast(s_nationkey % 9 AS string) AS merchant_category,
       cast(1000 + s_suppkey AS string) AS mcc_code,
       CASE WHEN s_suppkey % 3 = 0 THEN 'True' ELSE 'False' END AS is_online,
       '2024-01-31T00:00:00' AS _ingestion_ts, 'b1' AS _batch_id
FROM {supplier}""",
    "customers_in": """
SELECT 'CUS' || lpad(cast(c_custkey AS string), cast(greatest(6, length(cast(c_custkey AS string))) AS int), '0') AS customer_id,
       'First' || cast(c_custkey % 50 AS string) AS first_name,
       c_name AS last_name, CASE WHEN c_custkey % 50 = 49 THEN 'invalid' WHEN c_custkey % 61 = 60 THEN NULL
            ELSE 'u' || cast(c_custkey AS string) || '@example.com' END AS email,
       '0' || cast(c_custkey AS string) AS phone,
       '19' || cast(50 + c_custkey % 50 AS string) || '-0' || cast(1 + c_custkey % 9 AS string) || '-11' AS date_of_birth,
       CASE WHEN c_custkey % 71 = 70 THEN NULL ELSE cast(18 + c_custkey % 68 AS string) END AS age,
       CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender, r_name AS province, n_name AS city,
       lpad(cast(c_nationkey AS string), 4, '0') AS postal_code, c_mktsegment AS customer_segment,
       CASE WHEN c_acctbal < 1000 THEN 'R0-R10k' WHEN c_acctbal < 5000 THEN 'R10k-R25k' ELSE 'R25k-R50k' END AS income_band,
       CASE c_custkey % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS risk_rating,
       CASE WHEN c_custkey % 4 <> 0 THEN 'True' ELSE 'False' END AS kyc_verified,
       '2020-0' || cast(1 + c_custkey % 9 AS string) || '-20' AS onboarding_date,
       CASE WHEN c_custkey % 5 <> 0 THEN 'True' ELSE 'False' END AS is_active,
       '2024-01-31T00:00:00' AS _ingestion_ts, 'b1' AS _batch_id
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "accounts_in": """
SELECT 'ACC' || lpad(cast(c_custkey AS string), cast(greatest(7, length(cast(c_custkey AS string))) AS int), '0') AS account_id,
       CASE WHEN c_custkey % 97 = 96 THEN 'CUS999999999999' WHEN c_custkey % 101 = 100 THEN NULL
            ELSE 'CUS' || lpad(cast(c_custkey AS string), cast(greatest(6, length(cast(c_custkey AS string))) AS int), '0') END AS customer_id,
       CASE WHEN c_custkey % 53 = 52 THEN 'BR9999' ELSE 'BR' || cast(1000 + c_nationkey AS string) END AS branch_id,
       CASE c_custkey % 3 WHEN 0 THEN 'Cheque' WHEN 1 THEN 'Savings' ELSE 'Credit Card' END AS account_type,
       cast(1000000000 + c_custkey AS string) AS account_number, 'ZAR' AS currency,
       cast(c_acctbal AS string) AS opening_balance, cast(c_acctbal AS string) AS current_balance,
       CASE WHEN c_custkey % 3 = 2 THEN cast(5000 * (1 + c_custkey % 4) AS string) END AS credit_limit,
       cast(c_custkey % 20 AS string) || '.5' AS interest_rate,
       CASE c_custkey % 6 WHEN 4 THEN 'Dormant' WHEN 5 THEN 'Closed' ELSE 'Active' END AS status,
       '202' || cast(c_custkey % 4 AS string) || '-03-0' || cast(1 + c_custkey % 9 AS string) AS open_date,
       CASE WHEN c_custkey % 6 = 5 THEN '2023-12-31' END AS close_date,
       CASE WHEN c_custkey % 3 = 0 THEN cast(500 + c_custkey % 100 AS string) || '.25' ELSE '0.0' END AS overdraft_limit,
       '2024-01-31T00:00:00' AS _ingestion_ts, 'b1' AS _batch_id
FROM {customer}""",
    # One row per event; every tenth transaction arrives a second time, completed, in a later batch.
    "transactions_in": """
WITH b AS (
  SELECT 'TXN' || lpad(cast(event_id AS string), cast(greatest(9, length(cast(event_id AS string))) AS int), '0') AS transaction_id,
         CASE WHEN event_id % 211 = 210 THEN 'ACC99999999999'
              ELSE 'ACC' || lpad(cast(user_id AS string), cast(greatest(7, length(cast(user_id AS string))) AS int), '0') END AS account_id,
         CASE WHEN event_type = 'purchase' THEN 'MER' || lpad(cast(event_id % 120 AS string), 4, '0') END AS merchant_id,
         CASE event_type WHEN 'purchase' THEN 'Purchase' WHEN 'click' THEN 'EFT Transfer Out' WHEN 'view' THEN 'Bank Charges'
              WHEN 'signup' THEN 'Salary Credit' ELSE 'ATM Withdrawal' END AS transaction_type,
         CASE event_type WHEN 'purchase' THEN 'POS' WHEN 'error' THEN 'ATM' ELSE 'Mobile App' END AS channel,
         CASE WHEN event_id % 307 = 306 THEN '-1.00' ELSE cast(cast(value * 100 AS decimal(15,2)) AS string) END AS amount,
         CASE WHEN event_type = 'signup' THEN 'False' ELSE 'True' END AS is_debit, 'ZAR' AS currency,
         cast(cast(value * 10 AS decimal(15,2)) AS string) AS balance_after,
         substr(t, 1, 10) AS transaction_date, substr(t, 12, 8) AS transaction_time,
         'REF' || cast(event_id % 1000 AS string) AS reference, event_type AS description,
         CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'Failed' ELSE 'Declined - Over Limit' END
              WHEN event_id % 9 = 8 THEN 'Pending' ELSE 'Completed' END AS first_status,
         CASE WHEN k >= 95 THEN 'True' ELSE 'False' END AS is_fraud_flag,
         cast(cast(k / 100.0 AS decimal(4,3)) AS string) AS fraud_score,
         'False' AS is_weekend, 'False' AS is_holiday_season, event_id
  FROM (SELECT event_id, user_id, event_type, value, {K} AS k, cast(ts AS string) AS t FROM {events}) e)
SELECT transaction_id, account_id, merchant_id, transaction_type, channel, amount, is_debit, currency, balance_after,
       transaction_date, transaction_time, reference, description,
       CASE WHEN copy = 1 THEN first_status ELSE 'Completed' END AS status,
       is_fraud_flag, fraud_score, is_weekend, is_holiday_season,
       CASE WHEN copy = 1 THEN '2024-01-31T00:00:00' ELSE '2024-02-01T00:00:00' END AS _ingestion_ts,
       CASE WHEN copy = 1 THEN 'b1' ELSE 'b2' END AS _batch_id
FROM {COPIES}""",
    "customers_day1": """
SELECT * FROM {customers_in} WHERE cast(substr(customer_id, 4) AS bigint) % 20 <> 19""",
    "customers_day2": """
SELECT customer_id, first_name, last_name,
       CASE WHEN n % 11 = 10 THEN 'new' || cast(n AS string) || '@example.com' ELSE email END AS email,
       phone, date_of_birth, age, gender, province, city, postal_code,
       CASE WHEN n % 7 = 6 THEN 'Private Banking' ELSE customer_segment END AS customer_segment,
       income_band, risk_rating, CASE WHEN n % 13 = 12 THEN NULL ELSE kyc_verified END AS kyc_verified,
       onboarding_date, is_active, '2024-02-01T00:00:00' AS _ingestion_ts, 'b2' AS _batch_id
FROM (SELECT c.*, cast(substr(customer_id, 4) AS bigint) AS n FROM {customers_in} c) x
WHERE n % 23 <> 22""",
    "accounts_day1": """
SELECT * FROM {accounts_in} WHERE cast(substr(account_id, 4) AS bigint) % 20 <> 19""",
    "accounts_day2": """
SELECT account_id, customer_id, branch_id, account_type, account_number, currency, opening_balance, current_balance,
       credit_limit, CASE WHEN n % 8 = 7 THEN '21.75' ELSE interest_rate END AS interest_rate,
       CASE WHEN n % 9 = 8 THEN 'Closed' ELSE status END AS status, open_date, close_date,
       overdraft_limit, '2024-02-01T00:00:00' AS _ingestion_ts, 'b2' AS _batch_id
FROM (SELECT a.*, cast(substr(account_id, 4) AS bigint) AS n FROM {accounts_in} a) x""",
    "branches_day1": """
SELECT * FROM {branches_in} WHERE cast(substr(branch_id, 3) AS bigint) % 6 <> 5""",
    "branches_day2": """
SELECT branch_id, branch_name || ' Mall' AS branch_name, city, province, region,
       '2010-06-01' AS opened_date, is_active, '2024-02-01T00:00:00' AS _ingestion_ts, 'b2' AS _batch_id
FROM {branches_in} WHERE cast(substr(branch_id, 3) AS bigint) % 5 <> 4""",
    "merchants_day1": """
SELECT * FROM {merchants_in} WHERE cast(substr(merchant_id, 4) AS bigint) % 6 <> 5""",
    "merchants_day2": """
SELECT merchant_id, merchant_name, CASE WHEN n % 4 = 3 THEN 'Education' ELSE merchant_category END AS merchant_category,
       mcc_code, is_online, '2024-02-01T00:00:00' AS _ingestion_ts, 'b2' AS _batch_id
FROM (SELECT m.*, cast(substr(merchant_id, 4) AS bigint) AS n FROM {merchants_in} m) x
WHERE n % 5 <> 4""",
    # The transactions over four months, as three deliveries: late rows, repeated rows, corrections that move rows.
    "transactions_spread": """
SELECT transaction_id, account_id, merchant_id, transaction_type, channel, amount, is_debit, currency, balance_after,
       '2024-0' || cast(1 + floor((d - 1) / 8) AS int) || '-' || substr(transaction_date, 9, 2) AS transaction_date,
       transaction_time, reference, description, status, is_fraud_flag, fraud_score, is_weekend, is_holiday_season,
       _ingestion_ts, _batch_id, n
FROM (SELECT t.*, cast(substr(transaction_date, 9, 2) AS int) AS d, cast(substr(transaction_id, 4) AS bigint) AS n
      FROM {transactions_in} t) x""",
    "feed_day1": """
SELECT transaction_id, account_id, merchant_id, transaction_type, channel, amount, is_debit, currency, balance_after,
       transaction_date, transaction_time, reference, description, status, is_fraud_flag, fraud_score, is_weekend,
       is_holiday_season, '2024-05-01T00:00:00' AS _ingestion_ts, 'f1' AS _batch_id
FROM {transactions_spread} WHERE _batch_id = 'b1' AND transaction_date <= '2024-03-20' AND n % 13 <> 12""",
    "feed_day2": """
SELECT transaction_id, account_id, merchant_id, transaction_type, channel, amount, is_debit, currency, balance_after,
       transaction_date, transaction_time, reference, description, status, is_fraud_flag, fraud_score, is_weekend,
       is_holiday_season, '2024-05-02T00:00:00' AS _ingestion_ts, 'f2' AS _batch_id
FROM {transactions_spread}
WHERE _batch_id = 'b1' AND ((transaction_date > '2024-03-20' AND transaction_date <= '2024-04-27')
                            OR (transaction_date > '2024-03-01' AND n % 5 = 0 AND n % 13 <> 12))""",
    "feed_day3": """
SELECT transaction_id, CASE WHEN _batch_id = 'b2' AND n % 70 = 0 THEN 'ACC0000001' ELSE account_id END AS account_id,
       merchant_id, transaction_type, channel, amount, is_debit, currency, balance_after,
       CASE WHEN _batch_id = 'b2' AND n % 50 = 0 THEN '2024-02-11' WHEN n % 400 = 399 THEN NULL
            ELSE transaction_date END AS transaction_date,
       transaction_time, reference, description, status, is_fraud_flag, fraud_score, is_weekend,
       is_holiday_season, '2024-05-03T00:00:00' AS _ingestion_ts, 'f3' AS _batch_id
FROM {transactions_spread}
WHERE (_batch_id = 'b1' AND (transaction_date > '2024-04-27' OR (transaction_date <= '2024-03-20' AND n % 13 = 12))
       AND n % 10 <> 0) OR _batch_id = 'b2'""",
    "feed_upto2": """
SELECT * FROM {feed_day1} UNION ALL SELECT * FROM {feed_day2}""",
    "feed_all": """
SELECT * FROM {feed_day1} UNION ALL SELECT * FROM {feed_day2} UNION ALL SELECT * FROM {feed_day3}""",
    "transactions_loaded": """
SELECT * FROM {transactions_in}
WHERE transaction_date <= '2024-01-15' AND cast(substr(transaction_id, 4) AS bigint) % 13 <> 12""",
}

_SPARK = {
    "K": "cast(get_json_object(props, '$.k') AS int)",
    "COPIES": "b LATERAL VIEW explode(CASE WHEN event_id % 10 = 0 THEN array(1, 2) ELSE array(1) END) c AS copy",
}
_DUCKDB = {
    "K": "cast(json_extract_string(props, '$.k') AS int)",
    "COPIES": "(SELECT *, 1 AS copy FROM b UNION ALL SELECT *, 2 AS copy FROM b WHERE event_id % 10 = 0) c",
}


def view(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A stand-in view as a Spark frame over the Parquet tables.

    With ``spread`` the rows of tables that grow are dealt over the tasks first, for a file with few row groups is
    read by few tasks, which would do all of the view's work. Rows are dealt by all their columns, so none is hot.
    """
    text = VIEWS[name]
    for token, code in _SPARK.items():
        text = text.replace("{" + token + "}", code)
    sources = {}
    for source in (*TABLES, *VIEWS):
        if "{" + source + "}" in text:
            if source in TABLES:
                rows = spark.read.schema(TABLES[source]).parquet(f"{sf_dir}/{source}.parquet")
                sources[source] = rows.repartition(*rows.columns) if spread and source not in FIXED else rows
            else:
                sources[source] = view(spark, sf_dir, source, spread)
    return spark.sql(text, **sources)


@cache
def duckdb_ctes() -> dict[str, str]:
    """The views as DuckDB text that names tables and earlier views directly."""
    names = {name: name for name in (*TABLES, *VIEWS)}
    return {name: text.format(**names, **_DUCKDB).strip() for name, text in VIEWS.items()}
