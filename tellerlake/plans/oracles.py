"""The catalogue in DuckDB SQL, for comparison on the same Parquet tables.

Written from the definitions of the operators, not from the Spark code. ``STEPS`` are named
subqueries; each query pulls in the steps it mentions.
"""

import re

from tellerlake.plans.standins import duckdb_ctes

STEPS: dict[str, str] = {}
SQL: dict[str, str] = {}


def _latest(source: str, key: str, columns: str, where: str = "true") -> str:
    return f"""
SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY _ingestion_ts DESC, _batch_id DESC) AS copy
  FROM {source} WHERE {key} IS NOT NULL) x
WHERE copy = 1 AND {where}"""


def _day(column: str) -> str:
    return f"CAST(try_strptime({column}, '%Y-%m-%d') AS DATE) AS {column}"


def _branches(source: str) -> str:
    columns = f"""branch_id, branch_name, city, province, region, {_day('opened_date')},
       TRY_CAST(is_active AS BOOLEAN) AS is_active, _ingestion_ts, _batch_id"""
    return _latest(source, "branch_id", columns)


def _merchants(source: str) -> str:
    columns = """merchant_id, merchant_name, merchant_category,
       CAST(trunc(TRY_CAST(mcc_code AS DOUBLE)) AS INTEGER) AS mcc_code,
       TRY_CAST(is_online AS BOOLEAN) AS is_online, _ingestion_ts, _batch_id"""
    return _latest(source, "merchant_id", columns)


def _customers(source: str) -> str:
    age = "CAST(trunc(TRY_CAST(age AS DOUBLE)) AS INTEGER)"
    columns = f"""customer_id, first_name, last_name, concat_ws(' ', first_name, last_name) AS full_name, email, phone,
       {_day('date_of_birth')}, {age} AS age,
       CASE WHEN {age} < 25 THEN 'Under 25' WHEN {age} < 35 THEN '25-34' WHEN {age} < 45 THEN '35-44'
            WHEN {age} < 55 THEN '45-54' WHEN {age} < 65 THEN '55-64' ELSE '65+' END AS age_band,
       gender, province, city, postal_code, customer_segment, income_band, risk_rating,
       TRY_CAST(kyc_verified AS BOOLEAN) AS kyc_verified, {_day('onboarding_date')},
       TRY_CAST(is_active AS BOOLEAN) AS is_active, _ingestion_ts, _batch_id"""
    return _latest(source, "customer_id", columns, "email LIKE '%@%'")


def _accounts(source: str) -> str:
    columns = f"""account_id, customer_id, branch_id, account_type, account_number, currency,
       TRY_CAST(opening_balance AS DOUBLE) AS opening_balance, TRY_CAST(current_balance AS DOUBLE) AS current_balance,
       TRY_CAST(credit_limit AS DOUBLE) AS credit_limit, TRY_CAST(interest_rate AS DOUBLE) AS interest_rate,
       status, {_day('open_date')}, {_day('close_date')}, TRY_CAST(overdraft_limit AS DOUBLE) AS overdraft_limit,
       CAST(DATE '2024-02-01' - CAST(try_strptime(open_date, '%Y-%m-%d') AS DATE) AS INTEGER) AS account_age_days,
       coalesce(TRY_CAST(overdraft_limit AS DOUBLE) > 0, false) AS has_overdraft"""
    return _latest(source, "account_id", columns, "customer_id IS NOT NULL")


def _typed_transactions(source: str) -> str:
    columns = f"""transaction_id, account_id, merchant_id, transaction_type, channel,
       TRY_CAST(amount AS DOUBLE) AS amount, TRY_CAST(is_debit AS BOOLEAN) AS is_debit, currency,
       TRY_CAST(balance_after AS DOUBLE) AS balance_after, {_day('transaction_date')}, transaction_time,
       reference, description, status, TRY_CAST(is_fraud_flag AS BOOLEAN) AS is_fraud_flag,
       TRY_CAST(fraud_score AS DOUBLE) AS fraud_score, TRY_CAST(is_weekend AS BOOLEAN) AS is_weekend,
       TRY_CAST(is_holiday_season AS BOOLEAN) AS is_holiday_season, _ingestion_ts, _batch_id"""
    return _latest(source, "transaction_id", columns)


def _velocity(source: str) -> str:
    return f"""
SELECT *, status = 'Completed' AS is_completed,
       CAST(CASE WHEN status = 'Completed' THEN count(*) FILTER (WHERE status = 'Completed') OVER daily ELSE 0 END AS BIGINT) AS daily_txn_count,
       CAST(CASE WHEN status = 'Completed'
                 THEN coalesce(sum(CASE WHEN is_debit THEN CAST(amount AS DECIMAL(15,2)) ELSE 0 END)
                               FILTER (WHERE status = 'Completed') OVER daily, 0) ELSE 0 END AS DECIMAL(15,2)) AS daily_spend_total
FROM {source}
WINDOW daily AS (PARTITION BY account_id, transaction_date)"""


def _transactions(source: str) -> str:
    hour = "CAST(hour(try_strptime(transaction_time, '%H:%M:%S')) AS INTEGER)"
    return f"""
SELECT * EXCLUDE (is_completed, daily_txn_count, daily_spend_total),
       {hour} AS transaction_hour, CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS transaction_day_of_week,
       CAST(month(transaction_date) AS INTEGER) AS transaction_month, CAST(year(transaction_date) AS INTEGER) AS transaction_year,
       {hour} < 6 OR {hour} >= 22 AS is_night_transaction, {hour} BETWEEN 9 AND 17 AS is_business_hours,
       CASE WHEN amount < 100 THEN 'Under R100' WHEN amount < 500 THEN 'R100-R500' WHEN amount < 1000 THEN 'R500-R1k'
            WHEN amount < 5000 THEN 'R1k-R5k' WHEN amount < 20000 THEN 'R5k-R20k' ELSE 'Over R20k' END AS amount_band,
       CASE WHEN fraud_score < 0.3::DOUBLE THEN 'Low' WHEN fraud_score < 0.6::DOUBLE THEN 'Medium'
            WHEN fraud_score < 0.8::DOUBLE THEN 'High' ELSE 'Critical' END AS fraud_risk_band,
       status LIKE '%Declined%' OR status = 'Failed' AS is_declined,
       is_completed, daily_txn_count, daily_spend_total
FROM {source} WHERE amount > 0"""


for _name, _build in (("branches", _branches), ("merchants", _merchants), ("customers", _customers), ("accounts", _accounts)):
    for _suffix in ("in", "day1", "day2"):
        STEPS[f"s_{_name}_{_suffix}"] = _build(f"{_name}_{_suffix}")
for _source, _suffix in (
    ("transactions_in", "in"), ("transactions_loaded", "loaded"), ("feed_day1", "feed1"), ("feed_upto2", "feed2"), ("feed_all", "feed3"),
):
    STEPS[f"t_transactions_{_suffix}"] = _typed_transactions(_source)
    STEPS[f"v_transactions_{_suffix}"] = _velocity(f"t_transactions_{_suffix}")
    STEPS[f"s_transactions_{_suffix}"] = _transactions(f"v_transactions_{_suffix}")


# Dimensions. Keys are handed out by (first three digest digits, natural key).


def _numbered(key: str) -> str:
    return f"row_number() OVER (ORDER BY substr(md5({key}), 1, 3), {key})"


def _scd1(name: str, key: str, sk: str, updated: str, fixed: str = "") -> None:
    columns = [c for c in (updated + " " + fixed).split()]
    listed = ", ".join(columns)
    STEPS[f"d1_{name}"] = f"""
SELECT {_numbered(key)} AS {sk}, {key}, {listed}, 'b1' AS dw_batch_id, 'insert' AS _action FROM s_{name}_day1"""
    merged = ", ".join(
        f"CASE WHEN n.{key} IS NULL OR (o.{key} IS NOT NULL AND {str(c in fixed.split()).lower()}) THEN o.{c} ELSE n.{c} END AS {c}"
        for c in columns
    )
    STEPS[f"d2_{name}"] = f"""
SELECT CASE WHEN o.{key} IS NULL
            THEN (SELECT max({sk}) FROM d1_{name})
                 + row_number() OVER (PARTITION BY o.{key} IS NULL ORDER BY substr(md5(n.{key}), 1, 3), n.{key})
            ELSE o.{sk} END AS {sk},
       coalesce(o.{key}, n.{key}) AS {key}, {merged},
       CASE WHEN n.{key} IS NULL THEN o.dw_batch_id ELSE 'b2' END AS dw_batch_id,
       CASE WHEN n.{key} IS NULL THEN 'keep' WHEN o.{key} IS NULL THEN 'insert' ELSE 'update' END AS _action
FROM d1_{name} o FULL OUTER JOIN s_{name}_day2 n ON o.{key} = n.{key}"""
    SQL[f"scd1_{name}"] = f"SELECT * FROM d2_{name}"


_scd1("branches", "branch_id", "branch_key", "branch_name city province region is_active", "opened_date")
_scd1("merchants", "merchant_id", "merchant_key", "merchant_name merchant_category mcc_code is_online")


def _scd2(name: str, key: str, sk: str, columns: str, changed: str) -> None:
    """``n_{name}_dayN`` must hold the incoming rows, typed as the dimension."""
    STEPS[f"d1_{name}"] = f"""
SELECT {_numbered(key)} AS {sk}, {columns}, DATE '2024-01-31' AS scd_start_date, CAST(NULL AS DATE) AS scd_end_date,
       true AS scd_is_current, CAST(1 AS SMALLINT) AS scd_version, 'b1' AS dw_batch_id, 'insert' AS _action
FROM n_{name}_day1"""
    STEPS[f"c_{name}"] = f"""
SELECT o.{key}, o.{sk} FROM d1_{name} o JOIN n_{name}_day2 n ON o.{key} = n.{key} WHERE {changed}"""
    picked = ", ".join(f"n.{c.strip()}" for c in columns.split(","))
    STEPS[f"f_{name}"] = f"""
SELECT {picked}, c.{key} IS NOT NULL AS reopened
FROM n_{name}_day2 n LEFT JOIN c_{name} c ON n.{key} = c.{key}
WHERE c.{key} IS NOT NULL OR n.{key} NOT IN (SELECT {key} FROM d1_{name})"""
    STEPS[f"d2_{name}"] = f"""
SELECT * EXCLUDE (hit) REPLACE (CASE WHEN hit THEN DATE '2024-02-01' END AS scd_end_date, NOT hit AS scd_is_current,
                                CASE WHEN hit THEN 'expire' ELSE 'keep' END AS _action)
FROM (SELECT o.*, o.{key} IN (SELECT {key} FROM c_{name}) AS hit FROM d1_{name} o) x
UNION ALL BY NAME
SELECT (SELECT max({sk}) FROM d1_{name}) + {_numbered(key)} AS {sk}, {columns},
       DATE '2024-02-01' AS scd_start_date, CAST(NULL AS DATE) AS scd_end_date, true AS scd_is_current,
       CAST(CASE WHEN reopened THEN 2 ELSE 1 END AS SMALLINT) AS scd_version, 'b2' AS dw_batch_id,
       CASE WHEN reopened THEN 'update' ELSE 'insert' END AS _action
FROM f_{name}"""
    SQL[f"scd2_{name}"] = f"SELECT * FROM d2_{name}"


_CUSTOMER_COLUMNS = """customer_id, full_name, email, date_of_birth, age_band, gender, province, city, customer_segment,
       income_band, risk_rating, kyc_verified, onboarding_date, is_active"""
_ACCOUNT_COLUMNS = """account_id, customer_key, customer_id, account_type, account_number, currency, credit_limit, interest_rate,
       overdraft_limit, status, open_date, close_date, account_age_days, branch_key"""
for _n in (1, 2):
    STEPS[f"n_customers_day{_n}"] = f"SELECT {_CUSTOMER_COLUMNS} FROM s_customers_day{_n}"
_scd2(
    "customers",
    "customer_id",
    "customer_key",
    _CUSTOMER_COLUMNS,
    """o.customer_segment IS DISTINCT FROM n.customer_segment OR o.income_band IS DISTINCT FROM n.income_band
   OR o.risk_rating IS DISTINCT FROM n.risk_rating OR coalesce(o.is_active, false) <> coalesce(n.is_active, false)
   OR coalesce(o.kyc_verified, false) <> coalesce(n.kyc_verified, false)""",
)
for _n in (1, 2):
    STEPS[f"n_accounts_day{_n}"] = f"""
SELECT a.account_id, c.customer_key, a.customer_id, a.account_type, a.account_number, a.currency,
       CAST(a.credit_limit AS DECIMAL(15,2)) AS credit_limit, CAST(a.interest_rate AS DECIMAL(5,2)) AS interest_rate,
       CAST(a.overdraft_limit AS DECIMAL(15,2)) AS overdraft_limit, a.status, a.open_date, a.close_date,
       a.account_age_days, b.branch_key
FROM s_accounts_day{_n} a
LEFT JOIN d{_n}_branches b ON a.branch_id = b.branch_id
LEFT JOIN (SELECT * FROM d{_n}_customers WHERE scd_is_current) c ON a.customer_id = c.customer_id"""
_scd2(
    "accounts",
    "account_id",
    "account_key",
    _ACCOUNT_COLUMNS,
    """o.status IS DISTINCT FROM n.status OR coalesce(o.credit_limit, 0) <> coalesce(n.credit_limit, 0)
   OR coalesce(o.overdraft_limit, 0) <> coalesce(n.overdraft_limit, 0)
   OR coalesce(o.interest_rate, 0) <> coalesce(n.interest_rate, 0)""",
)
STEPS["types"] = """
SELECT * FROM (VALUES (1::BIGINT, 'Purchase', 'Spend', 'DEBIT'), (2, 'ATM Withdrawal', 'Cash', 'DEBIT'),
  (3, 'EFT Transfer Out', 'Transfer', 'DEBIT'), (4, 'EFT Transfer In', 'Transfer', 'CREDIT'),
  (5, 'Debit Order', 'Recurring', 'DEBIT'), (6, 'Salary Credit', 'Income', 'CREDIT'),
  (7, 'Bank Charges', 'Fee', 'DEBIT'), (8, 'Reversal', 'Reversal', 'CREDIT'))
  v(txn_type_key, txn_type_name, txn_category, balance_direction)"""
STEPS["calendar"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(isodow(d) AS SMALLINT) AS day_of_week,
       dayname(d) AS day_name, CAST(day(d) AS SMALLINT) AS day_of_month, CAST(dayofyear(d) AS SMALLINT) AS day_of_year,
       CAST(weekofyear(d) AS SMALLINT) AS week_of_year, CAST(month(d) AS SMALLINT) AS month_number, monthname(d) AS month_name,
       CAST(quarter(d) AS SMALLINT) AS quarter, CAST(year(d) AS SMALLINT) AS year, isodow(d) IN (6, 7) AS is_weekend,
       d = CAST(date_trunc('month', d) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS is_month_end,
       d = CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS is_quarter_end,
       d = CAST(date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS is_year_end,
       CAST(CASE WHEN month(d) >= 3 THEN year(d) ELSE year(d) - 1 END AS SMALLINT) AS fiscal_year,
       CAST(CASE WHEN month(d) BETWEEN 3 AND 5 THEN 1 WHEN month(d) BETWEEN 6 AND 8 THEN 2
                 WHEN month(d) BETWEEN 9 AND 11 THEN 3 ELSE 4 END AS SMALLINT) AS fiscal_quarter
FROM (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2027-12-31', INTERVAL 1 DAY)) AS DATE) AS d) x"""


# Facts


def _fact(source: str, match: str, day: int = 2) -> str:
    """Facts with the dimensions as they were after that day's delivery."""
    text = f"""
SELECT CAST(strftime(s.transaction_date, '%Y%m%d') AS INTEGER) AS date_key, a.account_key, a.customer_key, m.merchant_key,
       b.branch_key, t.txn_type_key, s.transaction_id, s.transaction_date, s.transaction_time,
       CAST(s.transaction_hour AS SMALLINT) AS transaction_hour, CAST(s.amount AS DECIMAL(15,2)) AS amount, s.is_debit,
       CAST(s.balance_after AS DECIMAL(15,2)) AS balance_after, s.status, s.is_fraud_flag,
       CAST(s.fraud_score AS DECIMAL(4,3)) AS fraud_score, s.fraud_risk_band, s.is_weekend, s.is_night_transaction,
       s.amount_band, CAST(s.daily_txn_count AS INTEGER) AS daily_txn_count, s.daily_spend_total, s.reference,
       s.description, s.channel, 'b2' AS dw_batch_id
FROM {source} s
LEFT JOIN d2_accounts a ON s.account_id = a.account_id AND {match}
LEFT JOIN d2_merchants m ON s.merchant_id = m.merchant_id
LEFT JOIN types t ON s.transaction_type = t.txn_type_name
LEFT JOIN d2_branches b ON a.branch_key = b.branch_key"""
    return text.replace("d2_", f"d{day}_")


STEPS["fact"] = _fact("s_transactions_in", "a.scd_is_current")
STEPS["moved"] = "SELECT * REPLACE (transaction_date + 15 AS transaction_date) FROM s_transactions_in"
STEPS["fact_as_of"] = _fact(
    "moved",
    "s.transaction_date >= a.scd_start_date AND (a.scd_end_date IS NULL OR s.transaction_date < a.scd_end_date)",
)

# Three deliveries: a fact is as its id's first dated delivery made it. ``seen_n`` is the table after day n.
STEPS["seen_1"] = f"""
SELECT * REPLACE ('f1' AS dw_batch_id) FROM ({_fact("s_transactions_feed1", "true", 1)}) x WHERE transaction_date IS NOT NULL"""
for _n in (2, 3):
    STEPS[f"seen_{_n}"] = f"""
SELECT * FROM seen_{_n - 1}
UNION ALL
SELECT * REPLACE ('f{_n}' AS dw_batch_id) FROM ({_fact(f"s_transactions_feed{_n}", "a.scd_is_current")}) x
WHERE transaction_date IS NOT NULL AND transaction_id NOT IN (SELECT transaction_id FROM seen_{_n - 1})"""


def _redated(name: str) -> str:
    """A dimension after two loads, moved to the days and batches of the deliveries."""
    day = "CASE {0} WHEN DATE '2024-01-31' THEN DATE '2024-05-01' WHEN DATE '2024-02-01' THEN DATE '2024-05-02' END AS {0}"
    return f"""
SELECT * EXCLUDE (_action) REPLACE ({day.format("scd_start_date")}, {day.format("scd_end_date")},
                                    CASE dw_batch_id WHEN 'b1' THEN 'f1' ELSE 'f2' END AS dw_batch_id)
FROM d2_{name}"""


SQL["silver_three_days"] = "SELECT * EXCLUDE (_ingestion_ts, _batch_id) FROM s_transactions_feed3"
SQL["gold_customers_three_days"] = _redated("customers")
SQL["gold_accounts_three_days"] = _redated("accounts")
SQL["daily_fact"] = """
SELECT *, CAST(year(transaction_date) AS INTEGER) AS transaction_year, CAST(month(transaction_date) AS INTEGER) AS transaction_month
FROM seen_3"""
SQL["fact_rejects"] = """
SELECT transaction_id, account_id, CAST(amount AS DECIMAL(15,2)) AS amount, status, 'undated' AS reason, 'f3' AS dw_batch_id
FROM s_transactions_feed3 WHERE transaction_date IS NULL AND transaction_id NOT IN (SELECT transaction_id FROM seen_2)"""
SQL["daily_audit"] = "\nUNION ALL".join(
    f"""
SELECT 'f{n}' AS batch_id, count(*) FILTER (WHERE dw_batch_id = 'f{n}') AS n_rows, max(transaction_date) AS watermark
FROM seen_{n}"""
    for n in (1, 2, 3)
)

# Marts

STEPS["m_customer_360"] = """
SELECT c.customer_key, c.customer_id, c.full_name, c.age_band, c.province, c.customer_segment, c.income_band, c.risk_rating,
       c.kyc_verified, c.is_active,
       (SELECT count(*) FROM d2_accounts a WHERE a.scd_is_current AND a.customer_id = c.customer_id) AS account_count,
       (SELECT count(*) FROM d2_accounts a
        WHERE a.scd_is_current AND a.customer_id = c.customer_id AND a.status = 'Active') AS active_account_count,
       coalesce(f.n, 0) AS completed_txn_count, CAST(coalesce(f.spend, 0) AS DECIMAL(18,2)) AS total_spend,
       CAST(coalesce(f.income, 0) AS DECIMAL(18,2)) AS total_income, f.last_transaction_date
FROM d2_customers c
LEFT JOIN (SELECT v.customer_id, count(*) AS n, sum(CASE WHEN is_debit THEN amount END) AS spend,
                  sum(CASE WHEN NOT is_debit THEN amount END) AS income, max(transaction_date) AS last_transaction_date
           FROM fact JOIN d2_customers v ON fact.customer_key = v.customer_key
           WHERE fact.status = 'Completed' GROUP BY v.customer_id) f ON f.customer_id = c.customer_id
WHERE c.scd_is_current"""
STEPS["m_fraud_signals"] = """
SELECT transaction_id, transaction_date, account_key, customer_key, merchant_key, channel, amount, status, is_fraud_flag,
       fraud_score, fraud_risk_band,
       CASE WHEN is_fraud_flag THEN 'CRITICAL' ELSE upper(fraud_risk_band) END AS alert_level
FROM fact"""
STEPS["m_daily_summary"] = """
SELECT transaction_date, txn_type_name AS transaction_type, channel, count(*) AS txn_count,
       count(*) FILTER (WHERE status = 'Completed') AS completed_count,
       count(*) FILTER (WHERE status LIKE '%Declined%' OR status = 'Failed') AS declined_count,
       count(*) FILTER (WHERE is_fraud_flag) AS flagged_count, CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount
FROM fact LEFT JOIN types USING (txn_type_key) GROUP BY ALL"""


def _days(source: str) -> str:
    """Account days with their balances."""
    return f"""
SELECT d.account_id, d.transaction_date AS snapshot_date, CAST(strftime(d.transaction_date, '%Y%m%d') AS INTEGER) AS date_key,
       d.closing_balance,
       lag(d.closing_balance) OVER (PARTITION BY d.account_id ORDER BY d.transaction_date) AS opening_balance,
       d.daily_credits, d.daily_debits, d.txn_count, d.closing_balance < 0 AS is_overdrawn
FROM (SELECT account_id, transaction_date,
             CAST(max(balance_after) FILTER (WHERE place = 1) AS DECIMAL(15,2)) AS closing_balance,
             CAST(sum(CASE WHEN is_debit THEN 0 ELSE CAST(amount AS DECIMAL(15,2)) END) AS DECIMAL(15,2)) AS daily_credits,
             CAST(sum(CASE WHEN is_debit THEN CAST(amount AS DECIMAL(15,2)) ELSE 0 END) AS DECIMAL(15,2)) AS daily_debits,
             CAST(count(*) AS INTEGER) AS txn_count
      FROM (SELECT *, row_number() OVER (PARTITION BY account_id, transaction_date
                                         ORDER BY transaction_time DESC, transaction_id DESC) AS place
            FROM {source} WHERE status = 'Completed' AND transaction_date IS NOT NULL) x
      GROUP BY 1, 2) d"""


STEPS["day_facts"] = f"""
SELECT d.* EXCLUDE (account_id), a.account_key, a.customer_key, 'b2' AS dw_batch_id
FROM ({_days("s_transactions_in")}) d LEFT JOIN d2_accounts a ON d.account_id = a.account_id AND a.scd_is_current"""

SQL |= {
    "silver_branches": "SELECT * FROM s_branches_in",
    "silver_merchants": "SELECT * FROM s_merchants_in",
    "silver_customers": "SELECT * FROM s_customers_in",
    "silver_accounts": "SELECT * FROM s_accounts_in",
    "silver_transactions": "SELECT * FROM s_transactions_in",
    "txn_velocity": """
SELECT transaction_id, account_id, transaction_date, daily_txn_count, daily_spend_total FROM v_transactions_in""",
    "dedup_latest": _latest("transactions_in", "transaction_id", "transaction_id, status, _ingestion_ts, _batch_id"),
    "orphan_accounts": """
SELECT account_id, customer_id FROM s_accounts_in a
WHERE NOT EXISTS (SELECT 1 FROM s_customers_in c WHERE c.customer_id = a.customer_id)""",
    "orphan_transactions": """
SELECT transaction_id, account_id FROM s_transactions_in t
WHERE NOT EXISTS (SELECT 1 FROM s_accounts_in a WHERE a.account_id = t.account_id)""",
    "orphan_branches": """
SELECT account_id, branch_id FROM s_accounts_in a
WHERE NOT EXISTS (SELECT 1 FROM s_branches_in b WHERE b.branch_id = a.branch_id)""",
    "orphan_counts": """
SELECT 'accounts_without_customer' AS check_name, count(*) AS n_orphans FROM s_accounts_in a
WHERE NOT EXISTS (SELECT 1 FROM s_customers_in c WHERE c.customer_id = a.customer_id)
UNION ALL
SELECT 'transactions_without_account', count(*) FROM s_transactions_in t
WHERE NOT EXISTS (SELECT 1 FROM s_accounts_in a WHERE a.account_id = t.account_id)
UNION ALL
SELECT 'accounts_without_branch', count(*) FROM s_accounts_in a
WHERE NOT EXISTS (SELECT 1 FROM s_branches_in b WHERE b.branch_id = a.branch_id)""",
    "decline_rate": """
SELECT count(*) AS total, count(*) FILTER (WHERE is_completed) AS completed, count(*) FILTER (WHERE is_declined) AS declined,
       CAST(count(*) FILTER (WHERE is_declined) / greatest(count(*), 1)::DOUBLE * 100 AS DECIMAL(7,4)) AS decline_rate_pct
FROM s_transactions_in""",
    "table_row_counts": """
SELECT 'branches' AS table_name, count(*) AS n_rows FROM s_branches_in
UNION ALL SELECT 'merchants', count(*) FROM s_merchants_in
UNION ALL SELECT 'customers', count(*) FROM s_customers_in
UNION ALL SELECT 'accounts', count(*) FROM s_accounts_in
UNION ALL SELECT 'transactions', count(*) FROM s_transactions_in""",
    "active_accounts": """
SELECT account_id, account_type, account_age_days, has_overdraft FROM s_accounts_in WHERE status = 'Active'""",
    "derived_flags": """
SELECT transaction_id, CAST(substr(transaction_id, 4) AS BIGINT) AS id_number, transaction_id AS rebuilt_id,
       transaction_type NOT IN ('Salary Credit', 'EFT Transfer In', 'Reversal') AS is_debit_type,
       CASE WHEN transaction_type IN ('Salary Credit', 'EFT Transfer In', 'Reversal') THEN amount ELSE -amount END AS signed_amount,
       isodow(transaction_date) IN (6, 7) AS weekend, month(transaction_date) = 12 AS holiday_season,
       strftime(transaction_date, '%Y%m%d') AS date_stamp, upper(substr(description, 1, 8)) AS short_reference,
       '{"channel":"' || channel || '","status":"' || status || '"}' AS metadata
FROM t_transactions_in""",
    "branch_regions": """
SELECT branch_id, city, CASE WHEN city IN ('Johannesburg', 'Cape Town', 'Durban', 'Pretoria') THEN 'Urban'
                             ELSE 'Suburban' END AS region_by_city
FROM s_branches_in""",
    "dim_date": """
SELECT calendar.*, coalesce(n, 0) AS txn_count FROM calendar
LEFT JOIN (SELECT transaction_date, count(*) AS n FROM s_transactions_in GROUP BY 1) t ON full_date = transaction_date""",
    "dim_transaction_type": """
SELECT types.*, coalesce(n, 0) AS txn_count, total FROM types
LEFT JOIN (SELECT transaction_type, count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS total
           FROM s_transactions_in GROUP BY 1) t ON txn_type_name = transaction_type""",
    "scd2_action_counts": """
SELECT 'dim_customers' AS table_name, _action AS outcome, count(*) AS n_rows FROM d2_customers GROUP BY ALL
UNION ALL
SELECT 'dim_accounts', _action, count(*) FROM d2_accounts GROUP BY ALL""",
    "surrogate_keys": f"SELECT customer_id, {_numbered('customer_id')} AS customer_key FROM s_customers_in",
    "fact_watermark": "SELECT coalesce(max(transaction_date), DATE '1900-01-01') AS watermark FROM s_transactions_loaded",
    "fact_incremental_drop": """
SELECT transaction_id, transaction_date FROM s_transactions_in
WHERE transaction_date > (SELECT coalesce(max(transaction_date), DATE '1900-01-01') FROM s_transactions_loaded)""",
    "fact_incremental_antijoin": """
SELECT transaction_id, transaction_date FROM s_transactions_in t
WHERE NOT EXISTS (SELECT 1 FROM s_transactions_loaded l WHERE l.transaction_id = t.transaction_id)""",
    "fact_resolve": "SELECT * FROM fact",
    "fact_as_of": "SELECT transaction_id, transaction_date, account_key, customer_key, branch_key FROM fact_as_of",
    "account_snapshot": "SELECT * FROM day_facts",
    "snapshots_three_days": _days("s_transactions_feed3"),
    "mart_customer_360": "SELECT * FROM m_customer_360",
    "mart_fraud_signals": "SELECT * FROM m_fraud_signals",
    "mart_daily_summary": "SELECT * FROM m_daily_summary",
    "report_customer_360": "SELECT * FROM m_customer_360",
    "report_customer_top": "SELECT * FROM m_customer_360 ORDER BY customer_key LIMIT 100",
    "report_fraud_signals": "SELECT * FROM m_fraud_signals WHERE alert_level IN ('CRITICAL', 'HIGH')",
    "report_daily_summary": "SELECT * FROM m_daily_summary WHERE transaction_date >= DATE '2024-01-15' - 5",
    "append_new_ids": """
SELECT customer_id, email, _batch_id FROM customers_day1
UNION ALL
SELECT customer_id, email, _batch_id FROM customers_day2 WHERE customer_id NOT IN (SELECT customer_id FROM customers_day1)""",
    "next_id": """
SELECT 'customers' AS entity, n AS next_number, printf('CUS%06d', n) AS next_id
FROM (SELECT max(CAST(substr(customer_id, 4) AS BIGINT)) + 1 AS n FROM customers_in) x
UNION ALL
SELECT 'accounts', n, printf('ACC%07d', n)
FROM (SELECT max(CAST(substr(account_id, 4) AS BIGINT)) + 1 AS n FROM accounts_in) x
UNION ALL
SELECT 'transactions', n, printf('TXN%09d', n)
FROM (SELECT max(CAST(substr(transaction_id, 4) AS BIGINT)) + 1 AS n FROM transactions_in) x""",
    "bronze_ingest": """
SELECT * EXCLUDE (_ingestion_ts, _batch_id), 'b2' AS _batch_id, '2024-02-01T00:00:00' AS _ingestion_ts,
       '2024-02-01' AS _ingestion_date, DATE '2024-02-01' AS date
FROM accounts_in""",
    "bronze_row_numbers": """
SELECT 'branches' AS table_name, count(*) AS n_rows, true AS dense FROM branches_in
UNION ALL SELECT 'merchants', count(*), true FROM merchants_in
UNION ALL SELECT 'customers', count(*), true FROM customers_in
UNION ALL SELECT 'accounts', count(*), true FROM accounts_in
UNION ALL SELECT 'transactions', count(*), true FROM transactions_in""",
    "bronze_rejects": """
SELECT CASE WHEN good THEN merchant_id END AS merchant_id,
       CASE WHEN good THEN merchant_name || CASE WHEN n % 10 = 3 THEN chr(10) || 'and, sons' ELSE '' END END AS merchant_name,
       row_number() OVER (PARTITION BY n // 500 ORDER BY n) AS source_row_number,
       CASE WHEN good THEN 'loaded' WHEN n % 10 = 5 THEN 'few fields' ELSE 'many fields' END AS reason,
       CASE n % 10 WHEN 5 THEN concat_ws(',', merchant_id, merchant_name)
            WHEN 7 THEN concat_ws(',', merchant_id, merchant_name, merchant_category, mcc_code, is_online, 'extra') END AS record
FROM (SELECT *, n % 10 NOT IN (5, 7) AS good
      FROM (SELECT *, CAST(substr(merchant_id, 4) AS BIGINT) AS n FROM merchants_in) x) m""",
}


# Quality


def _check(table: str, name: str, kind: str, severity: str, source: str, failed: str, rows: str = "count(*)", example: str = "NULL") -> str:
    return f"""
SELECT '{table}' AS table_name, '{name}' AS check_name, '{kind}' AS check_type, failed = 0 AS passed,
       CAST(n AS BIGINT) AS rows_checked, CAST(failed AS BIGINT) AS rows_failed,
       CAST(failed / greatest(n, 1)::DOUBLE * 100 AS DECIMAL(5,2)) AS failure_pct, '{severity}' AS severity,
       CASE WHEN example IS NULL THEN '{{}}' ELSE '{{"example":"' || example || '"}}' END AS details
FROM (SELECT {rows} AS n, {failed} AS failed, {example} AS example FROM {source}) x"""


def _row_check(table: str, name: str, kind: str, severity: str, source: str, key: str, bad: str) -> str:
    failed = f"count(*) FILTER (WHERE {bad})"
    return _check(table, name, kind, severity, source, failed, example=f"min(CAST({key} AS VARCHAR)) FILTER (WHERE {bad})")


def _unique(table: str, name: str, source: str, key: str) -> str:
    grouped = f"(SELECT {key} AS k, count(*) AS c FROM {source} WHERE {key} IS NOT NULL GROUP BY 1) g"
    return _check(table, name, "unique", "critical", grouped, "coalesce(sum(c - 1), 0)", "coalesce(sum(c), 0)",
                  "min(CAST(k AS VARCHAR)) FILTER (WHERE c > 1)")


def _known(table: str, key: str, source: str, parent: str, orphan: bool) -> str:
    kind = "orphan" if orphan else "foreign_key"
    bad = f"NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = s.{key})"
    bad = bad if orphan else f"{key} IS NOT NULL AND {bad}"
    flagged = f"(SELECT {key} AS k, {bad} AS bad FROM {source} s) g"
    return _row_check(table, f"{key}_{kind}", kind, "warning", flagged, "k", "bad")


def _chain(table: str, key: str) -> str:
    source = table.replace("dim_", "d2_")
    flagged = f"""(SELECT {key}, scd_version <> row_number() OVER w
        OR scd_end_date IS DISTINCT FROM lead(scd_start_date) OVER w AS bad
      FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY scd_version)) g"""
    return _row_check(table, f"{key}_version_chain", "version_chain", "critical", flagged, key, "bad")


def _agrees(column: str, expected: str) -> str:
    bad = f"{column} IS DISTINCT FROM ({expected})"
    return _row_check("transactions", f"{column}_agrees", "consistency", "warning", "t_transactions_in", "transaction_id", bad)


# Widths of the staged columns (fixed values).
_WIDTHS = {
    "transaction_id": 50, "account_id": 20, "merchant_id": 20, "transaction_type": 50, "status": 50,
    "fraud_risk_band": 20, "amount_band": 20, "reference": 50, "description": 255, "channel": 50,
}

_TXN = ("transactions", "s_transactions_in", "transaction_id")
SQL["derived_flags_agree"] = "\nUNION ALL".join([
    _agrees("is_weekend", "isodow(transaction_date) IN (6, 7)"),
    _agrees("is_holiday_season", "month(transaction_date) = 12"),
    _agrees("is_debit", "transaction_type NOT IN ('Salary Credit', 'EFT Transfer In', 'Reversal')"),
])
_PARENTS = {
    "date_key": "calendar", "account_key": "d2_accounts", "customer_key": "d2_customers", "merchant_key": "d2_merchants",
    "branch_key": "d2_branches", "txn_type_key": "types",
}
# Table, its rows here, the column of its examples, and what may not be null: for a dimension its two keys.
_REQUIRED = (
    ("dim_customers", "d2_customers", "customer_key", "customer_key customer_id"),
    ("dim_accounts", "d2_accounts", "account_key", "account_key account_id"),
    ("dim_merchants", "d2_merchants", "merchant_key", "merchant_key merchant_id"),
    ("dim_branches", "d2_branches", "branch_key", "branch_key branch_id"),
    ("dim_transaction_type", "types", "txn_type_key", "txn_type_key txn_type_name"),
    ("dim_date", "calendar", "date_key", "date_key full_date"),
    ("fact_transactions", "fact", "transaction_id", "transaction_id transaction_date amount"),
    ("fact_account_snapshots", "day_facts", "snapshot_date", "snapshot_date"),
)
SQL["dq_results"] = "\nUNION ALL".join(
    [
        _row_check("transactions", f"{c}_not_null", "not_null", "critical", _TXN[1], _TXN[2], f"{c} IS NULL")
        for c in ("transaction_id", "account_id", "amount")
    ]
    + [
        _row_check("transactions", f"{c}_width", "width", "warning", _TXN[1], _TXN[2], f"length({c}) > {w}")
        for c, w in _WIDTHS.items()
    ]
    + [
        _row_check("transactions", f"{c}_precision", "precision", "warning", _TXN[1], _TXN[2],
                   f"{c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL")
        for c, t in (("amount", "DECIMAL(15,2)"), ("fraud_score", "DECIMAL(4,3)"), ("balance_after", "DECIMAL(15,2)"),
                     ("daily_spend_total", "DECIMAL(15,2)"))
    ]
    + [
        _unique("transactions", "transaction_id_unique", "s_transactions_in", "transaction_id"),
        _known("accounts", "customer_id", "s_accounts_in", "s_customers_in", True),
        _known("transactions", "account_id", "s_transactions_in", "s_accounts_in", True),
        _known("accounts", "branch_id", "s_accounts_in", "s_branches_in", True),
        _unique("dim_customers", "customer_id_one_current", "(SELECT * FROM d2_customers WHERE scd_is_current) y", "customer_id"),
        _unique("dim_accounts", "account_id_one_current", "(SELECT * FROM d2_accounts WHERE scd_is_current) y", "account_id"),
        _chain("dim_customers", "customer_id"),
        _chain("dim_accounts", "account_id"),
        _row_check("fact_transactions", "account_key_not_null", "not_null", "warning", "fact", "transaction_id", "account_key IS NULL"),
        *(_known("fact_transactions", key, "fact", parent, False) for key, parent in _PARENTS.items()),
        *(_known("fact_account_snapshots", key, "day_facts", _PARENTS[key], False)
          for key in ("date_key", "account_key", "customer_key")),
        _known("dim_accounts", "customer_key", "d2_accounts", "d2_customers", False),
    ]
    + [
        _row_check(table, f"{c}_not_null", "not_null", "critical", source, example, f"{c} IS NULL")
        for table, source, example, columns in _REQUIRED
        for c in columns.split()
    ]
    + [
        _unique(table, f"{c}_unique", source, c)
        for table, source, _, columns in _REQUIRED
        if table.startswith("dim_")
        for c in (columns.split()[:1] if table in ("dim_customers", "dim_accounts") else columns.split())
    ]
)


def with_steps(select: str) -> str:
    """The query with the stand-in views and steps it needs, in the order they are defined."""
    steps = duckdb_ctes() | STEPS
    needed: set[str] = set()
    pending = [select]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & steps.keys() - needed:
            needed.add(name)
            pending.append(steps[name])
    listed = ",\n".join(f"{name} AS ({text.strip()})" for name, text in steps.items() if name in needed)
    return f"WITH {listed}\n{select.strip()}" if listed else select


def all_sql() -> dict[str, str]:
    return {name: with_steps(text) for name, text in SQL.items()}
