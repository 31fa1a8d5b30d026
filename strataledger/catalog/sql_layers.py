"""The layers in plain SQL, written apart from the Spark plans, as shared WITH clauses."""

from __future__ import annotations

from strataledger.sources.feeds import ACCOUNT_DATES, FIRST_RUN_END

FIRST = f"DATE '{FIRST_RUN_END}'"
END = "(SELECT MAX(date) FROM bronze)"


def _bronze(file_date: str) -> str:
    return f"""
ev AS (
  SELECT event_id, CAST(ts AS DATE) AS day, user_id, event_type,
         CAST(value AS DECIMAL(18,2)) - 2 AS amount,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events),
sent AS (SELECT *, 0 AS send FROM ev UNION ALL SELECT *, 1 AS send FROM ev WHERE event_id % 50 = 0),
bronze AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CASE WHEN send = 1 OR k <> 0 THEN CAST(user_id AS VARCHAR) END AS account_id,
         day AS transaction_date, amount, event_type AS transaction_code,
         CASE WHEN send = 1 OR k % 7 <> 0 THEN 'm' || CAST(k AS VARCHAR) END AS merchant_name,
         CASE WHEN send = 1 THEN 'ONLINE' WHEN k % 10 = 9 OR (event_id % 50 = 0 AND k % 2 = 1) THEN 'DRIVE_THRU'
              WHEN k % 2 = 0 THEN 'ONLINE' ELSE 'IN_STORE' END AS channel,
         CAST({file_date} AS DATE) AS date, event_id * 2 + send AS row_tag
  FROM sent)"""


BRONZE = _bronze("day + CAST(send * (1 + (event_id // 50) % 4) AS INTEGER)")
BRONZE_SAME_DAY = _bronze("day")

CODES = """
codes AS (
  SELECT * FROM (VALUES ('purchase', 'Purchase', 'DR', 'PURCHASE', true), ('signup', 'Payment', 'CR', 'PAYMENT', true),
                        ('view', 'Annual fee', 'DR', 'FEE', true), ('click', 'Interest charge', 'DR', 'INTEREST', true))
  AS t(transaction_code, description, debit_credit_indicator, transaction_type, affects_balance))"""

ORDER_CODES = """
codes AS (
  SELECT * FROM (VALUES ('O', 'DR', 'PURCHASE'), ('F', 'CR', 'PAYMENT'), ('P', 'DR', 'FEE'))
  AS t(transaction_code, debit_credit_indicator, transaction_type))"""

LINEITEM_CODES = """
codes AS (
  SELECT * FROM (VALUES ('N', 'DR', 'PURCHASE'), ('R', 'CR', 'PAYMENT'), ('A', 'DR', 'INTEREST'))
  AS t(transaction_code, debit_credit_indicator, transaction_type))"""

ORDERS = """
bronze AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS account_id,
         CAST(o_orderdate AS DATE) AS transaction_date, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         o_orderstatus AS transaction_code,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS merchant_name,
         CASE WHEN o_orderpriority < '3' THEN 'ONLINE' ELSE 'IN_STORE' END AS channel,
         CAST(o_orderdate AS DATE) AS date
  FROM orders)"""

LINEITEMS = """
bronze AS (
  SELECT l.l_orderkey || '-' || l.l_linenumber AS transaction_id, CAST(o.o_custkey AS VARCHAR) AS account_id,
         CAST(l_shipdate AS DATE) AS transaction_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         l_returnflag AS transaction_code, l_linestatus AS merchant_name,
         CASE WHEN l_linestatus = 'O' THEN 'ONLINE' ELSE 'IN_STORE' END AS channel,
         CAST(l_shipdate AS DATE) AS date
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_FILES = " UNION ALL ".join(
    f"SELECT {i} AS file, DATE '{day}' AS date" for i, day in enumerate(ACCOUNT_DATES)
)

ACCOUNTS = f"""
files AS ({_FILES}),
bronze_accounts AS (
  SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_name AS customer_name,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'ACTIVE' WHEN c_mktsegment = 'FURNITURE'
              THEN 'SUSPENDED' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'CLOSED' ELSE c_mktsegment END AS account_status,
         CAST(5000 + c_nationkey * 100 AS DECIMAL(18,2)) AS credit_limit,
         CASE WHEN c_acctbal >= -900 THEN CAST(c_acctbal AS DECIMAL(18,2))
              + CASE file WHEN 2 THEN 10 WHEN 3 THEN 20 ELSE 0 END END AS current_balance,
         DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS open_date,
         DATE '2024-01-01' AS billing_cycle_start, DATE '2024-01-31' AS billing_cycle_end, date
  FROM customer JOIN files ON (file = 0 AND c_nationkey < 20) OR (file = 1 AND c_nationkey >= 20)
                           OR (file = 2 AND c_custkey % 3 = 0) OR (file = 3 AND c_custkey % 5 = 0)),
classified_accounts AS (
  SELECT *, CASE WHEN account_id IS NULL OR account_id = '' OR account_status IS NULL OR account_status = ''
                      OR credit_limit IS NULL OR current_balance IS NULL OR open_date IS NULL
                      OR billing_cycle_start IS NULL OR billing_cycle_end IS NULL THEN 'NULL_REQUIRED_FIELD'
                 WHEN account_status NOT IN ('ACTIVE', 'SUSPENDED', 'CLOSED') THEN 'INVALID_ACCOUNT_STATUS' END AS reason
  FROM bronze_accounts),
passing_accounts AS (SELECT * FROM classified_accounts WHERE reason IS NULL),
accounts AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY date DESC) AS rn FROM passing_accounts) WHERE rn = 1),
first_run_accounts AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY date DESC) AS rn FROM passing_accounts
  WHERE date <= {FIRST}) WHERE rn = 1),
first_seen AS (SELECT account_id, MIN(date) AS first_seen_date FROM passing_accounts GROUP BY account_id)"""

_RULES = """
checked AS (
  SELECT b.*, c.debit_credit_indicator, c.transaction_type, c.transaction_code IS NOT NULL AS code_known,
         CASE WHEN transaction_id IS NULL OR transaction_id = '' OR account_id IS NULL OR account_id = ''
                   OR transaction_date IS NULL OR amount IS NULL OR b.transaction_code IS NULL
                   OR b.transaction_code = '' OR channel IS NULL OR channel = '' THEN 'NULL_REQUIRED_FIELD'
              WHEN amount <= 0 THEN 'INVALID_AMOUNT' END AS basic
  FROM bronze b LEFT JOIN codes c ON b.transaction_code = c.transaction_code),
placed AS (
  SELECT *, MIN(CASE WHEN basic IS NULL AND code_known AND channel IN ('ONLINE', 'IN_STORE') THEN {position} END)
            OVER (PARTITION BY transaction_id) AS first_ok
  FROM checked),
classified AS (
  SELECT *, CASE WHEN basic IS NOT NULL THEN basic WHEN {position} > first_ok THEN 'DUPLICATE_TRANSACTION_ID'
                 WHEN NOT code_known THEN 'INVALID_TRANSACTION_CODE'
                 WHEN channel NOT IN ('ONLINE', 'IN_STORE') THEN 'INVALID_CHANNEL' END AS reason
  FROM placed)"""

CLASSIFIED = _RULES.format(position="date")
CLASSIFIED_IN_FILE = _RULES.format(position="row_tag")

SILVER = f"""
silver AS (
  SELECT c.*, CASE debit_credit_indicator WHEN 'DR' THEN amount WHEN 'CR' THEN -1 * amount END AS signed,
         COALESCE(first_seen_date <= date, false) AS resolvable,
         transaction_type = 'PURCHASE' AND merchant_name IS NULL AS missing_merchant,
         CAST(date_trunc('week', transaction_date) AS DATE) AS week
  FROM classified c LEFT JOIN first_seen f ON c.account_id = f.account_id WHERE reason IS NULL),
first_run_silver AS (SELECT * FROM silver WHERE date <= {FIRST}),
quarantine AS (SELECT * FROM classified WHERE reason IS NOT NULL)"""


def daily(name: str, source: str, low: str | None = None, high: str | None = None) -> str:
    """Daily summary CTE over a silver CTE; bounds default to its own first and last day."""
    low = low or f"(SELECT MIN(transaction_date) FROM {source})"
    high = high or f"(SELECT MAX(transaction_date) FROM {source})"
    kinds = "".join(
        f"""
         COUNT(*) FILTER (WHERE resolvable AND transaction_type = '{k}') AS {k.lower()}_count,
         CAST(COALESCE(SUM(signed) FILTER (WHERE resolvable AND transaction_type = '{k}'), 0) AS DOUBLE) AS {k.lower()}_sum,"""
        for k in ("PURCHASE", "PAYMENT", "FEE", "INTEREST")
    )
    return f"""
{name}_days AS (SELECT CAST(unnest(generate_series(CAST({low} AS TIMESTAMP), CAST({high} AS TIMESTAMP),
                       INTERVAL 1 DAY)) AS DATE) AS day),
{name} AS (
  SELECT day AS transaction_date,
         COUNT(*) FILTER (WHERE resolvable) AS total_transactions,
         CAST(COALESCE(SUM(signed) FILTER (WHERE resolvable), 0) AS DOUBLE) AS total_signed_amount,{kinds}
         COUNT(*) FILTER (WHERE resolvable AND channel = 'ONLINE') AS online_transactions,
         COUNT(*) FILTER (WHERE resolvable AND channel = 'IN_STORE') AS instore_transactions,
         COUNT(*) FILTER (WHERE NOT resolvable) AS total_unresolvable_transactions,
         CAST(COALESCE(SUM(signed) FILTER (WHERE NOT resolvable), 0) AS DOUBLE) AS total_unresolvable_amount,
         (SELECT MIN(transaction_date) FROM {source}) AS _source_period_start,
         (SELECT MAX(transaction_date) FROM {source}) AS _source_period_end
  FROM {name}_days LEFT JOIN {source} s ON s.transaction_date = day
  GROUP BY day)"""


def weekly(name: str, source: str, accounts: str, weeks: str) -> str:
    """Weekly summary CTE; ``weeks`` is a condition on ``week``."""
    sums = "".join(
        f"""
           CAST(COALESCE(SUM(signed) FILTER (WHERE transaction_type = '{k}'), 0) AS DOUBLE) AS {c},"""
        for k, c in (("PAYMENT", "total_payments"), ("FEE", "total_fees"), ("INTEREST", "total_interest"))
    )
    return f"""
{name} AS (
  SELECT g.*, CAST(a.current_balance AS DOUBLE) AS closing_balance
  FROM (
    SELECT week AS week_start_date, week + 6 AS week_end_date, account_id,
           COUNT(*) FILTER (WHERE transaction_type = 'PURCHASE') AS total_purchases,{sums}
           CAST(SUM(signed) FILTER (WHERE transaction_type = 'PURCHASE') AS DOUBLE)
             / NULLIF(COUNT(*) FILTER (WHERE transaction_type = 'PURCHASE'), 0) AS avg_purchase_amount
    FROM {source} WHERE resolvable AND {weeks} GROUP BY week, account_id) g
  JOIN {accounts} a ON g.account_id = a.account_id)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(part.strip("\n") for part in parts) + "\n"


EVENTS = (BRONZE, CODES, CLASSIFIED)
LAYERS = (BRONZE, CODES, CLASSIFIED, ACCOUNTS, SILVER)

FIRST_WEEKLY = weekly("first_weekly", "first_run_silver", "first_run_accounts", f"week + 6 <= {FIRST}")
REGISTERED = f"""
registered AS (SELECT DISTINCT week FROM first_run_silver WHERE resolvable AND week + 6 <= {FIRST})"""
SECOND_WEEKLY = weekly(
    "second_weekly", "silver", "accounts", f"week + 6 <= {END} AND week NOT IN (SELECT week FROM registered)"
)
ALL_WEEKLY = weekly("all_weekly", "silver", "accounts", f"week + 6 <= {END}")

WEEKLY_COLUMNS = (
    "week_start_date, week_end_date, account_id, total_purchases, avg_purchase_amount, "
    "total_payments, total_fees, total_interest, closing_balance"
)
