"""SQL building blocks of the independent results: the star as common table expressions."""

from __future__ import annotations

# --- fixed values: stated here once more, so that the SQL does not follow the library -----------------

CURRENCIES = (
    "'USD', 'EUR', 'GBP', 'JPY', 'CAD', 'AUD', 'CHF', 'CNY', 'INR', 'MXN', "
    "'BRL', 'KRW', 'SGD', 'HKD', 'NOK', 'SEK', 'DKK', 'NZD', 'ZAR', 'RUB'"
)
STRICT_CURRENCIES = "'USD', 'EUR', 'GBP', 'JPY', 'CAD'"
STATUSES = "'COMPLETED', 'PENDING', 'FAILED', 'CANCELLED', 'REFUNDED'"
TRANSACTION_TYPES = "'PURCHASE', 'REFUND', 'TRANSFER', 'PAYMENT', 'WITHDRAWAL', 'DEPOSIT'"
CHANNELS = "'ONLINE', 'MOBILE', 'POS', 'ATM', 'BRANCH'"
MERCHANT_CATEGORIES = [
    "RETAIL", "GROCERY", "RESTAURANT", "GAS", "TRAVEL", "ENTERTAINMENT", "UTILITIES", "HEALTHCARE", "EDUCATION", "OTHER",
]
MCC_CODES = {
    "RETAIL": "5411", "GROCERY": "5411", "RESTAURANT": "5812", "GAS": "5541", "TRAVEL": "4722", "ENTERTAINMENT": "7922",
    "UTILITIES": "4900", "HEALTHCARE": "8011", "EDUCATION": "8220", "OTHER": "5999",
}
COUNTRIES = ["US", "CA", "MX", "GB", "DE", "FR", "IT", "ES", "JP", "CN", "IN", "AU", "BR"]
RATES = """rates(code, rate) AS (
  SELECT code, CAST(rate AS DECIMAL(10,5)) FROM (VALUES
    ('USD', '1.0'), ('EUR', '1.08'), ('GBP', '1.26'), ('JPY', '0.0067'), ('CAD', '0.74'), ('AUD', '0.65'), ('CHF', '1.12'),
    ('CNY', '0.14'), ('INR', '0.012'), ('MXN', '0.058'), ('BRL', '0.20'), ('KRW', '0.00075'), ('SGD', '0.74'), ('HKD', '0.13'),
    ('NOK', '0.092'), ('SEK', '0.095'), ('DKK', '0.14'), ('NZD', '0.61'), ('ZAR', '0.054'), ('RUB', '0.011')) AS v(code, rate))"""


def text_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def case(column: str, mapping: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def nth(values, index: str) -> str:
    return f"([{text_list(values)}])[({index}) % {len(values)} + 1]"


def half_up(numerator: str, denominator: str, places: int) -> str:
    """Exact rounding of a quotient of non-negative integers."""
    scale = 10 ** places
    return (
        f"CAST((2 * ({numerator}) * {scale} + ({denominator})) // (2 * ({denominator})) AS DOUBLE) / {scale}"
    )


def ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


SUM_USD = "CAST(sum(amount_usd) AS DOUBLE)"
AVG_USD = "CAST(sum(amount_usd) AS DOUBLE) / count(amount_usd)"
CENTS = "CAST(sum(CAST(amount_usd * 100 AS BIGINT)) AS BIGINT)"
AVG2 = half_up(CENTS, "count(amount_usd) * 100", 2)
FRAUDS = "count(*) FILTER (WHERE is_fraud)"
CUSTOMERS = "count(DISTINCT customer_key)"
MERCHANTS = "count(DISTINCT merchant_key)"


def completed_count(status: str = "COMPLETED") -> str:
    return f"count(*) FILTER (WHERE status = '{status}')"


def pct_change(current: str, previous: str) -> str:
    return (
        f"CASE WHEN {previous} > 0 THEN round(CAST({current} - {previous} AS DOUBLE)"
        f" / CAST({previous} AS DOUBLE) * 100, 2) END"
    )


SEGMENT = (
    "CASE WHEN lifetime_value_usd >= 10000 THEN 'Premium' WHEN lifetime_value_usd >= 5000 THEN 'Gold' "
    "WHEN lifetime_value_usd >= 1000 THEN 'Silver' ELSE 'Bronze' END"
)
TIER = (
    "CASE WHEN total_revenue_usd >= 100000 THEN 'Enterprise' WHEN total_revenue_usd >= 50000 THEN 'Large' "
    "WHEN total_revenue_usd >= 10000 THEN 'Medium' ELSE 'Small' END"
)

_REGION_CURRENCY = {
    "AMERICA": "USD", "EUROPE": "EUR", "ASIA": "JPY", "AFRICA": "ZAR", "MIDDLE EAST": "AED",
}
_CHANNEL = {
    "1-URGENT": "ONLINE", "2-HIGH": "MOBILE", "3-MEDIUM": "POS", "4-NOT SPECIFIED": "ATM", "5-LOW": "BRANCH",
}
_TYPE = {"A": "PURCHASE", "N": "PAYMENT", "R": "REFUND"}
_STATUS = {"F": "COMPLETED", "P": "FAILED", "O": "PENDING"}
_STATUS_SQL = f"CASE WHEN l_returnflag = 'R' THEN 'REFUNDED' ELSE {case('o_orderstatus', _STATUS)} END"

CTES = {
    "rates": RATES,
    "merchants": f"""merchants AS (
  SELECT s_suppkey AS merchant_key, CAST(s_suppkey AS VARCHAR) AS merchant_id, s_name AS merchant_name,
         {nth(MERCHANT_CATEGORIES, 's_nationkey')} AS category,
         {nth(COUNTRIES, 's_nationkey')} AS country_code, n_name AS city,
         {case(nth(MERCHANT_CATEGORIES, 's_nationkey'), MCC_CODES)} AS mcc_code,
         {case('r_name', _REGION_CURRENCY)} AS currency
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)""",
    "customers": f"""customers AS (
  SELECT c_custkey AS customer_key, CAST(c_custkey AS VARCHAR) AS customer_id,
         split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) AS full_name,
         n_name AS nation, c_mktsegment AS market,
         {nth(COUNTRIES, 'c_nationkey')} AS country_code,
         CAST(DATE '1990-01-01' + c_nationkey * 60 AS DATE) AS customer_since
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)""",
    "fact": f"""fact AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id, o_custkey AS customer_key,
         l_orderkey AS account_key, l_suppkey AS merchant_key,
         CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(l_shipdate AS DATE) AS full_date,
         l_shipdate AS transaction_timestamp, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, currency,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * coalesce(rate, CAST(1 AS DECIMAL(10,5))), 2)
              AS DECIMAL(18,2)) AS amount_usd,
         {case('l_returnflag', _TYPE)} AS transaction_type, {_STATUS_SQL} AS status,
         {case('o_orderpriority', _CHANNEL)} AS channel, country_code,
         CAST(l_extendedprice AS DECIMAL(18,2)) > 100000 AS is_fraud
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN merchants ON l_suppkey = merchant_key LEFT JOIN rates ON currency = code)""",
    "order_fact": f"""order_fact AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, o_custkey AS customer_key, o_orderkey AS transaction_key,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(o_orderdate AS DATE) AS full_date,
         o_orderdate AS transaction_timestamp, CAST(o_totalprice AS DECIMAL(18,2)) AS amount_usd,
         {case('o_orderstatus', _STATUS)} AS status, {case('o_orderpriority', _CHANNEL)} AS channel,
         CAST(o_totalprice AS DECIMAL(18,2)) > 400000 AS is_fraud
  FROM orders)""",
    "clean": f"""clean AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(l_orderkey AS VARCHAR) AS account_id, CAST(l_suppkey AS VARCHAR) AS merchant_id,
         strftime(l_shipdate, '%Y-%m-%d') AS transaction_date, {ts('l_shipdate')} AS transaction_timestamp,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS amount, currency,
         {case('l_returnflag', _TYPE)} AS transaction_type, {_STATUS_SQL} AS status,
         {case('o_orderpriority', _CHANNEL)} AS channel, country_code,
         {case('l_returnflag', _TYPE)} || ' at ' || merchant_name AS description,
         CAST(l_quantity AS INTEGER) AS q, CAST(l_shipdate AS DATE) AS shipped
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN merchants ON l_suppkey = merchant_key)""",
    "delivered": """delivered AS (
  SELECT CASE WHEN q IN (1, 2, 7) THEN 'TEST_NULL_' || transaction_id
              WHEN q = 3 THEN 'TEST_NEG_' || transaction_id
              WHEN q IN (5, 6) THEN 'TEST_BADCUR_' || transaction_id
              WHEN q IN (8, 9) THEN 'TEST_BADDATE_' || transaction_id
              WHEN q IN (14, 15, 16) THEN 'TEST_ORPHAN_' || transaction_id
              WHEN q = 17 THEN 'TEST_DUP_' || transaction_id
              WHEN q = 13 THEN NULL ELSE transaction_id END AS transaction_id,
         CASE WHEN q = 1 THEN NULL WHEN q = 14 THEN 'ORPHAN_CUST_12345' ELSE customer_id END AS customer_id,
         CASE WHEN q = 15 THEN 'ORPHAN_ACCT_12345' ELSE account_id END AS account_id,
         CASE WHEN q = 16 THEN 'ORPHAN_MERCH_12345' ELSE merchant_id END AS merchant_id,
         CASE WHEN q = 8 THEN 'not-a-date' WHEN q = 9 THEN '2024-02-30' ELSE transaction_date END AS transaction_date,
         transaction_timestamp,
         CASE WHEN q = 2 THEN NULL WHEN q IN (3, 18) THEN '-' || amount WHEN q = 4 THEN 'abc' WHEN q = 19 THEN '0'
              WHEN q = 20 THEN '.5' WHEN q = 21 THEN '12.' WHEN q = 22 THEN '1e3' ELSE amount END AS amount,
         CASE WHEN q = 5 THEN 'XXX' WHEN q = 6 THEN '' WHEN q = 7 THEN NULL WHEN q = 18 THEN 'INVALID'
              ELSE currency END AS currency,
         CASE WHEN q = 11 THEN 'FEE' ELSE transaction_type END AS transaction_type,
         CASE WHEN q IN (10, 18) THEN 'UNKNOWN' ELSE status END AS status,
         CASE WHEN q = 12 THEN 'PHONE' ELSE channel END AS channel,
         country_code, description, q, shipped FROM clean)""",
    "raw": """raw AS (
  SELECT CAST(shipped + 1 AS TIMESTAMP) AS _ingestion_timestamp, 'lineitem.parquet' AS _source_file,
         'orders' AS _source_system, 'B' || strftime(shipped, '%Y%m') AS _batch_id,
         CAST(shipped + 1 AS DATE) AS _load_date, * EXCLUDE (q, shipped) FROM delivered)""",
    "judged": f"""judged AS (
  SELECT *, transaction_id IS NULL AS null_transaction_id, amount IS NULL AS null_amount,
         coalesce(NOT regexp_matches(amount, '^-?[0-9]+[.]?[0-9]*$'), FALSE) AS invalid_amount,
         coalesce(TRY_CAST(amount AS DOUBLE) < 0, FALSE) AS negative_amount,
         coalesce(currency NOT IN ({CURRENCIES}), FALSE) AS invalid_currency,
         coalesce(status NOT IN ({STATUSES}), FALSE) AS invalid_status,
         coalesce(transaction_type NOT IN ({TRANSACTION_TYPES}), FALSE) AS invalid_transaction_type,
         coalesce(channel NOT IN ({CHANNELS}), FALSE) AS invalid_channel,
         transaction_date IS NOT NULL AND try_strptime(transaction_date, '%Y-%m-%d') IS NULL AS invalid_date
  FROM raw)""",
    "valid": """valid AS (
  SELECT * FROM judged WHERE NOT (null_transaction_id OR null_amount OR invalid_amount OR negative_amount
    OR invalid_currency OR invalid_status OR invalid_transaction_type OR invalid_channel OR invalid_date))""",
    "typed": """typed AS (
  SELECT transaction_id, customer_id, account_id, merchant_id,
         try_strptime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS transaction_timestamp,
         CAST(try_strptime(transaction_date, '%Y-%m-%d') AS DATE) AS transaction_date,
         TRY_CAST(amount AS DECIMAL(18,2)) AS amount, currency, transaction_type, status, channel,
         country_code, description, _batch_id FROM valid)""",
    "rejected": "rejected AS (" + " UNION ALL ".join(
        f"SELECT *, '{r}' AS reason FROM judged WHERE {r}" for r in (
            "null_transaction_id", "null_amount", "invalid_amount", "negative_amount", "invalid_currency",
            "invalid_status", "invalid_transaction_type", "invalid_channel", "invalid_date",
        )
    ) + ")",
    "strict": f"""strict AS (
  SELECT *, coalesce(transaction_id IS NOT NULL AND TRY_CAST(amount AS DECIMAL(18,2)) > 0
         AND currency IN ({STRICT_CURRENCIES}) AND customer_id IS NOT NULL, FALSE) AS ok FROM raw)""",
    "accounts": """accounts AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS account_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         'CHECKING' AS account_type, lpad(CAST(o_orderkey AS VARCHAR), 16, '0') AS account_number,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS balance, 'USD' AS currency,
         o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS opened_date,
         CAST(NULL AS VARCHAR) AS closed_date FROM orders)""",
    "customer_deliveries": f"""customer_deliveries AS (
  SELECT customer_id, first_name, last_name,
         lower(last_name) || '@' || lower(substr(o_orderpriority, 3, 20)) || '.com' AS email,
         '+1' || o_orderkey AS phone, '1980-02-30' AS date_of_birth, country_code,
         {ts('o_orderdate')} AS created_at, {ts('o_orderdate')} AS updated_at
  FROM orders LEFT JOIN customers ON o_custkey = customer_key)""",
    "calendar": """calendar AS (
  SELECT CAST(d AS DATE) AS full_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, year(d) AS year,
         quarter(d) AS quarter, month(d) AS month, strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short,
         weekofyear(d) AS week_of_year, day(d) AS day_of_month, isodow(d) AS day_of_week, strftime(d, '%A') AS day_name,
         strftime(d, '%a') AS day_short, isodow(d) >= 6 AS is_weekend, day(d) = 1 AS is_month_start,
         d = last_day(d) AS is_month_end,
         CASE WHEN month(d) >= 7 THEN year(d) ELSE year(d) - 1 END AS fiscal_year,
         ((month(d) + 5) % 12) // 3 + 1 AS fiscal_quarter, isoyear(d) AS iso_year
  FROM (SELECT unnest(generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY)) AS d))""",
}

NEEDS = {
    "fact": ["rates", "merchants"],
    "clean": ["merchants"],
    "delivered": ["clean"],
    "raw": ["delivered"],
    "judged": ["raw"],
    "valid": ["judged"],
    "typed": ["valid"],
    "rejected": ["judged"],
    "strict": ["raw"],
    "customer_deliveries": ["customers"],
}


def sql(body: str, *tables: str) -> str:
    """A statement with the common table expressions it uses, in dependency order."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in tables:
        add(name)
    if not order:
        return body
    head = ",\n".join(CTES[n] for n in order)
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {head},\n{body.lstrip()[5:]}"
    return f"WITH {head}\n{body}"
