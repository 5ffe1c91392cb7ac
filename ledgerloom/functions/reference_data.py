"""Code lists, exchange rates, country table, thresholds, id markers.

Everything here is a constant the results depend on; nothing here is logic.
"""

from decimal import Decimal

# --- fixed values: accepted codes -------------------------------------------------
CURRENCIES = [
    "USD", "EUR", "GBP", "JPY", "CAD", "AUD", "CHF", "CNY", "INR", "MXN",
    "BRL", "KRW", "SGD", "HKD", "NOK", "SEK", "DKK", "NZD", "ZAR", "RUB",
]
STATUSES = ["COMPLETED", "PENDING", "FAILED", "CANCELLED", "REFUNDED"]
TRANSACTION_TYPES = ["PURCHASE", "REFUND", "TRANSFER", "PAYMENT", "WITHDRAWAL", "DEPOSIT"]
CHANNELS = ["ONLINE", "MOBILE", "POS", "ATM", "BRANCH"]
ACCOUNT_TYPES = ["CHECKING", "SAVINGS", "CREDIT", "INVESTMENT"]
MERCHANT_CATEGORIES = [
    "RETAIL", "GROCERY", "RESTAURANT", "GAS", "TRAVEL",
    "ENTERTAINMENT", "UTILITIES", "HEALTHCARE", "EDUCATION", "OTHER",
]
STRICT_CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CAD"]  # the narrower scheduled-job list

# --- fixed values: exchange rates to USD (exact decimals) ---------------------------
USD_RATES = {
    "USD": Decimal("1.0"),
    "EUR": Decimal("1.08"),
    "GBP": Decimal("1.26"),
    "JPY": Decimal("0.0067"),
    "CAD": Decimal("0.74"),
    "AUD": Decimal("0.65"),
    "CHF": Decimal("1.12"),
    "CNY": Decimal("0.14"),
    "INR": Decimal("0.012"),
    "MXN": Decimal("0.058"),
    "BRL": Decimal("0.20"),
    "KRW": Decimal("0.00075"),
    "SGD": Decimal("0.74"),
    "HKD": Decimal("0.13"),
    "NOK": Decimal("0.092"),
    "SEK": Decimal("0.095"),
    "DKK": Decimal("0.14"),
    "NZD": Decimal("0.61"),
    "ZAR": Decimal("0.054"),
    "RUB": Decimal("0.011"),
}

# --- fixed values: country code -> (region, home currency) ---------------------------
COUNTRIES = {
    "US": ("North America", "USD"),
    "CA": ("North America", "CAD"),
    "MX": ("North America", "MXN"),
    "GB": ("Europe", "GBP"),
    "DE": ("Europe", "EUR"),
    "FR": ("Europe", "EUR"),
    "IT": ("Europe", "EUR"),
    "ES": ("Europe", "EUR"),
    "JP": ("Asia Pacific", "JPY"),
    "CN": ("Asia Pacific", "CNY"),
    "IN": ("Asia Pacific", "INR"),
    "AU": ("Asia Pacific", "AUD"),
    "BR": ("South America", "BRL"),
}

# --- fixed values: merchant category -> MCC code --------------------------------------
MCC_CODES = {
    "RETAIL": "5411",
    "GROCERY": "5411",
    "RESTAURANT": "5812",
    "GAS": "5541",
    "TRAVEL": "4722",
    "ENTERTAINMENT": "7922",
    "UTILITIES": "4900",
    "HEALTHCARE": "8011",
    "EDUCATION": "8220",
    "OTHER": "5999",
}

# --- fixed values: id prefixes that mark deliberately bad rows ------------------------
BAD_MARKERS = {
    "null": "TEST_NULL_",
    "duplicate": "TEST_DUP_",
    "invalid_currency": "TEST_BADCUR_",
    "orphan_fk": "TEST_ORPHAN_",
    "negative_amount": "TEST_NEG_",
    "malformed_date": "TEST_BADDATE_",
}
ORPHAN_IDS = {
    "customer_id": "ORPHAN_CUST_12345",
    "account_id": "ORPHAN_ACCT_12345",
    "merchant_id": "ORPHAN_MERCH_12345",
}

# --- fixed values: formats, patterns --------------------------------------------------
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
AMOUNT_PATTERN = r"^-?\d+\.?\d*$"

# --- fixed values: label thresholds, lower bounds in USD -------------------------------
CUSTOMER_SEGMENTS = [("Premium", 10000), ("Gold", 5000), ("Silver", 1000)]
CUSTOMER_SEGMENT_FLOOR = "Bronze"
MERCHANT_TIERS = [("Enterprise", 100000), ("Large", 50000), ("Medium", 10000)]
MERCHANT_TIER_FLOOR = "Small"
FRAUD_AMOUNT = 10000
TREND_BAND_PCT = 5

# --- fixed values: quality gates and retention by environment --------------------------
QUALITY_GATES = {
    "dev": {"null_pct": 5.0, "duplicate_pct": 1.0, "fail": False},
    "test": {"null_pct": 2.0, "duplicate_pct": 0.5, "fail": False},
    "prod": {"null_pct": 1.0, "duplicate_pct": 0.1, "fail": True},
}
RETENTION_DAYS = {"bronze": 90, "silver": 365, "gold": 730, "quarantine": 30}
QUARANTINE_ALERT_PCT = 5.0
FRESHNESS_ALERT_HOURS = 24
FILES_PER_TRIGGER = {"dev": 10, "test": 50, "prod": 100}
TRIGGER_INTERVAL = {"dev": "10 seconds", "test": "30 seconds", "prod": "1 minute"}
