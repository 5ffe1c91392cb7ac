"""Reusable column expressions. All are built-ins, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import reference_data as ref

MONEY = "decimal(18,2)"
RATE = "decimal(10,5)"


def count_if(condition: Column) -> Column:
    """Rows for which the condition is true; false and NULL do not count."""
    return F.count(F.when(condition, F.lit(1)))


def mean_of(value: Column | str) -> Column:
    """Average of an exact column as double: exact sum, one division at the end."""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(value).cast("double") / F.count(value)


def pct(part: Column, whole: Column) -> Column:
    """part / whole in percent, 0 for an empty whole."""
    # multiply first: the quotient is then the double nearest to the true percentage
    return (part * 100).cast("double") / F.greatest(whole, F.lit(1)).cast("double")


def pct_change(current: Column, previous: Column) -> Column:
    """Percent change rounded to 2 places; NULL unless the previous value is above zero."""
    change = (current - previous).cast("double") / previous.cast("double") * 100
    return F.when(previous > 0, F.round(change, 2))


def ratio(part: Column, whole: Column, places: int) -> Column:
    """Decimal ratio with a fixed number of places, zero when the whole is not positive."""
    # 9 places holds for dividends up to 10^19: counts and decimal(18,2) sums.
    target = f"decimal({5 if places == 4 else 18},{places})"
    return F.when(whole > 0, F.try_divide(part, whole).cast(target)).otherwise(F.lit(0).cast(target))


def trend_label(change_pct: Column, band: float = ref.TREND_BAND_PCT) -> Column:
    return (
        F.when(change_pct > band, "up").when(change_pct < -band, "down").otherwise("stable")
    )


def banded_label(value: Column, bands: list[tuple[str, int]], floor: str) -> Column:
    """First band whose lower bound the value reaches; the floor label below all (and for NULL)."""
    hits = [F.when(value >= lower, F.lit(name)) for name, lower in bands]
    return F.coalesce(*hits, F.lit(floor))


def customer_segment(value: Column) -> Column:
    return banded_label(value, ref.CUSTOMER_SEGMENTS, ref.CUSTOMER_SEGMENT_FLOOR)


def merchant_tier(value: Column) -> Column:
    return banded_label(value, ref.MERCHANT_TIERS, ref.MERCHANT_TIER_FLOOR)


def key_of(business_id: Column) -> Column:
    """64-bit surrogate key; a missing business id has no key."""
    return F.when(business_id.isNotNull(), F.xxhash64(business_id))


def date_key_of(day: Column) -> Column:
    """yyyyMMdd as INT by arithmetic, cheaper than formatting to text and back."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def sql_lookup(expression: str, mapping: dict[str, str]) -> str:
    """SQL text of a value lookup; unknown values give NULL. A literal map keeps generated
    code small, and one parsed expression is cheaper to build than a chain of when() calls."""
    pairs = ", ".join(f"'{k}', '{v}'" for k, v in mapping.items())
    return f"try_element_at(map({pairs}), {expression})"


def sql_nth(values, index: str) -> str:
    """SQL text that picks a value by index, wrapping around."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), CAST({index} % {len(values)} AS INT) + 1)"


def sql_rate(currency: str, rates: dict | None = None) -> str:
    """SQL text of the exchange rate; unknown or missing currency counts as 1."""
    pairs = ", ".join(f"'{c}', CAST({r} AS {RATE})" for c, r in (rates or ref.USD_RATES).items())
    return f"coalesce(try_element_at(map({pairs}), {currency}), CAST(1 AS {RATE}))"


def sql_usd(amount: str, currency: str, rates: dict | None = None) -> str:
    return f"CAST(round({amount} * {sql_rate(currency, rates)}, 2) AS {MONEY})"


def to_usd(amount: str = "amount", currency: str = "currency", rates: dict | None = None) -> Column:
    """Amount in USD, rounded to cents, from two column names."""
    return F.expr(sql_usd(amount, currency, rates))


def money(text: Column) -> Column:
    return text.try_cast(MONEY)


def day(text: Column, fmt: str = ref.DATE_FORMAT) -> Column:
    return F.try_to_date(text, fmt)


def moment(text: Column, fmt: str = ref.TIMESTAMP_FORMAT) -> Column:
    return F.try_to_timestamp(text, F.lit(fmt))


def region_of(country: str = "country_code") -> Column:
    """Region of a country code from the fixed country table; NULL when unknown."""
    return F.expr(sql_lookup(country, {code: region for code, (region, _) in ref.COUNTRIES.items()}))
