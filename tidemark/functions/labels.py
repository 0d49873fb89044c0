"""Dashboard texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INF = float("inf")


def price_label(price: Column, two_decimals: bool = True) -> Column:
    """``$`` and the price, with two decimals or in full."""
    text = _two_decimals(price) if two_decimals else full_precision_text(price)
    no_number = (
        F.when(F.isnan(price), "nan").when(price == _INF, "inf").when(price == -_INF, "-inf")
    )
    return F.concat(F.lit("$"), F.coalesce(no_number, text))


def caption(symbol: Column) -> Column:
    return F.concat(F.lit("Latest Price for "), symbol)


def _two_decimals(price: Column) -> Column:
    # The pattern form rounds the exact binary value, half to even: 0.125 -> 0.12 and
    # 1.005 -> 1.00. format_string("%.2f") would round the printed digits half up. (Prices
    # from 1e13 on have no exact cents left and show the digits of their shortest text.)
    return F.call_function("format_number", price, F.lit("0.00"))


def full_precision_text(value: Column) -> Column:
    """Shortest exact text; exponent form only below 1e-4 and from 1e16 on."""
    size = F.abs(value)
    plain_digits = F.rtrim(value.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(plain_digits.endswith("."), F.concat(plain_digits, F.lit("0"))).otherwise(
        plain_digits
    )

    parts = F.split(value.cast("string"), "E")
    mantissa = F.regexp_replace(parts[0], r"\.0$", "")
    exponent = F.format_string("%+03d", F.try_element_at(parts, F.lit(2)).cast("int"))
    scientific = F.concat(mantissa, F.lit("e"), exponent)

    return (
        F.when((size >= 1e-4) & (size < 1e16), plain)
        .when((size > 0) & (size < _INF), scientific)
        .otherwise(value.cast("string"))
    )
