"""Decimal arithmetic for quantities, prices and amounts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import AMOUNT, PRICE, TOTAL_QUANTITY


def amount_of(quantity: Column, unit_price: Column) -> Column:
    """quantity x price, exact, rounded once to ten decimals, for any total quantity and price.

    The full product has 46 digits, Spark keeps 38. The quantity is split at 10**9: the upper part times the shifted
    price has one decimal and is exact, the lower part times the price is rounded once.
    """
    total, price = quantity.cast(TOTAL_QUANTITY), unit_price.cast(PRICE)
    upper = F.floor(total.cast("decimal(28,6)") / F.lit("1000000000").cast("decimal(10,0)")).cast("decimal(13,0)")
    lower = (total - (upper * F.lit("1000000000").cast("decimal(10,0)")).cast("decimal(28,0)")).cast("decimal(15,6)")
    shifted = (price * F.lit("1000000000").cast("decimal(10,0)")).cast("decimal(18,1)")
    return ((upper * shifted).cast("decimal(37,10)") + (lower * price).cast("decimal(37,10)")).cast(AMOUNT)


def total_amount(amount: Column | str) -> Column:
    return F.sum(amount).cast(AMOUNT)


def total_quantity(quantity: Column | str) -> Column:
    return F.sum(quantity).cast(TOTAL_QUANTITY)


def share_of(amount: Column, rate: str) -> Column:
    """``rate`` (decimal text such as '0.08875', up to eight decimals) of an amount, rounded to cents."""
    if Decimal(rate) != round(Decimal(rate), 8):
        raise ValueError(f"rate {rate} has more than eight decimals")
    # decimal(28,10) x decimal(9,8) stays inside 38 digits, so no scale is lost.
    return F.round(amount.cast("decimal(28,10)") * F.lit(rate).cast("decimal(9,8)"), 2).cast(AMOUNT)
