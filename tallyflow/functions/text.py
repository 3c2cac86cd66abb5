"""Display strings: product, plan and id labels, money and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def product_label(product_id: Column) -> Column:
    """prod_ai_tokens -> Ai Tokens"""
    return F.initcap(F.replace(F.replace(product_id, F.lit("prod_"), F.lit("")), F.lit("_"), F.lit(" ")))


def plan_label(plan_id: Column) -> Column:
    """plan_pro -> Pro (only the first letter changes)"""
    bare = F.replace(plan_id, F.lit("plan_"), F.lit(""))
    return F.concat(F.upper(F.substring(bare, 1, 1)), F.substr(bare, F.lit(2)))


def short_id(value: Column, length: int = 8) -> Column:
    return F.substring(value, 1, length)


def fixed_text(value: Column, decimals: int) -> Column:
    """Plain digits with a fixed number of decimals, no grouping."""
    return F.round(value, decimals).cast(f"decimal(38,{decimals})").cast("string")


def money_text(value: Column, decimals: int = 2) -> Column:
    """$12.34, no grouping: the form used on the invoice document."""
    return F.concat(F.lit("$"), fixed_text(value, decimals))


def grouped_money(value: Column) -> Column:
    """$1,234.50, minus sign before the currency sign: the form used on screens."""
    sign = F.when(F.round(value, 2) < 0, F.lit("-$")).otherwise(F.lit("$"))
    return F.concat(sign, F.format_number(F.abs(F.round(value, 2)), 2))


def grouped_number(value: Column) -> Column:
    """1,234.567: at most three decimals, trailing zeros dropped."""
    text = F.format_number(F.round(value, 3), 3)
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
