"""Prices and currencies, as text, as lists and as parsed JSON values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stallkeeper.functions.variants import as_list, is_list, kind, let


def price_from_text(price: Column) -> Column:
    """Keep digits, commas and dots, drop the commas, read a number; NULL when that fails."""
    digits = F.regexp_replace(price, r"[^0-9,.]", "")
    return F.replace(digits, F.lit(","), F.lit("")).try_cast("double")


def mean_price(prices: Column) -> Column:
    """Mean of the readable items of an array of price texts; NULL when none is readable."""
    readable = F.filter(F.transform(prices, price_from_text), lambda p: p.isNotNull())
    return let(
        readable,
        lambda ps: F.try_divide(
            F.aggregate(ps, F.lit(0.0), lambda total, p: total + p), F.size(ps).cast("double")
        ),
    )


def mean_price_of_texts(items: Column) -> Column:
    """Mean over an array of parsed values, of which only strings count."""
    texts = F.filter(items, lambda i: kind(i) == "STRING")
    return mean_price(F.transform(texts, lambda i: F.try_variant_get(i, "$", "string")))


def price_from_value(value: Column) -> Column:
    """Price of a parsed value: text is cleaned, a list is averaged, a number passes through."""
    shape = kind(value)
    return (
        F.when(shape == "STRING", price_from_text(F.try_variant_get(value, "$", "string")))
        .when(shape.startswith("ARRAY"), mean_price_of_texts(as_list(value)))
        .when(shape.startswith("OBJECT"), F.lit(None).cast("double"))
        .otherwise(F.try_variant_get(value, "$", "double"))
    )


def join_currencies(currencies: Column) -> Column:
    return F.array_join(currencies, ", ")


def currency_from_value(value: Column) -> Column:
    """Currency of a parsed value; the items of a list are joined."""
    items = F.transform(as_list(value), lambda i: F.try_variant_get(i, "$", "string"))
    return F.when(is_list(value), join_currencies(items)).otherwise(
        F.try_variant_get(value, "$", "string")
    )
