"""Displayed prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listflow.functions.binding import let

_MONEY = "decimal(12,2)"


def price_parts(c: Column) -> Column:
    """Struct (low, high, is_free, ambiguous, n_amounts) read from a displayed price."""
    zero = F.lit(0).cast(_MONEY)

    def parts(x: Column) -> Column:
        amounts, free = x["amounts"], x["free"]
        n, top = F.size(amounts), F.array_max(amounts)
        return F.struct(
            F.when(free, zero).otherwise(F.array_min(amounts)).alias("low"),
            F.when(n > 0, top).when(free, zero).alias("high"),
            (free | (n > 0) & (top == 0)).alias("is_free"),
            ((n == 0) & ~free).alias("ambiguous"),
            n.alias("n_amounts"))

    def read(text: Column) -> Column:
        amounts = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?)"), 1),
                              lambda a: a.cast(_MONEY))
        return let(F.struct(amounts.alias("amounts"),
                            F.rlike(text, F.lit(r"(?i)\bfree\b")).alias("free")), parts)

    return let(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?<=\d),(?=\d{3})", ""), read)


def price_agrees(a: Column, b: Column) -> Column:
    """Whether two displayed prices state the same lowest amount; worded prices never do."""
    def same(x: Column) -> Column:
        pa, pb = x["a"], x["b"]
        return ~pa["ambiguous"] & ~pb["ambiguous"] & (pa["low"] == pb["low"])

    both = F.struct(price_parts(a).alias("a"), price_parts(b).alias("b"))
    return F.coalesce(let(both, same), F.lit(False))


def price_specificity(c: Column) -> Column:
    """3 = one exact amount, 2 = a range, 1 = words."""
    exact = ~F.rlike(c, F.lit(r"(?i)\b(?:from|up to)\b|\+"))
    return let(price_parts(c)["n_amounts"], lambda n: F.when((n == 1) & exact, 3).when(
        n >= 1, 2).otherwise(1))


def format_amount(value: Column, currency: Column | None = None) -> Column:
    """Amount as it would be displayed: Free, $35, $12.5, EUR 10; other text unchanged."""
    def show(x: Column) -> Column:
        amount = x["text"].try_cast("double")
        code = F.when(F.coalesce(x["code"], F.lit("")) == "", F.lit("USD")).otherwise(x["code"])
        shown = F.regexp_replace(F.format_string("%.2f", amount), r"\.?0+$", "")
        symbol = F.when(F.upper(code) == "USD", F.lit("$")).otherwise(F.concat(code, F.lit(" ")))
        return (F.when(amount.isNull(), x["text"]).when(amount == 0, F.lit("Free"))
                .otherwise(F.concat(symbol, shown)))

    code = currency if currency is not None else F.lit("USD")
    return let(F.struct(value.cast("string").alias("text"), code.alias("code")), show)


def display_range(prices: Column) -> Column:
    """One display text from the ordered display prices of an event's offers."""
    def show(distinct: Column) -> Column:
        paid = F.filter(distinct, lambda p: p != "Free")
        last = lambda a: F.try_element_at(a, F.lit(-1))
        first = F.try_element_at(distinct, F.lit(1))
        return (
            F.when(F.size(distinct) <= 1, first)
            .when(F.array_contains(distinct, "Free"), F.concat(F.lit("Free - "), last(paid)))
            .otherwise(F.concat(first, F.lit(" - "), last(distinct))))

    return let(F.array_distinct(F.filter(prices, lambda p: p.isNotNull() & (p != ""))), show)
