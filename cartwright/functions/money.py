"""Exact money arithmetic and the scores built on it.

Doubles never get summed or divided. Prices, quantities and percentages become decimals
that hold their shortest decimal text (12 decimals of a price, 6 of a percentage);
products and sums of these keep every digit and are rounded once, to cents. From there
on figures are whole cents, and every division is a half-up division of whole numbers,
which has one right answer whatever the row order or the engine. What leaves the range
of a type fails the job (ANSI mode) instead of giving a wrong number: a line of 10^15
dollars, or a result beyond the decimal(14,2) of the result tables.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

PRICE = "decimal(22,12)"
QUANTITY = "decimal(10,0)"
PERCENT = "decimal(9,6)"
AMOUNT = "decimal(27,12)"
DISCOUNT = "decimal(37,18)"  # amount x percent
# Running sums: one more digit would make Spark give up decimals of the result.
AMOUNT_SUM = "decimal(37,12)"
DISCOUNT_SUM = "decimal(37,18)"


def _whole(value: int) -> Column:
    return F.lit(value).cast("bigint")


def line_amount(price: Column, quantity: Column) -> Column:
    """price x quantity; a missing part counts as 0."""
    product = (price.cast(PRICE) * quantity.cast(QUANTITY)).cast(AMOUNT)
    return F.coalesce(product, F.lit(0).cast(AMOUNT))


def line_discount(amount: Column, percent: Column) -> Column:
    """Discount of a line amount in cents, unrounded: amount x percent; a missing
    percentage counts as 0."""
    return (amount * F.coalesce(percent.cast(PERCENT), F.lit(0).cast(PERCENT))).cast(DISCOUNT)


def amount_cents(total: Column) -> Column:
    return (F.round(total, 2).cast("decimal(30,2)") * F.lit(Decimal(100))).cast("bigint")


def discount_cents(total: Column) -> Column:
    return F.round(total, 0).cast("bigint")


def round_money(c: Column, type_: str = "decimal(14,2)") -> Column:
    """Half-up to cents. Doubles pass through their shortest decimal text."""
    return F.round(c.cast("decimal(38,10)"), 2).cast(type_)


def round_ratio(c: Column) -> Column:
    return F.round(c.cast("decimal(38,10)"), 4).cast("decimal(6,4)")


def half_up_div(num: Column, den: Column) -> Column:
    """num / den of whole numbers, den > 0, ties away from zero."""
    half = F.call_function("div", F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -half).otherwise(half)


def cents(c: Column) -> Column:
    return (c.cast("decimal(16,2)") * 100).cast("bigint")


def from_units(c: Column, scale: int, type_: str) -> Column:
    """Whole number of 10^-scale units back to a decimal."""
    return (c.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(type_)


def ratio_units(discount_c: Column, gross_c: Column) -> Column:
    """discount / gross in units of 10^-4, 0 when there is no positive gross."""
    return F.when(gross_c > 0, half_up_div(discount_c * 10_000, gross_c)).otherwise(_whole(0))


def discount_ratio(discount: Column, gross: Column) -> Column:
    return from_units(ratio_units(cents(discount), cents(gross)), 4, "decimal(6,4)")


def avg_order_value(spent: Column, orders: Column) -> Column:
    mean = half_up_div(cents(spent), orders.cast("bigint"))
    return F.when(orders > 0, from_units(mean, 2, "decimal(14,2)")).otherwise(
        F.lit(0).cast("decimal(14,2)")
    )


def complexity(unique_products: Column, items: Column) -> Column:
    return (unique_products * 2 + items).cast("int")


# The score is a sum of three capped parts: one point per 10,000 spent up to 50,
# two per order up to 30, ten per year of 365 days up to 20. All three fit the
# common denominator 365 * 10^6 (cents / 10^6 and days * 10 / 365).
_POINT = 365 * 10**6


def ltv(spent: Column, orders: Column, days: Column) -> Column:
    """Lifetime value score, exact, half-up to 2 places; nulls count as 0."""
    money = F.coalesce(cents(spent), _whole(0)) * 365
    count = F.coalesce(orders.cast("bigint"), _whole(0)) * 2
    tenure = F.coalesce(days.cast("bigint"), _whole(0)) * 10**7
    points = (
        F.least(money, F.lit(50 * _POINT))
        + F.least(count, _whole(30)) * F.lit(_POINT)
        + F.least(tenure, F.lit(20 * _POINT))
    )
    return from_units(half_up_div(points * 100, F.lit(_POINT)), 2, "decimal(8,2)")


def segment(score: Column) -> Column:
    return F.when(score >= 60, "High").when(score >= 30, "Medium").otherwise("Low")


def ltv_score(spent: Decimal, orders: int, days: int) -> Decimal:
    """The same rule for one row in plain Python, as the yardstick of the tests."""
    from fractions import Fraction

    points = (
        min(Fraction(spent) / 10_000, 50)
        + min(Fraction(2 * orders), 30)
        + min(Fraction(days, 365) * 10, 20)
    ) * 100
    sign = -1 if points < 0 else 1
    return Decimal(sign * ((2 * abs(points) + 1) // 2)) / 100


def customer_segment(score: Decimal) -> str:
    return "High" if score >= 60 else "Medium" if score >= 30 else "Low"
