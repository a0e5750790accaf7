"""Folds over the product array of a cart. No shuffle: everything happens in the row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from . import money, text


def products_or_empty(products: Column) -> Column:
    return F.coalesce(products, F.array())


def fold_products(products: Column, value: Callable[[Column], Column], type_: str) -> Column:
    """Sum of ``value(product)`` over the array; 0 for an empty or missing array."""
    total = F.aggregate(
        products,
        F.lit(0).cast(type_),
        lambda acc, p: (acc + value(p)).cast(type_),
    )
    return F.coalesce(total, F.lit(0).cast(type_))


def _amount(p: Column) -> Column:
    return money.line_amount(p["price"], p["quantity"])


def priced(products: Column) -> Column:
    """The lines with what the sums need: name, amount, discount, quantity."""
    with_amounts = F.transform(
        products,
        lambda p: F.struct(
            text.or_unknown(p["category"]).alias("name"),
            _amount(p).alias("amount"),
            p["discountPercentage"].alias("percent"),
            F.coalesce(p["quantity"], F.lit(0)).cast("bigint").alias("quantity"),
        ),
    )
    return F.transform(
        with_amounts,
        lambda p: F.struct(
            p["name"].alias("name"),
            p["amount"].alias("amount"),
            money.line_discount(p["amount"], p["percent"]).alias("discount"),
            p["quantity"].alias("quantity"),
        ),
    )


def sums(lines: Column) -> Column:
    """gross, discount and items of ``priced`` lines, in one fold."""

    def plus(acc: Column, line: Column, field: str, added: str, type_: str) -> Column:
        return (acc[field] + line[added]).cast(type_).alias(field)

    zero = F.struct(
        F.lit(0).cast(money.AMOUNT_SUM).alias("gross"),
        F.lit(0).cast(money.DISCOUNT_SUM).alias("discount"),
        F.lit(0).cast("bigint").alias("items"),
    )
    total = F.aggregate(
        lines,
        zero,
        lambda acc, p: F.struct(
            plus(acc, p, "gross", "amount", money.AMOUNT_SUM),
            plus(acc, p, "discount", "discount", money.DISCOUNT_SUM),
            plus(acc, p, "items", "quantity", "bigint"),
        ),
    )
    return F.coalesce(total, zero)


def gross(products: Column) -> Column:
    """Sum of the line amounts, unrounded."""
    return fold_products(products, _amount, money.AMOUNT_SUM)


def discount(products: Column) -> Column:
    """Sum of the line discounts in cents, unrounded."""
    return fold_products(
        products,
        lambda p: money.line_discount(_amount(p), p["discountPercentage"]),
        money.DISCOUNT_SUM,
    )


def items(products: Column) -> Column:
    return fold_products(
        products, lambda p: F.coalesce(p["quantity"], F.lit(0)).cast("bigint"), "bigint"
    )


def product_ids(products: Column) -> Column:
    return F.transform(products, lambda p: p["id"])


def distinct_ids(products: Column) -> Column:
    """Different product ids; a missing id is not a product."""
    return F.array_distinct(F.filter(product_ids(products), lambda i: i.isNotNull()))


def n_products(products: Column) -> Column:
    return F.coalesce(F.size(products), F.lit(0))


def unique_products(products: Column) -> Column:
    return F.coalesce(F.size(distinct_ids(products)), F.lit(0))


def dominant_category(products: Column, tie_break: str = "first") -> Column:
    """The same as ``dominant_of``, from the amounts alone."""
    amounts = F.transform(
        products,
        lambda p: F.struct(
            text.or_unknown(p["category"]).alias("name"), _amount(p).alias("amount")
        ),
    )
    return _dominant(amounts, tie_break)


def dominant_of(priced_lines: Column, tie_break: str = "first") -> Column:
    """Category with the largest amount of ``priced`` lines."""
    amounts = F.transform(
        priced_lines, lambda p: F.struct(p["name"].alias("name"), p["amount"].alias("amount"))
    )
    return _dominant(amounts, tie_break)


def _dominant(amounts: Column, tie_break: str) -> Column:
    """The name with the largest sum, found in one pass over the sorted array.

    Sorting brings the lines of a category together, in ascending name order;
    the fold closes one run after the other and keeps the best. On a tie the
    first name stays (``tie_break="first"``) or the last one wins (``"last"``).
    """
    check_tie_break(tie_break)
    lines = F.sort_array(amounts)
    zero = F.lit(0).cast(money.AMOUNT_SUM)
    none = F.lit(None)
    start = F.struct(
        none.cast("string").alias("name"),
        zero.alias("run"),
        none.cast("string").alias("best"),
        none.cast(money.AMOUNT_SUM).alias("top"),
    )

    def run_wins(s: Column) -> Column:
        beats = s["run"] > s["top"] if tie_break == "first" else s["run"] >= s["top"]
        return s["name"].isNotNull() & (s["top"].isNull() | beats)

    def step(s: Column, line: Column) -> Column:
        same = s["name"].eqNullSafe(line["name"])
        closes = ~same & run_wins(s)
        return F.struct(
            line["name"].alias("name"),
            (F.when(same, s["run"]).otherwise(zero) + line["amount"])
            .cast(money.AMOUNT_SUM)
            .alias("run"),
            F.when(closes, s["name"]).otherwise(s["best"]).alias("best"),
            F.when(closes, s["run"]).otherwise(s["top"]).alias("top"),
        )

    winner = F.aggregate(
        lines, start, step, lambda s: F.when(run_wins(s), s["name"]).otherwise(s["best"])
    )
    return text.default_to(winner, "Unknown")


def check_tie_break(tie_break: str) -> None:
    if tie_break not in ("first", "last"):
        raise ValueError(f"tie_break must be 'first' or 'last', not {tie_break!r}")
