"""The enrichment rules once more, row by row in plain Python with exact fractions."""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction

BLANKS = " \t\n\r\x0b\x0c"


def half_up(value: Fraction, places: int) -> Decimal:
    scaled = abs(value) * 10**places
    whole = math.floor(scaled + Fraction(1, 2))
    return Decimal(whole if value >= 0 else -whole).scaleb(-places)


def exact(x) -> Fraction:
    """A number as the decimal text says, not as the binary value is."""
    return Fraction(str(x)) if x is not None else Fraction(0)


def order_figures(products, shipping, tie_break="first") -> dict:
    products = products or []
    amounts = [exact(p["price"]) * (p["quantity"] or 0) for p in products]
    discounts = [
        a * exact(p["discountPercentage"]) / 100 for a, p in zip(amounts, products, strict=True)
    ]
    gross, discount = half_up(sum(amounts, Fraction(0)), 2), half_up(sum(discounts, Fraction(0)), 2)
    net = gross - discount
    totals: dict[str, Fraction] = {}
    for a, p in zip(amounts, products, strict=True):
        name = (p["category"] or "").strip(BLANKS) or "Unknown"
        totals[name] = totals.get(name, Fraction(0)) + a
    best = max(totals.values(), default=None)
    names = sorted(n for n, t in totals.items() if t == best)
    items = sum(p["quantity"] or 0 for p in products)
    unique = len({p["id"] for p in products if p["id"] is not None})
    return {
        "gross_amount": gross,
        "total_discount_amount": discount,
        "net_amount": net,
        "shipping_cost": half_up(exact(shipping), 2),
        "final_amount": net + half_up(exact(shipping), 2),
        "discount_ratio": half_up(Fraction(discount) / Fraction(gross), 4) if gross > 0 else 0,
        "total_items": items,
        "order_complexity_score": 2 * unique + items,
        "dominant_category": (names[0 if tie_break == "first" else -1]) if names else "Unknown",
    }
