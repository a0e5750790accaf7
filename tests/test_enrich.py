"""Enrichment on hand-made edge rows and on random carts, by both routes."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cartwright.operators import analytics as A
from cartwright.operators import enrich as E
from cartwright.operators import keys as K
from cartwright.schemas import CART, USER

from conftest import AS_OF
from rules import order_figures


def product(id=1, category="a", price=1.0, quantity=1, discount=0.0, title="t"):
    return (id, title, category, price, quantity, discount)


def cart(i, products, user=1, stamp="2024-03-01T10:20:30", shipping=1.0, order_id="auto"):
    order = f"o{i}" if order_id == "auto" else order_id
    return (i, user, order, stamp, products, "PayPal", shipping, "DHL")


def user(i=1, first="Ann", last="Lee", email="Ann@Shop.com", city="Rome", created="1998-01-01"):
    return (i, first, last, email, (city,), created)


def by_order(df):
    return {r.order_id: r for r in df.collect()}


def nested(spark, carts, users, **kw):
    return E.enrich_orders(
        spark.createDataFrame(carts, CART), spark.createDataFrame(users, USER), AS_OF, **kw
    )


def flat(spark, carts, users, **kw):
    frame = spark.createDataFrame(carts, CART)
    lines = frame.select("orderId", F.explode("products").alias("p")).select("orderId", "p.*")
    users = spark.createDataFrame(users, USER)
    return E.enrich_order_lines(frame.drop("products"), lines, users, AS_OF, **kw)


ROUTES = pytest.mark.parametrize("route", [nested, flat])


@ROUTES
def test_empty_and_missing_products(spark, route):
    got = by_order(route(spark, [cart(1, []), cart(2, None), cart(3, None, shipping=None)], [user()]))
    for o in ("o1", "o2"):
        assert got[o].gross_amount == 0 and got[o].final_amount == D("1.00")
        assert got[o].discount_ratio == 0 and got[o].order_complexity_score == 0
        assert got[o].dominant_category == "Unknown"
    assert got["o3"].final_amount == 0


@ROUTES
@pytest.mark.parametrize("tie_break, winner", [("first", "a"), ("last", "b")])
def test_category_ties_and_blanks(spark, route, tie_break, winner):
    carts = [
        cart(1, [product(1, "b", 2.0), product(2, "a", 1.0), product(3, "a", 1.0)]),
        cart(2, [product(1, " a", 2.0), product(2, "a\t", 2.0), product(3, "b", 3.0)]),
        cart(3, [product(1, "  ", 5.0), product(2, None, 5.0), product(3, "z", 9.0)]),
    ]
    got = by_order(route(spark, carts, [user()], tie_break=tie_break))
    assert got["o1"].dominant_category == winner
    assert got["o2"].dominant_category == "a"
    assert got["o3"].dominant_category == "Unknown"


@ROUTES
def test_product_ids(spark, route):
    carts = [cart(1, [product(1), product(None), product(1), product(2, "b")])]
    got = by_order(route(spark, carts, [user()]))["o1"]
    assert got.total_items == 4 and got.order_complexity_score == 2 * 2 + 4


@ROUTES
def test_rounding_ties(spark, route):
    carts = [
        cart(1, [product(price=0.005)]),
        cart(2, [product(price=10.0, quantity=3, discount=0.05)]),  # 0.015
        cart(3, [product(price=1000.0, discount=0.05), product(2, price=1000.0)]),  # ratio .00025
        cart(4, [product(price=0.333, quantity=3)]),  # 0.999, not 3 x 0.33
    ]
    got = by_order(route(spark, carts, [user()]))
    assert got["o1"].gross_amount == D("0.01")
    assert got["o2"].total_discount_amount == D("0.02")
    assert got["o3"].discount_ratio == D("0.0003")
    assert got["o4"].gross_amount == D("1.00")


@ROUTES
def test_times_and_texts(spark, route):
    carts = [
        cart(1, [], stamp="2024-03-01T10:20:30Z"),
        cart(2, [], stamp="2024-03-01T23:30:00-02:00"),
        cart(3, [], stamp="bad"),
        cart(4, [], stamp=None),
    ]
    got = by_order(route(spark, carts, [user()]))
    assert (got["o1"].order_date, got["o1"].order_hour) == (dt.date(2024, 3, 1), 10)
    assert (got["o2"].order_date, got["o2"].order_hour) == (dt.date(2024, 3, 2), 1)
    for o in ("o3", "o4"):
        assert got[o].order_timestamp == dt.datetime(1999, 1, 1)
        assert (got[o].order_date, got[o].order_hour) == (AS_OF, 0)


def test_missing_order_id_falls_back_to_the_cart_id(spark):
    assert set(by_order(nested(spark, [cart(5, [], order_id=None)], [user()]))) == {"5"}


@ROUTES
def test_users(spark, route):
    carts = [cart(1, [], user=1), cart(2, [], user=2), cart(3, [], user=9), cart(4, [], user=None)]
    users = [
        user(1, email="old@x.y", created="1997-01-01"),
        user(1, email=" NEW@X@Z ", created="1998-01-01"),
        user(2, None, None, None, None, None),
    ]
    got = by_order(route(spark, carts, users))
    assert set(got) == {"o1", "o2"}
    assert (got["o1"].email, got["o1"].email_domain) == ("new@x@z", "z")
    blank = got["o2"]
    assert (blank.first_name, blank.last_name, blank.email) == ("", "", "")
    assert (blank.email_domain, blank.city, blank.signup_date) == ("", "Unknown", AS_OF)


def test_orphans(spark):
    carts = spark.createDataFrame([cart(1, [], 1), cart(2, [], 9), cart(3, [], None)], CART)
    users = spark.createDataFrame([user(1), user(1)], USER)
    lost = E.orphan_orders(carts, users)
    assert lost.columns == CART.fieldNames()
    assert {r.id for r in lost.collect()} == {2, 3}
    kept = E.keep_known_users(E.cart_facts(carts, AS_OF), users)
    assert [r.order_id for r in kept.collect()] == ["o1"]


def random_carts(n, seed=5):
    rng = random.Random(seed)
    carts = []
    for i in range(n):
        products = [
            product(
                rng.choice([None, 1, 2, 3]),
                rng.choice(["a", "b", " b", "c ", "", None]),
                rng.choice([0.0, 1.0, 2.5, round(rng.uniform(0, 900), rng.choice([2, 3, 4]))]),
                rng.choice([None, 1, 2, 3]),
                rng.choice([None, 0.0, 12.96, float(rng.randint(0, 25))]),
            )
            for _ in range(rng.randint(0, 6))
        ]
        carts.append(cart(i, products, user=i % 7, shipping=round(rng.uniform(0, 20), 3)))
    return carts


@pytest.mark.parametrize("tie_break", ["first", "last"])
def test_both_routes_match_plain_python(spark, tie_break):
    carts = random_carts(300)
    users = [user(i) for i in range(7)]
    fields = [f.name for f in CART["products"].dataType.elementType]
    want = {
        c[2]: order_figures(
            [dict(zip(fields, p, strict=True)) for p in c[4]], c[6], tie_break
        )
        for c in carts
    }
    for route in (nested, flat):
        got = by_order(route(spark, carts, users, tie_break=tie_break))
        assert len(got) == len(carts)
        for order, figures in want.items():
            assert {k: got[order][k] for k in figures} == figures, (route.__name__, order)


def test_window_route_agrees_with_the_array_route(spark):
    frame = spark.createDataFrame(random_carts(300), CART)
    for tie_break in ("first", "last"):
        in_row = {
            r.order_id: r.dominant_category
            for r in E.cart_facts(frame, AS_OF, tie_break).collect()
        }
        ranked = E.dominant_category_window(E.explode_products(frame), tie_break)
        facts = E.cart_facts(frame, AS_OF).select("order_id")
        joined = E.attach_dominant_category(facts, ranked)
        assert {r.order_id: r.dominant_category for r in joined.collect()} == in_row


def test_both_customer_routes_agree_and_sums_hold(spark):
    carts = random_carts(300)
    users = spark.createDataFrame([user(i, created=f"199{i}-05-05") for i in range(6)], USER)
    frame = spark.createDataFrame(carts, CART)
    enriched = E.enrich_orders(frame, users, AS_OF)
    orders = A.build_order_analytics(enriched)
    one = A.build_customer_analytics(enriched, AS_OF)
    two = A.customers_from_orders(orders, users, AS_OF)
    three = A.customers_from_orders(E.cart_facts(frame, AS_OF), users, AS_OF)
    lines = E.explode_products(frame)
    four = A.customers_from_orders(E.order_amounts(frame, lines), users, AS_OF)
    rows = sorted(one.collect())
    assert rows == sorted(two.collect()) == sorted(three.collect()) == sorted(four.collect())
    assert one.dtypes == two.dtypes
    assert len(rows) == 6  # user 6 is unknown
    assert sum(r.total_spent for r in rows) == A.total_revenue(orders).first().total
    assert sum(r.total_orders for r in rows) == orders.count()
    for r in orders.collect():
        assert r.net_amount == r.gross_amount - r.total_discount_amount
        assert r.final_amount == r.net_amount + r.shipping_cost


def test_repeated_order_rows_count_once_as_order(spark):
    orders = spark.createDataFrame(
        [(1, "a", D("1.00")), (1, "a", D("2.00")), (1, "b", D("3.00")), (None, "c", D("9.00"))],
        "customer_id int, order_id string, final_amount decimal(14,2)",
    )
    assert [tuple(r) for r in A.customer_totals(orders).collect()] == [(1, 2, D("6.00"))]


def test_last_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, s int, v string"
    )
    got = K.last_per_key(df, "k", "s")
    assert got.columns == ["k", "s", "v"]
    assert sorted(tuple(r) for r in got.collect()) == [("a", 2, "z"), ("b", 1, None)]


def test_explode_and_nest_are_inverse(spark):
    frame = spark.createDataFrame(random_carts(50), CART)
    full = frame.filter(F.size("products") > 0)
    back = E.nest_products(E.explode_products(full))
    want = {r.orderId: r.p for r in full.select("orderId", F.array_sort("products").alias("p")).collect()}
    assert {r.orderId: r.products for r in back.collect()} == want


def test_wrong_tie_break_is_refused(spark):
    with pytest.raises(ValueError, match="tie_break"):
        nested(spark, [cart(1, [])], [user()], tie_break="biggest")
