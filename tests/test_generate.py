"""The generator: repeatable, within its bands, round robin over the pool."""

import datetime as dt

from pyspark.sql import functions as F

from cartwright.operators import generate as G
from cartwright.operators import vocabulary as V
from cartwright.schemas import CART, USER
from cartwright.sources import order_ids, users_from_rows

from conftest import AS_OF

POOL = [
    {"id": 30, "firstName": "Kim", "email": "kim@a.b", "createdAt": "2020-01-01"},
    {"id": 10, "firstName": "Bo", "lastName": "Ray", "createdAt": ""},
    {"id": 20},
    {"id": 20},
]


def test_round_robin_in_id_order(spark):
    pool = users_from_rows(spark, POOL)
    got = G.assign_users(order_ids(spark, 7), pool).orderBy("id").collect()
    assert [r.userId for r in got] == [10, 20, 30, 10, 20, 30, 10]


def test_users_are_numbered_across_buckets(spark):
    ids = [-70_000, -1, 0, 65_535, 65_536, 200_000, 2**31 - 1, -(2**31)]
    pool = users_from_rows(spark, [{"id": i} for i in ids])
    got = G.index_users(pool).orderBy("slot").collect()
    assert [(r.id, r.slot) for r in got] == list(zip(sorted(ids), range(len(ids)), strict=True))


def test_empty_pool_gives_every_order_its_own_user(spark):
    carts, users = G.synthesize_orders(spark, users_from_rows(spark, []), 20, AS_OF)
    assert {r.userId for r in carts.collect()} == {r.id for r in users.collect()} == set(range(1, 21))
    for u in users.collect():
        name, _, domain = u.email.partition("@")
        assert name.startswith(f"{u.firstName}.{u.lastName}".lower()) and domain in V.EMAIL_DOMAINS
        assert u.address.city in V.CITIES
        age = AS_OF - dt.date.fromisoformat(u.createdAt[:10])
        assert 30 <= age.days <= 1_460


def test_seed_users_keep_what_they_have(spark):
    users = {
        r.id: r
        for r in G.synthesize_users(order_ids(spark, 3), users_from_rows(spark, POOL), AS_OF).collect()
    }
    assert set(users) == {10, 20, 30}
    assert (users[30].firstName, users[30].email, users[30].createdAt) == (
        "Kim", "kim@a.b", "2020-01-01",
    )
    assert users[30].lastName in V.LAST_NAMES
    assert users[10].email == "user10@gmail.com" and users[10].createdAt
    assert users[20].firstName in V.FIRST_NAMES and users[20].address.city in V.CITIES


def test_carts_are_repeatable_and_within_bands(spark):
    pool = users_from_rows(spark, POOL)
    carts, users = G.synthesize_orders(spark, pool, 400, AS_OF, seed=3)
    again, _ = G.synthesize_orders(spark, pool.repartition(3), 400, AS_OF, seed=3)
    other, _ = G.synthesize_orders(spark, pool, 400, AS_OF, seed=4)
    assert carts.dtypes == [(f.name, f.dataType.simpleString()) for f in CART]
    assert users.dtypes == [(f.name, f.dataType.simpleString()) for f in USER]
    rows = carts.orderBy("id").collect()
    assert rows == again.orderBy("id").collect()
    assert rows != other.orderBy("id").collect()
    assert len({r.orderId for r in rows}) == 400
    couriers = {name: (low, high) for name, low, high in V.COURIERS}
    sizes = set()
    for r in rows:
        low, high = couriers[r.shippingProvider]
        assert low <= r.shippingCost <= high and r.paymentMethod in V.PAYMENT_METHODS
        age = AS_OF - dt.datetime.fromisoformat(r.orderTimestamp).date()
        assert 0 <= age.days <= 365
        sizes.add(len(r.products))
        assert len({p.category for p in r.products}) == len(r.products)
        for p in r.products:
            bands = {t: (lo, hi) for t, lo, hi in V.CATALOGUE[p.category]}
            low, high = bands[p.title]
            assert low <= p.price <= high and round(p.price, 2) == p.price
            assert 1 <= p.quantity <= 5 and 1_000 <= p.id <= 9_999
            assert 0 <= p.discountPercentage <= 25 and p.discountPercentage % 1 == 0
    assert sizes == {1, 2, 3, 4}


def test_every_value_is_drawn(spark):
    carts, _ = G.synthesize_orders(spark, users_from_rows(spark, []), 2_000, AS_OF)
    lines = carts.select("paymentMethod", "shippingProvider", F.explode("products").alias("p"))
    assert lines.select("paymentMethod").distinct().count() == len(V.PAYMENT_METHODS)
    assert lines.select("shippingProvider").distinct().count() == len(V.COURIERS)
    assert lines.select("p.category", "p.title").distinct().count() == sum(
        map(len, V.CATALOGUE.values())
    )
    assert all(len(items) == V.OFFERS for items in V.CATALOGUE.values())


def test_users_with_wide_ids_are_numbered_in_order(spark):
    ids = [-(2**62), -5, 0, 1, 65_535, 65_536, 2**31, 2**32 + 7, 2**40, 2**40 + 1, 2**48, 2**62]
    users = spark.createDataFrame([(i,) for i in ids[::-1] + ids[:3]] + [(None,)], "id long").repartition(3)
    found = sorted((r.slot, r.id) for r in G.index_users(users).collect())
    assert found == list(enumerate(ids))


def test_orders_beyond_32_bits(spark):
    orders = spark.range(2**33, 2**33 + 50)
    users = spark.createDataFrame([(2**35 + i,) for i in range(7)], "id long")
    carts = G.make_carts(G.assign_users(orders, users), "1999-01-01", 7).collect()
    assert {c.id for c in carts} == set(range(2**33, 2**33 + 50))
    assert all(c.userId == 2**35 + (c.id - 1) % 7 for c in carts)
