"""Deterministic orders and users of any size, as column expressions.

Every random choice is a slice of an md5 over (seed, kind, id), so a row is the
same on every run, on every retry and in every other engine that has md5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import time
from ..functions.time import AsOf
from ..schemas import CART, USER
from ..sources.rows import order_ids
from . import vocabulary as V
from .keys import dedupe_users, number_in_order


def digest(seed: int, kind: str, *keys: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(kind), *[k.cast("string") for k in keys]))


def pick(digest_: Column, start: int, length: int, m: Column | int) -> Column:
    """Hex digits start..start+length-1 of a digest as a number below ``m``."""
    number = F.conv(F.substring(digest_, start, length), 16, 10).cast("bigint")
    return number % (F.lit(m).cast("bigint") if isinstance(m, int) else m.cast("bigint"))


def _one_of(values: Column, size: int, digest_: Column, start: int, length: int) -> Column:
    return F.element_at(values, (pick(digest_, start, length, size) + 1).cast("int"))


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _back_in_time(as_of: AsOf, days: Column, seconds: Column) -> Column:
    """ISO text of a moment on the day that lies ``days`` before ``as_of``."""
    midnight = F.unix_seconds(F.date_trunc("day", time.as_of_timestamp(as_of)))
    moment = F.timestamp_seconds(midnight - days * 86_400 + seconds)
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def index_users(users: DataFrame) -> DataFrame:
    """(id, slot): the users numbered 0, 1, 2… in id order. Reads the users once."""
    ids = users.filter(F.col("id").isNotNull()).select(F.col("id").cast("bigint").alias("id"))
    return number_in_order(ids.distinct(), "id", name="slot")


def assign_users(orders: DataFrame, users: DataFrame) -> DataFrame:
    """(id, userId): order i goes to user number (i - 1) mod pool size.

    With an empty pool every order gets a user of its own, with the order's id.
    """
    slots = index_users(users).select(F.col("id").alias("userId"), "slot")
    size = F.nullif(slots.agg(F.count(F.lit(1)).alias("n")).scalar(), F.lit(0))
    number = F.col("id").cast("bigint") - 1
    # Without a pool nothing matches; the number only keeps the join keys apart.
    return (
        orders.withColumn("slot", F.coalesce(F.pmod(number, size), number))
        .join(slots, "slot", "left")
        .select("id", F.coalesce("userId", F.col("id").cast("bigint")).alias("userId"))
    )


def spread(assigned: DataFrame) -> DataFrame:
    """The rows dealt over as many tasks as the session's shuffles have.

    An assignment has a few bytes, so Spark merges the partitions of its join into few;
    the cart made from it takes a hundred times as long as the move. A number of
    partitions that was asked for is kept.
    """
    parts = int(assigned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return assigned.repartition(parts, "id")


def _drawn_user(user_id: Column, as_of: AsOf, seed: int) -> dict[str, Column]:
    h = digest(seed, "user", user_id)
    first = _one_of(_texts(V.FIRST_NAMES), len(V.FIRST_NAMES), h, 1, 4)
    last = _one_of(_texts(V.LAST_NAMES), len(V.LAST_NAMES), h, 5, 4)
    domain = _one_of(_texts(V.EMAIL_DOMAINS), len(V.EMAIL_DOMAINS), h, 9, 4)
    number = (pick(h, 13, 4, 999) + 1).cast("string")
    return {
        "firstName": first,
        "lastName": last,
        "email": F.concat(F.lower(first), F.lit("."), F.lower(last), number, F.lit("@"), domain),
        "address": F.struct(_one_of(_texts(V.CITIES), len(V.CITIES), h, 17, 4).alias("city")),
        "createdAt": _back_in_time(as_of, pick(h, 21, 4, 1_431) + 30, pick(h, 25, 8, 86_400)),
    }


def make_users(ids: DataFrame, as_of: AsOf, seed: int = 0) -> DataFrame:
    """A wholly synthetic user for every id."""
    drawn = _drawn_user(F.col("id"), as_of, seed)
    return ids.select(
        F.col("id").cast("bigint").alias("id"), *[c.alias(name) for name, c in drawn.items()]
    )


def complete_users(users: DataFrame, as_of: AsOf, seed: int = 0) -> DataFrame:
    """Seed users with their gaps filled; the city is always drawn anew."""
    drawn = _drawn_user(F.col("id"), as_of, seed)
    drawn["email"] = F.concat(F.lit("user"), F.col("id").cast("string"), F.lit("@gmail.com"))
    kept = {
        name: F.coalesce(F.nullif(F.col(name), F.lit("")), drawn[name])
        for name in ("firstName", "lastName", "email", "createdAt")
    }
    return users.select(
        F.col("id").cast("bigint").alias("id"),
        *[c.alias(name) for name, c in (drawn | kept).items()],
    )


def _catalogue() -> Column:
    """category -> its products with their price bands, as a constant map."""
    entries: list[Column] = []
    for category, items in V.CATALOGUE.items():
        offers = [
            F.struct(
                F.lit(title).alias("title"), F.lit(low).alias("low"), F.lit(high).alias("high")
            )
            for title, low, high in items
        ]
        entries += [F.lit(category), F.array(*offers)]
    return F.create_map(*entries)


def _band(low: Column, high: Column, digest_: Column, start: int, length: int) -> Column:
    """A price between low and high dollars, both included, in whole cents."""
    width = (high - low) * 100 + 1
    return ((low * 100 + pick(digest_, start, length, width)) / 100).cast("double")


def category_tickets(prefix: Column, count: Column) -> Column:
    """``count`` different categories: those with the smallest digests.

    A ticket is the digest followed by the category name, so plain text sorting
    draws the sample. Its first 8 hex digits decide, the other 24 are left for
    the product draws.
    """
    tickets = F.transform(
        _texts(list(V.CATALOGUE)), lambda category: F.concat(F.md5(F.concat(prefix, category)), category)
    )
    return F.slice(F.sort_array(tickets), 1, count)


def ticket_category(ticket: Column) -> Column:
    return F.substring(ticket, F.lit(33), F.char_length(ticket))


def line_prefix(order_id: Column, seed: int) -> Column:
    return F.concat_ws("|", F.lit(str(seed)), F.lit("line"), order_id.cast("string"), F.lit(""))


def _offer(ticket: Column) -> Column:
    """The drawn product of a ticket's category. A step of its own, so that the
    price draw can use the band without drawing again."""
    category = ticket_category(ticket)
    return F.struct(
        ticket.alias("h"),
        category.alias("category"),
        F.element_at(
            F.element_at(_catalogue(), category), (pick(ticket, 9, 4, V.OFFERS) + 1).cast("int")
        ).alias("item"),
    )


def _product(offer: Column) -> Column:
    h, item = offer["h"], offer["item"]
    return F.struct(
        (pick(h, 27, 6, 9_000) + 1_000).alias("id"),
        item["title"].alias("title"),
        offer["category"].alias("category"),
        _band(item["low"], item["high"], h, 13, 6).alias("price"),
        (pick(h, 19, 4, 5) + 1).cast("int").alias("quantity"),
        pick(h, 23, 4, 26).cast("double").alias("discountPercentage"),
    )


def _uuid_text(digest_: Column) -> Column:
    """A digest laid out as 8-4-4-4-12 hex digits."""
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest_, start, length) for start, length in parts])


def category_count(order_digest: Column) -> Column:
    """1 to 4 categories per order."""
    return (pick(order_digest, 31, 2, 4) + 1).cast("int")


def make_carts(assigned: DataFrame, as_of: AsOf, seed: int = 0) -> DataFrame:
    """One cart for every (id, userId), 1 to 4 products each."""
    h = F.col("h")
    couriers = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.lit(lo).alias("low"), F.lit(hi).alias("high"))
            for n, lo, hi in V.COURIERS
        ]
    )
    drawn = assigned.select(
        "id",
        "userId",
        digest(seed, "order", F.col("id")).alias("h"),
        digest(seed, "order-id", F.col("id")).alias("u"),
        line_prefix(F.col("id"), seed).alias("prefix"),
    ).withColumns(
        {
            "tickets": category_tickets(F.col("prefix"), category_count(h)),
            "courier": _one_of(couriers, len(V.COURIERS), h, 1, 6),
        }
    )
    return drawn.select(
        F.col("id").cast("bigint").alias("id"),
        F.col("userId").cast("bigint").alias("userId"),
        _uuid_text(F.col("u")).alias("orderId"),
        _back_in_time(as_of, pick(h, 7, 6, 366), pick(h, 13, 6, 86_400)).alias("orderTimestamp"),
        F.transform(F.transform("tickets", _offer), _product).alias("products"),
        _one_of(_texts(V.PAYMENT_METHODS), len(V.PAYMENT_METHODS), h, 19, 6).alias(
            "paymentMethod"
        ),
        _band(F.col("courier.low"), F.col("courier.high"), h, 25, 6).alias("shippingCost"),
        F.col("courier.name").alias("shippingProvider"),
    ).select(*CART.fieldNames())


def synthesize_users(
    orders: DataFrame, seed_users: DataFrame, as_of: AsOf, seed: int = 0
) -> DataFrame:
    """The completed pool, or one synthetic user per order when the pool is empty."""
    completed = complete_users(dedupe_users(seed_users), as_of, seed)
    pool_size = seed_users.agg(F.count("id").alias("n")).scalar()
    lonely = orders.filter(pool_size == 0).select("id")
    return completed.unionByName(make_users(lonely, as_of, seed)).select(*USER.fieldNames())


def synthesize_orders(
    spark: SparkSession, seed_users: DataFrame, n: int, as_of: AsOf, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(carts, users) for ``n`` orders over a pool of seed users, which may be empty."""
    orders = order_ids(spark, n)
    carts = make_carts(spread(assign_users(orders, seed_users)), as_of, seed)
    return carts, synthesize_users(orders, seed_users, as_of, seed)
