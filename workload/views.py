"""Orders, order lines and users of the engine, as views over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartwright.operators import generate
from cartwright.operators.analytics import build_order_analytics, customers_from_orders
from cartwright.operators.enrich import (
    enrich_order_lines,
    keep_known_users,
    line_facts,
    order_amounts,
)
from cartwright.session import prepare

AS_OF = "1999-01-01"
SEED = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers. Every 97th order belongs to an unknown user."""
    key = F.col("o_orderkey")
    hours = F.make_dt_interval(F.lit(0), (key % 24).cast("int"))
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("orderId"),
        F.when(key % 97 == 0, -1).otherwise(F.col("o_custkey")).cast("bigint").alias("userId"),
        (F.col("o_orderdate").cast("timestamp") + hours).alias("orderTimestamp"),
        F.col("o_orderpriority").alias("paymentMethod"),
        (key % 19 + 4).cast("decimal(10,2)").alias("shippingCost"),
        F.col("o_orderstatus").alias("shippingProvider"),
    )


def _unit_price() -> Column:
    """A tenth of the line price per piece, in whole tenths of a cent, as documents
    carry it: a double."""
    line_cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    pieces = F.nullif(F.col("l_quantity").cast("bigint"), F.lit(0).cast("bigint"))
    return F.call_function("div", line_cents, pieces) / 1_000


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines. Categories of every tenth part size are blank."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") % 10 == 0, F.lit(" ")).otherwise(F.col("p_type")).alias("category"),
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(parts, "l_partkey", "left")
        .select(
            F.col("l_orderkey").cast("string").alias("orderId"),
            F.col("l_partkey").cast("bigint").alias("id"),
            "title",
            "category",
            _unit_price().alias("price"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.rint(F.col("l_discount") * 100).alias("discountPercentage"),
        )
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with untidy names and addresses, three time notations, some bad dates."""
    key = F.col("c_custkey")
    day = F.date_add(F.lit("1996-01-01").cast("date"), (key * 37 % 1460).cast("int")).cast("string")
    created = (
        F.when(key % 29 == 0, F.lit("not a date"))
        .when(key % 3 == 0, F.concat(day, F.lit("T08:30:00Z")))
        .when(key % 3 == 1, day)
        .otherwise(F.concat(day, F.lit("T08:30:00+02:00")))
    )
    host = F.concat(F.col("c_mktsegment"), F.lit(".Com"))
    email = (
        F.when(key % 10 == 0, F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")))
        .when(key % 10 == 1, F.concat(F.col("c_name"), F.lit("@x@"), host))
        .otherwise(F.concat(F.lit(" \t"), F.col("c_name"), F.lit("@"), host, F.lit(" ")))
    )
    name = F.split(F.col("c_name"), "#")
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name"
    )
    return (
        table(spark, sf_dir, "customer")
        .join(nations, "c_nationkey", "left")
        .select(
            key.cast("bigint").alias("id"),
            F.concat(F.lit(" "), name[0], F.lit(" ")).alias("firstName"),
            F.concat(F.lit(" "), name[1], F.lit(" ")).alias("lastName"),
            email.alias("email"),
            F.struct(F.when(key % 13 != 0, F.col("n_name")).alias("city")).alias("address"),
            created.alias("createdAt"),
        )
    )


def user_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of ``users`` alone, for results that need no attribute."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))


def seed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with gaps, as the pool of the generator."""
    key = F.col("c_custkey")
    name = F.split(F.col("c_name"), "#")
    day = F.date_add(F.lit("1996-01-01").cast("date"), (key * 37 % 1460).cast("int")).cast("string")
    return table(spark, sf_dir, "customer").select(
        key.cast("bigint").alias("id"),
        F.when(key % 7 != 0, name[0]).alias("firstName"),
        F.when(key % 6 == 0, F.lit("")).otherwise(name[1]).alias("lastName"),
        F.when(key % 5 != 0, F.concat(name[1], F.lit("@Shop.Example"))).alias("email"),
        F.struct(F.lit("kept nowhere").alias("city")).alias("address"),
        F.when(key % 11 == 0, F.lit("")).when(key % 11 == 1, None).otherwise(day).alias("createdAt"),
    )


def generated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An id per given order."""
    return table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("id"))


def generated_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested carts: one generated cart for every given order over the given customers."""
    assigned = generate.assign_users(generated_ids(spark, sf_dir), seed_users(spark, sf_dir))
    return generate.make_carts(generate.spread(assigned), AS_OF, SEED)


def generated_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.synthesize_users(
        generated_ids(spark, sf_dir), seed_users(spark, sf_dir), AS_OF, SEED
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_facts(orders(spark, sf_dir), lines(spark, sf_dir), AS_OF)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_order_lines(
        orders(spark, sf_dir), lines(spark, sf_dir), users(spark, sf_dir), AS_OF
    )


def order_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_order_analytics(keep_known_users(facts(spark, sf_dir), user_ids(spark, sf_dir)))


def amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_amounts(orders(spark, sf_dir), lines(spark, sf_dir))


def known_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the order table that revenue reports read."""
    return keep_known_users(amounts(spark, sf_dir), user_ids(spark, sf_dir))


def customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers_from_orders(amounts(spark, sf_dir), users(spark, sf_dir), AS_OF)
