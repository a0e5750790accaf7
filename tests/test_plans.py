"""What the physical plans must and must not contain, and that hot keys are split."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from cartwright.operators import analytics as A
from cartwright.operators import enrich as E
from cartwright.schemas import CART, USER
from workload.queries import QUERIES

from conftest import AS_OF

SF = "/root/testdata/sf0.001"

LAZY = [
    "c1_enrich_orders", "c1_enrich_carts", "c2_order_analytics", "c3_customer_analytics",
    "c3_customers_from_enriched", "a8_payment_revenue", "w1_dominant_category", "w2_last_per_key",
    "g8_synthesize_orders", "k4_upsert", "k6_kv_items", "k9_order_contract", "x7_nest_products",
    "p10_search", "j2_orphan_orders",
]


def plan(df, final=False) -> str:
    if final:
        df.write.format("noop").mode("overwrite").save()
        # collecting runs the same frame, whose plan then is the final one
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def conf(spark, **values):
    old = {}
    for key, value in values.items():
        key = key.replace("__", ".")
        old[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, (name, bad)


def test_scans_read_only_what_is_needed(spark):
    text = plan(QUERIES["c3_customer_analytics"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    columns = {c.split(":")[0] for s in schemas for c in s.split(",") if c}
    assert "o_orderpriority" not in columns and "l_tax" not in columns
    assert "l_shipdate" not in columns and "c_acctbal" not in columns and "o_orderdate" not in columns
    narrow = plan(QUERIES["j2_orphan_orders"](spark, SF))
    read = {c.split(":")[0] for s in re.findall(r"ReadSchema: struct<([^>]*)>", narrow) for c in s.split(",")}
    assert read == {"o_orderkey", "o_custkey", "c_custkey"}


@pytest.mark.parametrize("name", ["j2_orphan_orders", "p11_orphan_count", "c2_order_analytics", "a8_payment_revenue"])
def test_known_users_need_their_ids_only(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "nation" not in text and "c_name" not in text


def test_order_table_reads_no_user_attribute(spark):
    assert "c_mktsegment" not in plan(QUERIES["c2_order_analytics"](spark, SF))


def test_cart_facts_do_not_shuffle(spark):
    carts = spark.createDataFrame([], CART)
    assert "Exchange" not in plan(E.cart_facts(carts, AS_OF))


def test_line_sums_spread_a_hot_order(spark):
    lines = spark.createDataFrame(
        [], "orderId string, id int, category string, price double, quantity int, "
        "discountPercentage double",
    )
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan(E.line_sums(lines)))
    # first by order and product or category, then the partial sums by order
    assert len(keys) == 2
    wide, narrow = sorted(keys, key=len, reverse=True)
    assert all(k in wide for k in ("order_id", "category", "product_id"))
    assert "category" not in narrow


def test_a_hot_order_is_summed_exactly(spark):
    """One order holds a third of the lines, one product a third of those."""
    n = 30_000
    lines = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("orderId"),
        F.when(F.col("id") % 9 == 0, 1).otherwise(F.col("id") % 1_000).cast("int").alias("id"),
        F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("category"),
        F.lit(0.5).alias("price"),
        F.lit(2).alias("quantity"),
        F.lit(10.0).alias("discountPercentage"),
    )
    hot = [i for i in range(n) if i % 3 == 0]
    got = E.line_sums(lines).filter(F.col("order_id") == "hot").first()
    assert got.gross == len(hot)  # dollars
    assert got.discount == len(hot) * 10  # cents
    assert got.unique_products == len({1 if i % 9 == 0 else i % 1_000 for i in hot})
    assert got.dominant_category == "a"


def _skewed(spark):
    """A third of the carts belongs to one of 500 users; users too large to broadcast."""
    carts = spark.range(0, 60_000, 1, 12).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("int").alias("userId"),
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("orderId"),
        F.lit("2024-03-01").alias("orderTimestamp"),
        F.array(
            F.struct(
                F.lit(1).alias("id"), F.lit("t").alias("title"), F.lit("a").alias("category"),
                F.lit(1.0).alias("price"), F.lit(1).alias("quantity"),
                F.lit(0.0).alias("discountPercentage"),
            )
        ).alias("products"),
        F.lit("PayPal").alias("paymentMethod"),
        F.lit(0.0).alias("shippingCost"),
        F.lit("DHL").alias("shippingProvider"),
    )
    users = spark.createDataFrame(
        [(i, "F", "L", f"u{i}@x.y", ("Rome",), "1998-01-01") for i in range(500)], USER
    )
    return carts, users


SMALL_SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "10k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "5k",
}


def test_order_facts_shuffle_their_lines_once(spark):
    """The lines of a hot order are split, all others are folded where they met their order."""
    n = 30_000
    lines = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("o7")).otherwise(F.concat(F.lit("o"), F.col("id") % 500)).alias("orderId"),
        (F.col("id") % 1_000).alias("id"),
        F.concat(F.lit("c"), F.col("id") % 7).alias("category"),
        (F.col("id") % 11 / 8).alias("price"),
        (F.col("id") % 5).cast("int").alias("quantity"),
        F.lit(10.0).alias("discountPercentage"),
    )
    orders = spark.range(400).select(F.concat(F.lit("o"), F.col("id")).alias("order_id"))
    with conf(spark, **SMALL_SKEW):
        sums = E.line_sums_of(orders, lines)
        keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan(sums))
        assert len(keys) == 2 and not [k for k in keys if "category" in k or "product_id" in k]
        got = {r.order_id: r for r in sums.collect()}
        assert "skew=true" in plan(sums, final=True)
    want = {r.order_id: r for r in E.line_sums(lines).collect() if int(r.order_id[1:]) < 400}
    assert got == want and len(got) == 400


def test_hot_customer_is_split(spark):
    carts, users = _skewed(spark)
    with conf(spark, **SMALL_SKEW):
        enriched = E.enrich_orders(carts, users, AS_OF)
        assert enriched.count() == 60_000
        assert "skew=true" in plan(enriched.select("order_id", "email", "final_amount"), final=True)
        known = E.keep_known_users(E.cart_facts(carts, AS_OF), users)
        assert "skew=true" in plan(known.select("order_id", "final_amount"), final=True)
        rolled = A.build_customer_analytics(enriched, AS_OF)
        assert "skew=true" in plan(rolled, final=True)
        assert {r.customer_id: r.total_orders for r in rolled.collect()}[7] == 20_080


def test_customer_totals_combine_before_the_users_join(spark):
    carts, users = _skewed(spark)
    with conf(spark, **SMALL_SKEW):
        rolled = A.customers_from_orders(E.cart_facts(carts, AS_OF), users, AS_OF)
        text = plan(rolled)
        # the orders are spread by (customer, order) before they are counted
        assert re.search(r"hashpartitioning\(customer_id#\d+, order_id#\d+", text)
        assert {r.customer_id: r.total_orders for r in rolled.collect()}[7] == 20_080
