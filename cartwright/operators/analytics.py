"""The two result tables and the reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import money, text, time
from ..functions.time import AsOf
from ..schemas import CUSTOMER_ANALYTICS, ORDER_ANALYTICS
from .enrich import user_attributes


def build_order_analytics(enriched: DataFrame) -> DataFrame:
    """Typed order table: a projection, one row per enriched order.

    It reads no user attribute, so order facts cut by ``keep_known_users`` do as well.
    """
    return enriched.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in ORDER_ANALYTICS]
    )


def _customer_rows(rolled: DataFrame, as_of: AsOf) -> DataFrame:
    scored = rolled.withColumns(
        {
            "total_spent": F.coalesce("total_spent", F.lit(0)).cast("decimal(14,2)"),
            "full_name": text.full_name(F.col("first_name"), F.col("last_name")),
            "customer_tenure_days": time.tenure_days(F.col("signup_date"), as_of),
        }
    ).withColumns(
        {
            "avg_order_value": money.avg_order_value(F.col("total_spent"), F.col("total_orders")),
            "lifetime_value_score": money.ltv(
                F.col("total_spent"), F.col("total_orders"), F.col("customer_tenure_days")
            ),
        }
    )
    return scored.withColumn(
        "customer_segment", money.segment(F.col("lifetime_value_score"))
    ).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CUSTOMER_ANALYTICS])


_ATTRIBUTES = ["first_name", "last_name", "email", "email_domain", "city", "signup_date"]


def build_customer_analytics(enriched: DataFrame, as_of: AsOf) -> DataFrame:
    """Customer table from enriched orders.

    Attributes are the same on all orders of a customer, so ``max`` picks the
    value without an order. The distinct count groups by (customer, order)
    first, which spreads a customer with very many orders over all tasks.
    """
    rolled = (
        enriched.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            *[F.max(c).alias(c) for c in _ATTRIBUTES],
            F.countDistinct("order_id").alias("total_orders"),
            F.sum("final_amount").alias("total_spent"),
        )
    )
    return _customer_rows(rolled, as_of)


def customer_totals(orders: DataFrame) -> DataFrame:
    """Orders and spend per customer from three columns of the order table."""
    return (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            F.sum("final_amount").alias("total_spent"),
        )
    )


def customers_from_orders(orders: DataFrame, users: DataFrame, as_of: AsOf) -> DataFrame:
    """The same customer table from the order table, or from order facts: totals
    first, users after.

    Only three narrow columns per order are shuffled, and the users meet one row
    per customer instead of one per order; unknown users drop out there. The jobs
    use this on the stored order table, so nothing has to be cached.
    """
    rolled = customer_totals(orders).join(user_attributes(users, as_of), "customer_id", "inner")
    return _customer_rows(rolled, as_of)


# ---- reports -----------------------------------------------------------------


def segment_summary(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("customer_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.round(F.avg("total_spent"), 0).cast("decimal(18,0)").alias("avg_spent"),
        )
        .orderBy(F.desc("avg_spent"), "customer_segment")
    )


def payment_revenue(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("payment_method")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.round(F.sum("final_amount"), 0).cast("decimal(24,0)").alias("revenue"),
        )
        .orderBy(F.desc("revenue"), "payment_method")
    )


def total_revenue(orders: DataFrame) -> DataFrame:
    return orders.agg(F.sum("final_amount").alias("total"))


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row count per named table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def status_summary(status: DataFrame) -> DataFrame:
    return status.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("written").alias("written"),
        F.count_if(~F.col("written")).alias("failed"),
    )


def run_summary(carts: DataFrame, customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row: carts seen, orders kept and skipped, customer rows.

    Meant for stored tables: each input is counted once, on one column.
    """
    seen = carts.agg(F.count(F.lit(1)).alias("carts"))
    kept = orders.agg(F.count(F.lit(1)).alias("orders"))
    rows = customers.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("customer_id").alias("unique")
    )
    return rows.select(
        F.col("rows").alias("customer_rows"),
        F.col("unique").alias("unique_customers"),
        kept.scalar().alias("orders_enriched"),
        (seen.scalar() - kept.scalar()).alias("orders_skipped"),
    )


# ---- filters, search, order, limits ------------------------------------------


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def facet(df: DataFrame, column: str) -> DataFrame:
    """Values of a column and how often each occurs."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def apply_facets(df: DataFrame, chosen: dict) -> DataFrame:
    for column, value in chosen.items():
        df = filter_eq(df, column, value)
    return df


CUSTOMER_SEARCH_FIELDS = ["full_name", "email", "email_domain", "city"]
ORDER_SEARCH_FIELDS = ["order_id", "dominant_category"]


def search(df: DataFrame, words: str, fields: list[str]) -> DataFrame:
    """Rows where every word occurs, in any case, in at least one of the fields."""
    for word in words.split():
        anywhere: Column = F.lit(False)
        for field in fields:
            anywhere = anywhere | F.contains(
                F.lower(F.coalesce(F.col(field), F.lit(""))), F.lit(word.lower())
            )
        df = df.filter(anywhere)
    return df


def failed_only(status: DataFrame) -> DataFrame:
    return status.filter(~F.col("written"))


def top_by(df: DataFrame, column: str, k: int, tie: str) -> DataFrame:
    """The k rows with the largest value; ``tie`` makes the choice unique."""
    return df.orderBy(F.desc(column), F.asc(tie)).limit(k)


def top_customers(customers: DataFrame, segment: str = "High", k: int = 5) -> DataFrame:
    return top_by(
        filter_eq(customers, "customer_segment", segment), "total_spent", k, "customer_id"
    )


def customer_order() -> list[Column]:
    return [F.desc("lifetime_value_score"), F.asc("customer_id")]


def order_order(by_timestamp: bool = False) -> list[Column]:
    """Newest day first and early hours first, or simply newest first."""
    if by_timestamp:
        return [F.desc("order_timestamp"), F.asc("order_id")]
    return [F.desc("order_date"), F.asc("order_hour"), F.asc("order_id")]


def order_customers(customers: DataFrame) -> DataFrame:
    return customers.orderBy(*customer_order())


def order_orders(orders: DataFrame, by_timestamp: bool = False) -> DataFrame:
    return orders.orderBy(*order_order(by_timestamp))


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def view_status(
    status: DataFrame, only_failed: bool = False, limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows to show, summary). The summary counts before the limit."""
    shown = failed_only(status) if only_failed else status
    if limit is not None:
        shown = head(shown, limit, "record_id")
    return shown, status_summary(status)
