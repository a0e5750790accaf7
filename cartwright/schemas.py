"""Input schemas, result schemas, document mappings and table contracts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

PRODUCT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("discountPercentage", T.DoubleType()),
    ]
)

CART = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("userId", T.LongType()),
        T.StructField("orderId", T.StringType()),
        T.StructField("orderTimestamp", T.StringType()),
        T.StructField("products", T.ArrayType(PRODUCT)),
        T.StructField("paymentMethod", T.StringType()),
        T.StructField("shippingCost", T.DoubleType()),
        T.StructField("shippingProvider", T.StringType()),
    ]
)

USER = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("address", T.StructType([T.StructField("city", T.StringType())])),
        T.StructField("createdAt", T.StringType()),
    ]
)

WRITE_STATUS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("written", T.BooleanType()),
    ]
)

ORDER_ANALYTICS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_timestamp", T.TimestampType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("order_hour", T.IntegerType()),
        T.StructField("gross_amount", T.DecimalType(14, 2)),
        T.StructField("total_discount_amount", T.DecimalType(14, 2)),
        T.StructField("net_amount", T.DecimalType(14, 2)),
        T.StructField("shipping_cost", T.DecimalType(10, 2)),
        T.StructField("final_amount", T.DecimalType(14, 2)),
        T.StructField("total_items", T.IntegerType()),
        T.StructField("discount_ratio", T.DecimalType(6, 4)),
        T.StructField("order_complexity_score", T.IntegerType()),
        T.StructField("dominant_category", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("shipping_provider", T.StringType()),
    ]
)

CUSTOMER_ANALYTICS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("email_domain", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("customer_tenure_days", T.IntegerType()),
        T.StructField("total_orders", T.IntegerType()),
        T.StructField("total_spent", T.DecimalType(14, 2)),
        T.StructField("avg_order_value", T.DecimalType(14, 2)),
        T.StructField("lifetime_value_score", T.DecimalType(8, 2)),
        T.StructField("customer_segment", T.StringType()),
    ]
)

# Strict field lists of the search documents: a column outside is refused.
CUSTOMER_DOCUMENT_FIELDS = tuple(CUSTOMER_ANALYTICS.fieldNames())
ORDER_DOCUMENT_FIELDS = tuple(ORDER_ANALYTICS.fieldNames())


@dataclass(frozen=True)
class Contract:
    """What a stored table promises: unique key, no nulls, text and number limits."""

    key: str
    not_null: tuple[str, ...]
    max_length: dict[str, int] = field(default_factory=dict)
    # column -> (precision, scale)
    decimals: dict[str, tuple[int, int]] = field(default_factory=dict)


CUSTOMER_CONTRACT = Contract(
    key="customer_id",
    not_null=CUSTOMER_DOCUMENT_FIELDS,
    max_length={
        "full_name": 255,
        "email": 255,
        "email_domain": 100,
        "city": 100,
        "customer_segment": 20,
    },
    decimals={
        "total_spent": (14, 2),
        "avg_order_value": (14, 2),
        "lifetime_value_score": (8, 2),
    },
)

ORDER_CONTRACT = Contract(
    key="order_id",
    not_null=ORDER_DOCUMENT_FIELDS,
    max_length={
        "order_id": 100,
        "dominant_category": 100,
        "payment_method": 50,
        "shipping_provider": 100,
    },
    decimals={
        "gross_amount": (14, 2),
        "total_discount_amount": (14, 2),
        "net_amount": (14, 2),
        "final_amount": (14, 2),
        "shipping_cost": (10, 2),
        "discount_ratio": (6, 4),
    },
)

# Values given to rows stored before a column existed.
CUSTOMER_DEFAULTS = {"email_domain": ""}
ORDER_DEFAULTS = {"dominant_category": "", "order_complexity_score": 0, "shipping_provider": ""}
