"""Result tables as search documents and as key-value items."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import serialize, text


def to_documents(
    df: DataFrame, fields: tuple[str, ...], id_field: str, keep_nulls: bool = False
) -> DataFrame:
    """(doc_id, doc): one JSON document per row. A column outside ``fields`` is refused."""
    unknown = [c for c in df.columns if c not in fields]
    if unknown:
        raise ValueError(f"columns outside the strict mapping: {unknown}")
    if id_field not in df.columns:
        raise ValueError(f"no id column {id_field!r}")
    return df.select(
        F.col(id_field).cast("string").alias("doc_id"),
        serialize.to_doc(df, keep_nulls).alias("doc"),
    )


def to_items(df: DataFrame, id_field: str, record_type: str) -> DataFrame:
    """(record_id, record_type, item): the row and its key as one JSON object."""
    key = text.record_key(record_type, F.col(id_field))
    values = [
        serialize.kv_safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema
    ]
    keyed = df.select(
        key.alias("record_id"), F.lit(record_type).alias("record_type"), *values
    )
    return keyed.select(
        "record_id",
        "record_type",
        F.to_json(F.struct(*keyed.columns), {"ignoreNullFields": "false"}).alias("item"),
    )


def combine_items(*items: DataFrame) -> DataFrame:
    """Items of unlike tables in one set; duplicates stay."""
    result = items[0]
    for more in items[1:]:
        result = result.unionByName(more)
    return result


def to_kv_items(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return combine_items(
        to_items(customers, "customer_id", "customer"), to_items(orders, "order_id", "order")
    )
