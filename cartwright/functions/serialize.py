"""Values in the form that JSON documents and key-value items need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .time import iso_text


def json_safe(c: Column, type_: T.DataType) -> Column:
    """NaN to null, times to ISO text, decimals to numbers.

    A date takes the timestamp form (midnight), the one the order documents use.
    """
    if isinstance(type_, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    if isinstance(type_, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(c.cast("timestamp"))
    if isinstance(type_, T.DateType):
        return iso_text(c.cast("timestamp"))
    if isinstance(type_, T.DecimalType):
        return c.cast("double")
    return c


def kv_safe(c: Column, type_: T.DataType) -> Column:
    """Times to ISO text, also inside arrays, maps and structs; other values stay.

    Doubles stay too: their JSON number is the shortest decimal text, which a
    reader turns into an exact decimal without binary digits.
    """
    if isinstance(type_, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(c.cast("timestamp"))
    if isinstance(type_, T.DateType):
        return c.cast("string")
    if isinstance(type_, T.ArrayType):
        return F.transform(c, lambda x: kv_safe(x, type_.elementType))
    if isinstance(type_, T.MapType):
        return F.transform_values(c, lambda _k, v: kv_safe(v, type_.valueType))
    if isinstance(type_, T.StructType):
        whole = F.struct(*[kv_safe(c[f.name], f.dataType).alias(f.name) for f in type_])
        return F.when(c.isNotNull(), whole)
    return c


def to_doc(df: DataFrame, keep_nulls: bool = False) -> Column:
    """The whole row as one JSON object; null fields are left out unless kept."""
    fields = [json_safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": str(not keep_nulls).lower()})


def customer_label() -> Column:
    return F.concat_ws(
        " | ",
        F.col("full_name"),
        F.col("customer_segment"),
        F.concat(F.lit("$"), F.col("total_spent").cast("string")),
    )


def order_label() -> Column:
    return F.concat_ws(
        " | ",
        F.concat(F.lit("Order "), F.substring("order_id", 1, 8), F.lit("…")),
        F.concat(F.lit("$"), F.col("final_amount").cast("string")),
        F.col("payment_method"),
    )
