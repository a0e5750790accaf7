"""One row per key, and rows numbered in key order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import time
from ..session import scratch_path

# monotonically_increasing_id holds the partition above these bits and the row below.
ROW_BITS = 33


def number_in_order(df: DataFrame, *keys: str | Column, name: str = "number") -> DataFrame:
    """``df`` with its rows numbered 0, 1, 2… in the order of ``keys``.

    The rows are dealt by ranges of the keys, so a partition holds consecutive numbers:
    the place of a row in its partition plus the rows of the partitions before. The dealt
    rows are stored once, because a second range partitioning may draw other borders.
    Only one count per partition is added up in one place. Rows with equal keys get
    different numbers in no fixed order.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "numbered")
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField("_at", T.LongType())])
    stored = spark.read.schema(schema).parquet(path)
    part = F.shiftright("_at", ROW_BITS).alias("_part")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy(part)
        .agg(F.count(F.lit(1)).alias("n"))
        .select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    )
    place = F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)
    return (
        stored.select("*", part)
        .join(F.broadcast(starts), "_part")  # a row per partition
        .select(*df.columns, (F.col("_start") + place).alias(name))
    )


def last_per_key(df: DataFrame, key: str, *seq: str) -> DataFrame:
    """The last row of every key in the order of ``seq``.

    The maximum of (seq, whole row) is combined on the map side, so a key with
    very many rows leaves every task as one row; no task sorts a whole key. Rows
    that agree in ``seq`` are ordered by their other columns, which keeps the
    answer the same on every run.
    """
    ordered = [F.col(c) for c in seq]
    rest = [F.col(c) for c in df.columns if c != key and c not in seq]
    picked = [F.col(key) if c == key else F.col(f"_last.{c}").alias(c) for c in df.columns]
    return df.groupBy(key).agg(F.max(F.struct(*ordered, *rest)).alias("_last")).select(*picked)


def has_repeats(df: DataFrame, key: str) -> bool:
    """Whether a key (null counts as one) has more than one row. Reads the key alone, combined
    on the map side."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return not counted.where("n > 1").isEmpty()


def last_if_repeated(df: DataFrame, key: str, *seq: str) -> DataFrame:
    """``last_per_key`` for rows that are stored or cheap to read: when no key repeats, the
    rows stay where they are, and only their keys are moved to see that."""
    return last_per_key(df, key, *seq) if has_repeats(df, key) else df


def dedupe_users(users: DataFrame, *seq: str) -> DataFrame:
    """One row per user id: the last in the order of ``seq``.

    A frame of documents has no row order of its own, so "last" needs a column. The
    default is the moment of signup; text that is no time comes before all others.
    """
    known = users.filter(F.col("id").isNotNull())
    if seq:
        return last_per_key(known, "id", *seq)
    created = F.col("createdAt")
    if isinstance(users.schema["createdAt"].dataType, T.StringType):
        created = time.coerce_ts(created)
    timed = known.withColumn("_signup", created.cast("timestamp"))
    return last_per_key(timed, "id", "_signup").drop("_signup")
