"""Upsert by key, table contracts and schema evolution, as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import time
from ..functions.time import AsOf
from ..schemas import Contract
from .gate import row_rules, unique_rule
from .keys import last_per_key

AUDIT = ["created_at", "updated_at"]


def empty_store(incoming: DataFrame) -> DataFrame:
    """A stored table without rows that fits ``incoming``."""
    stamps = [T.StructField(c, T.TimestampType()) for c in AUDIT]
    return incoming.sparkSession.createDataFrame([], T.StructType([*incoming.schema, *stamps]))


def match_keys(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Key by key: is it stored, and how many incoming rows carry it (0 = none).

    Only the key column of both tables is read.
    """
    arriving = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("incoming_rows"))
    stored = existing.select(F.col(key), F.lit(True).alias("stored"))
    return stored.join(arriving, key, "full_outer").select(
        key,
        F.coalesce("stored", F.lit(False)).alias("stored"),
        F.coalesce("incoming_rows", F.lit(0).cast("bigint")).alias("incoming_rows"),
    )


def upsert_counts(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """created = new keys; updated = all other incoming rows, repeats included."""
    created = F.count_if(~F.col("stored"))
    rows = F.coalesce(F.sum("incoming_rows"), F.lit(0).cast("bigint"))
    return match_keys(existing, incoming, key).agg(
        created.alias("created"), (rows - created).alias("updated")
    )


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    as_of: AsOf,
    seq: tuple[str, ...] = (),
) -> DataFrame:
    """The table after the upsert.

    The last incoming row of a key replaces all its columns; ``created_at`` is
    kept, ``updated_at`` is refreshed. Both sides are unique by key when they
    meet, so no key is heavy in the join.
    """
    columns = incoming.columns
    merged = merge_rows(existing, last_per_key(incoming, key, *seq), key, as_of)
    return merged.select(*columns, *AUDIT)


def merge_rows(existing: DataFrame, latest: DataFrame, key: str, as_of: AsOf) -> DataFrame:
    """The table after ``latest``, unique by key, has replaced its rows; ``created`` tells
    the rows of new keys."""
    columns = latest.columns
    old = existing.select(F.col(key), F.struct(*columns, *AUDIT).alias("old"))
    new = latest.select(F.col(key), F.struct(*columns).alias("new"))
    now = time.as_of_timestamp(as_of)
    fresh = F.col("new").isNotNull()
    return old.join(new, key, "full_outer").select(
        *[
            F.when(fresh, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
            for c in columns
        ],
        F.coalesce("old.created_at", now).alias("created_at"),
        F.when(fresh, now).otherwise(F.col("old.updated_at")).alias("updated_at"),
        F.col("old").isNull().alias("created"),
    )


def coerce_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the types of ``schema``; a value that does not fit becomes null."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def check_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """(rule, violations): how many rows break each rule of a stored table.

    Rows are counted by key in one pass, combined on the map side; the key rule counts
    the surplus rows of repeated keys, without those that have none.
    """
    rules = row_rules(contract)
    by_key = df.groupBy(contract.key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(broken).alias(r) for r, broken in rules.items()],
    )
    nothing = F.lit(0).cast("bigint")
    surplus = F.sum(F.when(F.col(contract.key).isNotNull(), F.col("_rows") - 1))
    totals = {r: F.sum(F.col(f"`{r}`")) for r in rules} | {unique_rule(contract): surplus}
    counted = by_key.agg(*[F.coalesce(t, nothing).alias(r) for r, t in totals.items()])
    pairs = [
        F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").alias("violations")) for r in totals
    ]
    return counted.select(F.explode(F.array(*pairs)).alias("v")).select("v.rule", "v.violations")


def evolve(df: DataFrame, target: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Bring a table to the target columns.

    Missing columns appear with their default (null without one), nulls in a
    column with a default are filled, columns outside the target are dropped.
    """
    defaults = defaults or {}
    columns = []
    for f in target:
        value = F.lit(defaults.get(f.name)).cast(f.dataType)
        if f.name in df.columns:
            present = F.col(f.name).cast(f.dataType)
            value = F.coalesce(present, value) if f.name in defaults else present
        columns.append(value.alias(f.name))
    return df.select(*columns)
