"""Stored tables.

With a table format that has snapshots (a V2 catalog) the format replaces the
table. In the session catalog every write goes to a new folder and the table is
pointed at it afterwards: readers see the old or the new table, never a mix, a
failed write changes nothing, and the older folders stay as history. Only a change of
columns or format takes the table away for a moment, as this catalog cannot change it.

Tables that are upserted in the session catalog are partitioned by a hash of their key
(``_bucket``). A batch rewrites the buckets that its keys fall into, in a new folder, and
points these partitions at it, one after the other: of every key readers see the old
or the new row, and files that a reader has opened stay.

A table can have a contract. Its rules are judged in the pass that stores the batch;
broken rows change no table and are kept beside it, each with the rules that it breaks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions.time import AsOf, as_of_timestamp
from ..operators.gate import (
    BROKEN,
    ContractError,
    Judged,
    broken_rules,
    mark_repeats,
    repeated_keys,
)
from ..operators.items import to_documents
from ..operators.keys import last_if_repeated
from ..operators.store import AUDIT, empty_store, evolve, merge_rows, upsert_counts
from ..schemas import Contract

BUCKET = "_bucket"
BUCKETS = 64


def _is_v2(spark: SparkSession, name: str) -> bool:
    parts = name.split(".")
    return len(parts) > 2 and parts[0] != "spark_catalog"


def _ensure_namespace(spark: SparkSession, name: str) -> None:
    namespace = name.rpartition(".")[0]
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def _fits(df: DataFrame, name: str, fmt: str) -> bool:
    """Whether the table exists with these columns in this format.

    A managed table is refused: replacing it would delete its files.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return False
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if facts.get("Type") == "MANAGED":
        raise ValueError(f"{name} is a managed table; publish_table only replaces its own")

    def columns(frame: DataFrame) -> list:
        return [(f.name, f.dataType) for f in frame.schema]

    return facts.get("Provider", "").lower() == fmt.lower() and columns(spark.table(name)) == columns(df)


def _columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _point_to(spark: SparkSession, name: str, like: DataFrame, location: str, fmt: str) -> DataFrame:
    """Make a folder the content of an unpartitioned table with the columns of ``like``."""
    if _fits(like, name, fmt):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
    else:
        # The table is external: dropping it leaves the files of older versions.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = _columns_ddl(like.schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} LOCATION '{location}'")
    return spark.table(name)


def publish_table(
    df: DataFrame,
    name: str,
    root: str,
    fmt: str | None = None,
    contract: Contract | None = None,
    keep_good: bool = False,
) -> DataFrame:
    """Create or replace a table and return it as stored.

    ``root`` is the folder for the table's files in the session catalog; a V2
    catalog places its files itself.

    With a ``contract`` the rows are judged while they are stored. If some break it,
    they become the table ``<name>_quarantine`` and the table stays as it was
    (``ContractError``), or gets the good rows alone with ``keep_good``.
    """
    spark = df.sparkSession
    _ensure_namespace(spark, name)
    if contract is not None:
        path, judged = _judged(df, root, contract, unique=True)
        if judged.broken:
            _quarantine(judged, name, root, refuse=not keep_good)
        elif not _is_v2(spark, name) and (fmt or "parquet") == "parquet":
            # The judged rows are the table; the column of broken rules is no part of it.
            return _point_to(spark, name, judged.accepted, path, "parquet")
        df = judged.accepted
    if _is_v2(spark, name):
        writer = df.writeTo(name)
        (writer.using(fmt) if fmt else writer).createOrReplace()
        return spark.table(name)
    fmt = fmt or "parquet"
    location = _new_location(root, name)
    df.write.format(fmt).save(location)
    return _point_to(spark, name, df, location, fmt)


def _new_location(root: str, name: str) -> str:
    return f"{root}/{name.replace('.', '/')}/{uuid.uuid4().hex}"


# ---- contracts ---------------------------------------------------------------------


def _judged(df: DataFrame, root: str, contract: Contract, unique: bool) -> tuple[str, Judged]:
    """The rows stored once with the rules that they break, counted on the way.

    Only repeated keys need a look at the other rows: at the stored key column.
    """
    path, rows, seen = _handed_over(
        df.withColumn(BROKEN, broken_rules(contract)), root, {"broken": F.count(BROKEN)}
    )
    judged = Judged(rows, seen["rows"], seen["broken"])
    if not unique:
        return path, judged
    repeated = repeated_keys(rows, contract.key)
    if repeated.isEmpty():
        return path, judged
    path, rows, seen = _handed_over(
        mark_repeats(rows, contract, repeated), root, {"broken": F.count(BROKEN)}
    )
    return path, Judged(rows, seen["rows"], seen["broken"])


def _quarantine(judged: Judged, name: str, root: str, refuse: bool) -> None:
    rows = publish_table(judged.quarantined, f"{name}_quarantine", root)
    if refuse:
        raise ContractError(name, rows, judged.violations())


# ---- upsert ------------------------------------------------------------------------


def _handed_over(
    df: DataFrame, root: str, figures: dict[str, Column]
) -> tuple[str, DataFrame, dict[str, int]]:
    """Computed once and read back, with figures counted while it was written."""
    path = f"{root}/handover/{uuid.uuid4().hex}"
    seen = Observation()
    counts = [c.alias(n) for n, c in figures.items()]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.option("compression", "zstd").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return path, stored, {n: seen.get.get(n, 0) for n in ("rows", *figures)}


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _bucket_locations(spark: SparkSession, name: str) -> set[int]:
    parts = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return {int(r.partition.rpartition("=")[2]) for r in parts}


def _stored_buckets(spark: SparkSession, name: str) -> int | None:
    """How many buckets a table has; None if it has none or does not exist."""
    if not spark.catalog.tableExists(name):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").where("key = 'buckets'").first()
    return int(found.value) if found else None


def _rewrite_buckets(
    batch: DataFrame,
    name: str,
    key: str,
    root: str,
    columns: T.StructType,
    put: dict[str, Column],
    defaults: dict | None,
    buckets: int,
) -> dict[str, int]:
    """Put the rows of ``batch`` over the stored rows with their keys, in the buckets that
    it touches.

    ``batch`` is unique by key. ``put`` tells the columns of a key that the batch brings, from
    its row ``new`` and the stored one ``old``, null if there was none; other stored rows
    stay. A table without buckets or with other columns is rewritten whole. Rows meet by
    their bucket, which is also how they are written, so both sides move once. Figures are
    counted in the writing pass: keys ``created``, and ``rows`` brought.
    """
    spark = batch.sparkSession
    _ensure_namespace(spark, name)
    exists = spark.catalog.tableExists(name)
    n = _stored_buckets(spark, name)
    stored = spark.table(name) if exists else None
    same = n is not None and [(f.name, f.dataType) for f in stored.drop(BUCKET).schema] == [
        (f.name, f.dataType) for f in columns
    ]
    n = n or buckets
    if same:
        touched = [r[0] for r in batch.select(bucket_of(key, n)).distinct().collect()]
        if not touched:
            return {"created": 0, "rows": 0}
        stored = stored.where(F.col(BUCKET).isin(touched))
    names = columns.fieldNames()
    new = batch.select(
        F.col(key), F.struct(*batch.columns).alias("new"), bucket_of(key, n).alias(BUCKET)
    )
    if stored is None:
        met = new.withColumn("old", F.lit(None).cast(columns))
    else:
        old = evolve(stored, columns, defaults).select(
            F.col(key), F.struct(*names).alias("old"), bucket_of(key, n).alias(BUCKET)
        )
        together = old.unionByName(new, allowMissingColumns=True).repartition(BUCKET)
        # A key has one row of each kind at most; rows without a key meet none.
        alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
        met = (
            together.withColumn("_alone", alone)
            .groupBy(BUCKET, key, "_alone")
            .agg(F.max("old").alias("old"), F.max("new").alias("new"))
        )
    fresh = F.col("new").isNotNull()
    seen = Observation()
    location = _new_location(root, name)
    rows = met.observe(
        seen,
        F.count_if(fresh & F.col("old").isNull()).alias("created"),
        F.count_if(fresh).alias("rows"),
    ).select(*[F.when(fresh, put[c]).otherwise(F.col(f"old.{c}")).alias(c) for c in names], BUCKET)
    if stored is None:
        # Rows of a bucket together, large buckets split by their size.
        rows = rows.hint("rebalance", BUCKET)
    rows.write.option("compression", "zstd").partitionBy(BUCKET).parquet(location)
    if same:
        known = _bucket_locations(spark, name)
        for b in touched:
            place = f"PARTITION ({BUCKET} = {b})"
            change = f"{place} SET LOCATION" if b in known else f"ADD {place} LOCATION"
            spark.sql(f"ALTER TABLE {name} {change} '{location}/{BUCKET}={b}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(
            f"CREATE TABLE {name} ({_columns_ddl(columns)}, {BUCKET} int) USING parquet "
            f"PARTITIONED BY ({BUCKET}) LOCATION '{location}' TBLPROPERTIES ('buckets' = '{n}')"
        )
        spark.catalog.recoverPartitions(name)
    return {c: seen.get.get(c, 0) for c in ("created", "rows")}


def merge_statement(name: str, source: str, key: str, columns: list[str]) -> str:
    """SQL that upserts rows of ``source`` (with a column ``now``) in a V2 format."""
    put = ", ".join(f"t.{c} = s.{c}" for c in columns if c != key)
    names = ", ".join([*columns, *AUDIT])
    values = ", ".join([*(f"s.{c}" for c in columns), "s.now", "s.now"])
    updates = f"{put}, t.updated_at = s.now" if put else "t.updated_at = s.now"
    return (
        f"MERGE INTO {name} t USING {source} s ON t.{key} = s.{key} "
        f"WHEN MATCHED THEN UPDATE SET {updates} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def upsert_table(
    incoming: DataFrame,
    name: str,
    key: str,
    root: str,
    as_of: AsOf,
    seq: tuple[str, ...] = (),
    defaults: dict | None = None,
    contract: Contract | None = None,
    buckets: int = BUCKETS,
    published: bool = False,
) -> tuple[int, int]:
    """Upsert into a stored table in one step; (created, updated).

    A table stored before a column existed is brought to the columns of ``incoming``
    first, with ``defaults`` for its rows. A V2 format merges the batch; in the session
    catalog the touched buckets are written anew. ``buckets`` counts for a new table: a
    bucket should stay within what a few tasks write.

    Rows that break the ``contract`` refuse the batch (``ContractError``); they are kept
    as ``<name>_quarantine``. A repeated key is no fault here: its last row wins.

    ``published`` says that ``incoming`` is a table that ``publish_table`` stored under this
    contract: it is neither stored nor judged again, and its keys are unique.
    """
    spark = incoming.sparkSession
    if published:
        batch, rows = incoming, None
    elif contract is not None:
        _, judged = _judged(incoming, root, contract, unique=False)
        if judged.broken:
            _quarantine(judged, name, root, refuse=True)
        batch, rows = judged.accepted, judged.seen
    else:
        _, batch, counts = _handed_over(incoming, root, {})
        rows = counts["rows"]
    columns = T.StructType([*batch.schema, *empty_store(batch).schema[-len(AUDIT) :]])
    latest = batch if published else last_if_repeated(batch, key, *seq)
    if _is_v2(spark, name):
        existing = spark.table(name) if spark.catalog.tableExists(name) else empty_store(batch)
        created, updated = upsert_counts(evolve(existing, columns, defaults), batch, key).first()
        if not spark.catalog.tableExists(name):
            publish_table(merge_rows(existing, latest, key, as_of).drop("created"), name, root)
            return created, updated
        source = latest.withColumn("now", as_of_timestamp(as_of))
        source.createOrReplaceTempView(view := f"batch_{uuid.uuid4().hex}")
        spark.sql(merge_statement(name, view, key, batch.columns))
        return created, updated

    now = as_of_timestamp(as_of)
    put = {c: F.col(f"new.{c}") for c in batch.columns}
    put |= {"created_at": F.coalesce("old.created_at", now), "updated_at": now}
    done = _rewrite_buckets(latest, name, key, root, columns, put, defaults, buckets)
    return done["created"], (done["rows"] if rows is None else rows) - done["created"]


def write_documents(
    df: DataFrame,
    fields: tuple[str, ...],
    id_field: str,
    name: str,
    root: str,
    buckets: int = BUCKETS,
    published: bool = False,
) -> int:
    """Write documents by id, replacing those with the same id; rows written.

    The store is a table (doc_id, doc) in buckets of the id. Without rows nothing is
    written. ``published`` as in ``upsert_table``, with a contract on ``id_field``.
    """
    latest = to_documents(df, fields, id_field)
    rows = None
    if not published:
        _, batch, seen = _handed_over(latest, root, {})
        rows = seen["rows"]
        if rows == 0:
            return 0
        latest = last_if_repeated(batch, "doc_id")
    elif latest.isEmpty():
        return 0

    def merge(existing: DataFrame) -> DataFrame:
        return existing.join(latest, "doc_id", "left_anti").unionByName(latest)

    if _is_v2(df.sparkSession, name):
        exists = df.sparkSession.catalog.tableExists(name)
        whole = merge(df.sparkSession.table(name)) if exists else latest
        publish_table(whole.select("doc_id", "doc"), name, root)
        return latest.count() if rows is None else rows
    put = {c: F.col(f"new.{c}") for c in ("doc_id", "doc")}
    done = _rewrite_buckets(latest, name, "doc_id", root, latest.schema, put, None, buckets)
    return done["rows"] if rows is None else rows
