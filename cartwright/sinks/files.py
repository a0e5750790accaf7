"""File snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..session import scratch_path
from ..sources.tables import CSV_TEXT


def write_raw_json(df: DataFrame, path: str) -> str:
    """Replace the raw snapshot: one JSON document per line, many gzip files.

    A gzip file is read by one task, so the snapshot has as many tasks as wrote it.
    """
    df.write.mode("overwrite").option("compression", "gzip").json(path)
    return path


def write_processed_csv(df: DataFrame, path: str) -> str:
    """Replace the processed snapshot. Quotes are doubled and nulls are written as
    ``\\N``, so any text survives, the empty one too; ``read_processed_csv`` reads it."""
    writer = df.write.mode("overwrite").option("header", True).option("compression", "gzip")
    writer.options(**CSV_TEXT, emptyValue='""').csv(path)
    return path


def write_ordered(df: DataFrame, path: str, *order: str | Column) -> str:
    """Replace a snapshot in which the rows follow one another in ``order``, within a file
    and from file to file by name.

    The rows are dealt by ranges and sorted inside them, so every task sorts its share;
    ``read_ordered`` gives each row its place. Finding the borders of the ranges reads the
    rows once more, so they are stored first: their plan runs once.
    """
    rows = scratch_path(df.sparkSession, "unordered")
    df.write.parquet(rows)
    stored = df.sparkSession.read.schema(df.schema).parquet(rows)
    ranges = stored.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges.write.mode("overwrite").parquet(path)
    return path
