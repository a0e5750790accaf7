"""Frames that start on the driver: a number range, a handful of local rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..schemas import USER


def order_ids(spark: SparkSession, n: int) -> DataFrame:
    """The integers 1..n, generated on the executors."""
    return spark.range(1, n + 1)


def users_from_rows(spark: SparkSession, rows: Iterable[Mapping]) -> DataFrame:
    """User documents held in memory; fields that are missing become null."""
    names = USER.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], USER)
