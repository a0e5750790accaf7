"""Stored tables and the write-status file."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..schemas import WRITE_STATUS


# How texts are told apart in processed CSV files: nulls are \\N, empty ones quoted.
CSV_TEXT = {"escape": '"', "nullValue": "\\N"}


def read_processed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A snapshot of ``write_processed_csv``; texts may span lines."""
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True)
    return reader.options(**CSV_TEXT, emptyValue="").csv(path)


def read_ordered(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A snapshot of ``write_ordered`` with the ``place`` of each row, from 0.

    The place is that in the file and the rows of the files before; only the counts of
    files are added up in one place.
    """
    stored = spark.read.schema(schema).parquet(path)
    name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    # Names carry the number of the writing task, padded to five digits only.
    task = F.regexp_extract(name, r"^part-(\d+)-", 1).cast("int")
    file = F.struct(task.alias("task"), name.alias("name")).alias("_file")
    rows = stored.select("*", file, row.alias("_row"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy(file)
        .agg(F.count(F.lit(1)).alias("n"))
        .select("_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    )
    return rows.join(F.broadcast(starts), "_file").select(  # a row per file
        *schema.fieldNames(), (F.col("_start") + F.col("_row")).alias("place")
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Result of a query that a relational database runs; needs its driver jar.

    For a large table pass dbtable-style partitioning options
    (partitionColumn, lowerBound, upperBound, numPartitions).
    """
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    return reader.options(**options).load()


def register_views(customers: DataFrame, orders: DataFrame) -> None:
    """Give both result tables a name for ``spark.sql``."""
    customers.createOrReplaceTempView("customer_analytics")
    orders.createOrReplaceTempView("order_analytics")


def load_write_status(spark: SparkSession, path: str) -> DataFrame | None:
    """The status rows of the last key-value write, None when there was no run."""
    try:
        reader = spark.read.schema(WRITE_STATUS).option("header", True)
        return reader.option("escape", '"').option("multiLine", True).csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
