"""Landed JSON documents: carts, users, and the envelopes they arrive in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..schemas import CART, USER


def _read(spark: SparkSession, path: str, schema: T.StructType, lines: bool) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_carts(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Carts from JSON files, one document per line, which Spark can split.

    ``lines=False`` reads indented arrays, where a file is the unit of work.
    """
    return _read(spark, path, CART, lines)


def read_users(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    return _read(spark, path, USER, lines)


CORRUPT = "_corrupt_document"


@dataclass(frozen=True)
class Landed:
    """Landed documents with their broken ones set aside.

    ``documents`` are the rows that fit the schema, ``broken`` the text of the others.
    ``seen`` counts both in the first job that reads ``documents``: ``rows``, ``broken``,
    and ``blank`` (sound JSON without any known field).
    """

    documents: DataFrame
    broken: DataFrame
    seen: Observation

    def broken_count(self) -> int:
        """Broken documents, once a job has read ``documents``."""
        return self.seen.get.get("broken", 0)


def read_landed(
    spark: SparkSession, path: str, schema: T.StructType, lines: bool = True
) -> Landed:
    """Documents that fit ``schema``, without those that are no JSON or hold a value of
    another type; by themselves these would become rows of nulls.

    The text of a broken document stays in a column beside the rows. The figures read
    every field, so no job parses less than the whole document, and the same documents
    are broken whatever columns are asked for.
    """
    whole = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(whole).option("multiLine", not lines)
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    known = F.coalesce(*[F.col(f.name).isNotNull() | F.lit(None) for f in schema])

    def counted(seen: Observation) -> DataFrame:
        return rows.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count(CORRUPT).alias("broken"),
            F.count_if(F.col(CORRUPT).isNull() & known.isNull()).alias("blank"),
        )

    seen = Observation()
    good, bad = F.col(CORRUPT).isNull(), F.col(CORRUPT).isNotNull()
    return Landed(
        counted(seen).where(good).select(*schema.fieldNames()),
        counted(Observation()).where(bad).select(F.col(CORRUPT).alias("document")),
        seen,
    )


def load_seed(
    spark: SparkSession, carts_path: str, users_path: str, lines: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Seed carts and users; a folder that never landed gives an empty frame."""

    def load(path: str, schema: T.StructType) -> DataFrame:
        try:
            return _read(spark, path, schema, lines)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    return load(carts_path, CART), load(users_path, USER)


def unwrap_envelope(df: DataFrame, field: str) -> DataFrame:
    """All rows inside ``{"<field>": [...]}``."""
    return df.select(F.explode(field).alias("doc")).select("doc.*")
