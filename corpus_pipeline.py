"""From raw documents to packed training sequences, in stages stored one after another.

Each stage works on all documents that its predecessor kept. Documents that the quality
classifier rejects, all but the first of each group of near-duplicates, and documents
with leaked benchmark items go; secrets are replaced in the text of documents that stay;
the last stage returns the pieces of the packed sequences. Rows are told apart by a
number of their own, so repeated or null document ids are decided row by row.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwright.llm import decontaminate, packing, quality, secrets, similar, simhash
from cartwright.llm.common import store, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_QUALITY = 0.5
# Ten thousand long texts at once, as Arrow, as strings and cut up, fill a Python worker.
BATCH_BYTES = str(4 << 20)


def _small_batches(spark: SparkSession) -> None:
    """Rows go to the Python workers a few megabytes at a time; no row is left out."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with a number for each row, stored so that it stays the same."""
    return store(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "rows")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least one half; scores are never null."""
    _small_batches(spark)
    model = quality.train_on(docs, table(spark, sf_dir, "labels"))
    score = quality.quality_score(F.col("text"), model)
    return docs.withColumn("score", score).where(F.col("score") >= LEAST_QUALITY).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group; links are pairs of similarity 0.8 or more
    (Jaccard, five-word shingles), counted exactly."""
    _small_batches(spark)
    rows = _numbered(docs)
    groups = similar.similar_documents(rows, simhash.FIVE_SHINGLES, least=0.8, id_column="row")
    groups = groups.select(F.col("doc_id").alias("row"), F.col("component_id").alias("part"))
    ids = rows.select("row", "doc_id").join(groups, "row")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = ids.groupBy("part").agg(F.min(order).alias("first")).select("first.row")
    return rows.join(first, "row", "left_semi").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked."""
    _small_batches(spark)
    rows = _numbered(docs)
    by_row = rows.select(F.col("row").alias("doc_id"), "text")
    leaks = decontaminate.find_leaks(by_row, table(spark, sf_dir, "benchmark"))
    leaked = leaks.select(F.col("doc_id").alias("row")).distinct()
    return rows.join(leaked, "row", "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their text replaced and the length counted anew."""
    _small_batches(spark)
    found = secrets.find_secrets(docs, BYTE_BPE_RANKS)
    clean = found.withColumn("text", secrets.redacted(F.col("text"), F.col("secret_spans")))
    changed = F.size("secret_spans") > 0
    length = F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", length).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    _small_batches(spark)
    packed = packing.pack_documents(docs, BYTE_BPE, capacity=2048, end_id=0)
    return packed.layout.drop("shard", "row")


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack),
]

# Learned filters and tokenizers are beyond SQL; tests/llm has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
