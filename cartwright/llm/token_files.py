"""Binary token files with a shared compression dictionary and short-document access.

A file set is a folder of three Parquet tables:

``dictionary``  one row: its SHA-256, the zstandard dictionary, the width of an id
``blocks``      per row a block of documents in ascending order: the frames, one per
                document and compressed separately, one after another, the offset of
                each frame, the documents' ids and token counts, and the hash of the
                dictionary that the frames need
``shards``      the number of tokens before each shard (a sorted range of documents)

One document is read by decompressing one frame; no neighbour is touched.

Defined results: a null text is an empty one, so its document holds the end id only.
Null document ids come first, repeated ids stay apart in the order of their texts.
An empty table gives empty files. Columns other than the two named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import encoder, slices

BLOCKS = (
    "shard int, block int, start long, doc_ids array<long>, counts array<long>, "
    "offsets array<long>, payload binary, dictionary_sha256 string"
)
TOKENS = "doc_id long, shard int, start long, n_tokens long, ids binary"


def _serialize(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()


def train_dictionary(
    docs: DataFrame,
    tokenizer: str,
    width: int,
    sample: int = 2000,
    ids_each: int = 4096,
    size: int = 65536,
) -> bytes:
    """A zstandard dictionary from serialized id arrays.

    It is fitted on about ``sample`` documents chosen by a hash of their id (at most
    twice as many), of which up to ``ids_each`` ids serve as training material. A small
    table serves as a whole; where it is too little to train on, its id arrays themselves
    are the dictionary. Only texts without any id give an empty one.
    """
    n = max(1, docs.count())
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1, sample / n)) + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = encoder(tokenizer).encode(batch["text"])
            yield pd.DataFrame({"x": [_serialize(x, width)[: ids_each * width] for x in ids]})

    picked = docs.where(share).limit(2 * sample).select("text").mapInPandas(run, "x binary")
    material = sorted(bytes(r.x) for r in picked.collect() if r.x)
    if sum(map(len, material)) < 20 * size:
        size = sum(map(len, material)) // 20
    try:
        return zstandard.train_dictionary(size, material).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(material)[-65536:]


def _blocks(
    batches: Iterator[pd.DataFrame],
    tokenizer: str,
    end_id: int,
    width: int,
    dictionary: bytes,
    sha256: str,
    block_bytes: int,
    level: int,
) -> Iterator[pd.DataFrame]:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    compress = zstandard.ZstdCompressor(level=level, dict_data=shared).compress
    end = np.array([end_id], "<u4").tobytes()
    shard, block, start = TaskContext.get().partitionId(), 0, 0
    doc_ids, counts, frames, size = [], [], [], 0

    def close() -> pd.DataFrame:
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in frames])]).astype(np.int64)
        row = (shard, block, start, doc_ids, counts, offsets, b"".join(frames), sha256)
        return pd.DataFrame([row], columns=[c.split()[0] for c in BLOCKS.split(", ")])

    for batch in batches:
        texts = batch["text"].tolist()
        ids = batch["doc_id"].astype("Int64").tolist()
        for part in slices(texts):
            for doc_id, found in zip(ids[part], encoder(tokenizer).encode(texts[part])):
                found += end
                frames.append(compress(_serialize(found, width)))
                doc_ids.append(None if doc_id is pd.NA else doc_id)
                counts.append(len(found) // 4)
                size += len(frames[-1])
                if size >= block_bytes:
                    yield close()
                    block, start = block + 1, start + sum(counts)
                    doc_ids, counts, frames, size = [], [], [], 0
    if frames:
        yield close()


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_bytes: int = 1 << 20,
    level: int = 3,
) -> None:
    """Encode whole texts, add ``end_id`` to each and write them in ascending order."""
    width = 2 if max(end_id, encoder(tokenizer).tokenizer.get_vocab_size() - 1) < 1 << 16 else 4
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    dictionary = train_dictionary(rows, tokenizer, width)
    sha256 = hashlib.sha256(dictionary).hexdigest()
    spark = docs.sparkSession
    spark.createDataFrame(
        [(sha256, bytearray(dictionary), width)],
        "dictionary_sha256 string, dictionary binary, width int",
    ).write.parquet(f"{path}/dictionary")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _blocks(batches, tokenizer, end_id, width, dictionary, sha256, block_bytes, level)

    # The hash of the text lets a range boundary fall among rows that repeat an id.
    (
        rows.withColumn("h", F.xxhash64("text"))
        .repartitionByRange("doc_id", "h")
        .sortWithinPartitions("doc_id", "h", "text")
        .select("doc_id", "text")
        .mapInPandas(run, BLOCKS)
        .write.option("compression", "none")
        .parquet(f"{path}/blocks")
    )
    totals = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    (
        spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
        .groupBy("shard")
        .agg(F.sum(totals).alias("n_tokens"))  # one row per task of the write
        .select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
        .coalesce(1)
        .write.parquet(f"{path}/shards")
    )


def _reader(spark: SparkSession, path: str):
    row = spark.read.parquet(f"{path}/dictionary").head()
    dictionary, width, sha256 = bytes(row.dictionary), row.width, row.dictionary_sha256
    if hashlib.sha256(dictionary).hexdigest() != sha256:
        raise ValueError(f"the dictionary in {path} does not match its hash")

    def read(payload: bytes, offsets, index: int, needs: str) -> bytes:
        if needs != sha256:
            raise ValueError(f"block needs dictionary {needs}, found {sha256}")
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        frame = payload[offsets[index] : offsets[index + 1]]
        found = zstandard.ZstdDecompressor(dict_data=shared).decompress(frame)
        return np.frombuffer(found, f"<u{width}").astype("<u4").tobytes()

    return read, dictionary, width, sha256


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (binary, unsigned 32-bit little-endian) of every document."""
    _, dictionary, width, sha256 = _reader(spark, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        decompress = zstandard.ZstdDecompressor(dict_data=shared).decompress
        for batch in batches:
            for b in batch.itertuples():
                if b.dictionary_sha256 != sha256:
                    raise ValueError(f"block needs dictionary {b.dictionary_sha256}, found {sha256}")
                frames = [b.payload[x:y] for x, y in zip(b.offsets[:-1], b.offsets[1:])]
                ids = [np.frombuffer(decompress(x), f"<u{width}").astype("<u4") for x in frames]
                counts = np.array([len(x) for x in ids], np.int64)
                for i in range(0, len(ids), 1000):
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array(list(b.doc_ids[i : i + 1000]), "Int64"),
                            "shard": b.shard,
                            "start": b.start + (np.cumsum(counts) - counts)[i : i + 1000],
                            "n_tokens": counts[i : i + 1000],
                            "ids": [x.tobytes() for x in ids[i : i + 1000]],
                        }
                    )

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").mapInPandas(run, TOKENS)
    bases = spark.read.schema("shard int, base long").parquet(f"{path}/shards")
    return blocks.join(bases, "shard").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids"
    )


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of every document of that id, decompressing their frames only."""
    read, *_ = _reader(spark, path)
    holds = F.array_contains("doc_ids", F.lit(doc_id).cast("long"))
    out = []
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    for b in blocks.where(holds).orderBy("shard", "block").collect():
        for i in (i for i, x in enumerate(b.doc_ids) if x == doc_id):
            ids = read(bytes(b.payload), b.offsets, i, b.dictionary_sha256)
            out.append(np.frombuffer(ids, "<u4").tolist())
    return out
