"""One query per operator over its whole table; what SQL can express has a twin."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwright.session import scratch_path

from . import chat, decontaminate, embed_dedup, html_blocks, mixing, packing, quality, ranked
from . import repair, secrets, simhash, sql, suffix_dedup, token_files
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    if fn.__name__ in sql.TWINS:
        ORACLES[fn.__name__] = sql.TWINS[fn.__name__]
    return fn


@query
def op1_token_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, d, "documents"), path, BYTE_BPE, end_id=2)
    return token_files.read_token_files(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op3_best_two_fit(spark: SparkSession, d: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, d, "documents"), BYTE_BPE, capacity=2048, end_id=0)
    return packed.layout.drop("shard", "row")


@query
def op6_chat_format(spark: SparkSession, d: str) -> DataFrame:
    both = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", both), (-7, 1, "assistant", both)],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.read_conversations(chat.format_turns(turns, BYTE_BPE), BYTE_BPE)


@query
def op8_byte_network(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = quality.train_on(docs, table(spark, d, "labels"))
    return docs.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        quality.quality_score(F.col("text"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op10_token_efficiency(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, BYTE_BPE_RANKS)
    spans = F.col("secret_spans")

    def joined(items):
        parts = F.transform(items, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
        return F.array_join(parts, ",")

    def count(kind: str):
        return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")

    base = F.filter(spans, lambda x: x["kind"] != "random")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
        count("random").alias("n_random"),
    )


@query
def op5_simhash_balls(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, d, "documents"), simhash.FOUR_SHINGLES)
    digits = F.lower(F.hex("prints"))  # little-endian bytes
    number = F.concat(*(F.substring(digits, i, 2) for i in range(15, 0, -2)))
    return found.select("doc_id", number.alias("fingerprint"), "component_id")


@query
def op4_latent_retrieval(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op7_sorted_projections(spark: SparkSession, d: str) -> DataFrame:
    found = embed_dedup.near_duplicates(table(spark, d, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query
def op2_block_labeller(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    return html_blocks.extract_text(pages).withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op9_suffix_runs(spark: SparkSession, d: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, d, "documents"))
    removed = F.transform("removed", lambda x: x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate(removed, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op11_target_alignment(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repair_conversations(repair.damaged(turns), turns)


@query
def op12_pair_maxscore(spark: SparkSession, d: str) -> DataFrame:
    index = ranked.build_index(table(spark, d, "documents"))
    return ranked.search(index, table(spark, d, "benchmark"), wanted=50)


@query
def op13_repetition_rates(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    plan = mixing.mixing_plan(docs, weights=(3, 1, 2), share=1.5, most=2.0)
    return plan.select("doc_id", "size", "source_size", "target", "taken")
