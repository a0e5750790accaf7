r"""Ranked lexical search with pair bounds (MaxScore).

Terms are maximal runs of letters, digits and characters beyond ASCII, with only A-Z
lower-cased. A term's weight is ``floor(1000 * ln((2 N + 2) / (2 df + 1)))`` over the N
documents that hold a term; its impact in a document is
``weight * ((10^9 tf) div (1000 tf + 20 m))`` with ``m = 50 + (50 n N) div L`` for n terms
of L in all. A document's score is the sum over the query's different terms.

Index. Every task turns its documents into shards of bounded text and writes, for each
term of a shard, the documents and counts; a shard also keeps the ids and lengths of its
documents. Nothing is shuffled, every document and every term is indexed, and the table
serves any number of queries.

Search. Queries are read in blocks of bounded size. The postings of a block's terms are
joined out of the index and gathered in groups of shards, as many as the text asks for. In
a group, first the lists of term pairs are made: the terms of a query are paired by
falling weight, and for every pair the documents that hold both are intersected. A pair's
joint maximum is the largest sum of impacts found there; the pair can give no document
more than that or its larger single maximum, which for rare terms is far less than the
sum of both maxima. The kth largest joint impact is a threshold before any scoring.

Each query then adds its pairs in falling order of their bounds. Once the bounds of the
pairs that are left fall below the threshold, no new document can enter: only documents
whose score and the rest of the bounds reach the threshold are looked up further, and they
get fewer with every pair. All comparisons keep ties, so the result is exact. The best of
the groups are ranked in two steps, so a query's rows never depend on one large sort.

Defined results: equal scores are ordered by id, null first; repeated rows are documents
of their own; a null or empty text has no terms; scores of 0 are left out; a repeated or
null item id is an item of its own row. Other columns are not read. Empty tables give an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import discard, store

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHARD_BYTES = 16_000_000
GROUP_TERMS = 2_000_000
BLOCK_ITEMS, BLOCK_TERMS = 500, 100_000

INDEX = (
    "shard long, term string, docs array<int>, counts array<int>, "
    "ids array<long>, lengths array<long>"
)
INDEX_ARROW = pa.schema(
    [
        ("shard", pa.int64()),
        ("term", pa.string()),
        ("docs", pa.list_(pa.int32())),
        ("counts", pa.list_(pa.int32())),
        ("ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
    ]
)


def split_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in order, and the number of the text of each."""
    lower = pc.ascii_lower(pc.fill_null(texts, ""))
    lists = pc.split_pattern_regex(lower, SEPARATORS)
    terms, owners = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(terms), 0)
    return terms.filter(real), owners.filter(real).to_numpy().astype(np.int64)


# ---- index -------------------------------------------------------------------------


def _shard_batches(shard: int, ids: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    terms, owners = split_terms(texts)
    n_docs = len(texts)
    coded = terms.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    keys, counts = np.unique(codes * n_docs + owners, return_counts=True)
    found, docs = np.divmod(keys, n_docs)
    # Codes are dense and the keys sorted, so each term is one run.
    starts = np.searchsorted(found, np.arange(len(coded.dictionary) + 1)).astype(np.int32)
    lengths = np.bincount(owners, minlength=n_docs)

    def batch(n: int, **columns: pa.Array) -> pa.RecordBatch:
        nothing = {f.name: pa.nulls(n, f.type) for f in INDEX_ARROW}
        columns["shard"] = pa.array(np.full(n, shard))
        return pa.RecordBatch.from_pydict(nothing | columns, INDEX_ARROW)

    one = pa.array([0, n_docs], pa.int32())
    yield batch(
        1,
        ids=pa.ListArray.from_arrays(one, ids),
        lengths=pa.ListArray.from_arrays(one, pa.array(lengths, pa.int64())),
    )
    if len(starts) > 1:
        yield batch(
            len(starts) - 1,
            term=coded.dictionary,
            docs=pa.ListArray.from_arrays(starts, pa.array(docs, pa.int32())),
            counts=pa.ListArray.from_arrays(starts, pa.array(counts, pa.int32())),
        )


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    parts: list[pa.RecordBatch] = []
    size = made = 0

    def closed() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        ids, texts = (table.column(c).combine_chunks() for c in ("doc_id", "text"))
        yield from _shard_batches(first + made, ids, texts)

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy())
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            # At least one document, and no more than the shard has room for.
            end = int(np.searchsorted(ends, before + SHARD_BYTES - size, "right"))
            end = min(max(end, start + 1), batch.num_rows)
            parts.append(batch.slice(start, end - start))
            size += int(ends[end - 1] - before)
            start = end
            if size >= SHARD_BYTES or start < batch.num_rows:
                yield from closed()
                parts, size, made = [], 0, made + 1
    if parts:
        yield from closed()


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index: a row per shard and term, and one per shard with its documents."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return store(narrow.mapInArrow(_build, INDEX), "lexical-index")


# ---- queries -----------------------------------------------------------------------


@dataclass
class Block:
    """Queries that are searched together: their terms, by falling weight later on."""

    numbers: list[int] = field(default_factory=list)
    terms: list[list[str]] = field(default_factory=list)

    def vocabulary(self) -> list[str]:
        return sorted({t for terms in self.terms for t in terms})


def read_blocks(items: DataFrame) -> Iterator[Block]:
    """Items in blocks of bounded size; one partition at a time comes to the driver."""
    block, size = Block(), 0
    for number, text in items.select("number", "text").toLocalIterator():
        terms = sorted(set(split_terms(pa.array([text], pa.string()))[0].to_pylist()))
        if block.terms and (len(block.terms) >= BLOCK_ITEMS or size + len(terms) > BLOCK_TERMS):
            yield block
            block, size = Block(), 0
        block.numbers.append(number)
        block.terms.append(terms)
        size += len(terms)
    if block.terms:
        yield block


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def pair_up(terms: list[str], weights: dict[str, int]) -> list[tuple[str, ...]]:
    """The terms that occur, two by two in falling order of weight."""
    known = sorted((t for t in terms if t in weights), key=lambda t: (-weights[t], t))
    return [tuple(sorted(known[i : i + 2])) for i in range(0, len(known), 2)]


# ---- search in a group of shards ---------------------------------------------------


@dataclass
class Postings:
    docs: np.ndarray
    impacts: np.ndarray

    @property
    def most(self) -> int:
        return int(self.impacts.max())


@dataclass
class Pair:
    """The postings of one or two terms with the most that they can give together."""

    lists: list[Postings]
    bound: int
    floor: int  # as many documents as are asked for have this much from the pair


def join_pair(lists: list[Postings], wanted: int) -> Pair:
    """Intersection list of a pair, as far as bounds and thresholds need it."""
    bound = max(p.most for p in lists)
    floor = max(kth_largest(p.impacts, wanted) for p in lists)
    if len(lists) == 2:
        a, b = lists
        _, at_a, at_b = np.intersect1d(a.docs, b.docs, assume_unique=True, return_indices=True)
        joint = a.impacts[at_a] + b.impacts[at_b]
        bound = max(bound, int(joint.max(initial=0)))
        floor = max(floor, kth_largest(joint, wanted))
    return Pair(lists, bound, floor)


def kth_largest(scores: np.ndarray, k: int) -> int:
    """0 if there are fewer than k."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def best_of(pairs: list[Pair], n_docs: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) that can be among the best ``wanted``, ties included."""
    pairs = sorted(pairs, key=lambda p: -p.bound)
    rest = np.cumsum([p.bound for p in pairs][::-1])[::-1].tolist() + [0]
    threshold = max((p.floor for p in pairs), default=0)
    scores = np.zeros(n_docs, np.int64)
    at = 0
    # Documents can enter with any pair while the rest may reach the threshold.
    while at < len(pairs) and rest[at] >= threshold:
        for p in pairs[at].lists:
            scores[p.docs] += p.impacts
        at += 1
        threshold = max(threshold, kth_largest(scores, wanted))
    docs = np.flatnonzero(scores + rest[at] >= max(threshold, 1))
    for pair, after in zip(pairs[at:], rest[at + 1 :]):
        for p in pair.lists:
            place = np.minimum(np.searchsorted(p.docs, docs), len(p.docs) - 1)
            scores[docs] += np.where(p.docs[place] == docs, p.impacts[place], 0)
        threshold = max(threshold, kth_largest(scores[docs], wanted))
        docs = docs[scores[docs] + after >= threshold]
    docs = docs[scores[docs] >= max(kth_largest(scores[docs], wanted), 1)]
    return docs, scores[docs]


FOUND = "number long, part long, doc_id long, score long"
FOUND_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in FOUND.split(", ")])


def _search(block: Block, weights: dict[str, int], n_docs: int, n_terms: int, wanted: int):
    """The function that searches one group of shards for all items of a block."""
    paired = [pair_up(terms, weights) for terms in block.terms]

    def impacts(term: str, counts: np.ndarray, m: np.ndarray) -> np.ndarray:
        return weights[term] * (1_000_000_000 * counts // (1000 * counts + 20 * m))

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("shard").combine_chunks()
        own = rows.filter(pc.is_null(rows.column("term")))
        sizes = pc.list_value_length(own.column("ids")).to_numpy()
        base = dict(zip(own.column("shard").to_pylist(), np.cumsum(sizes) - sizes, strict=True))
        ids = pc.list_flatten(own.column("ids")).combine_chunks()
        lengths = pc.list_flatten(own.column("lengths")).to_numpy().astype(np.int64)
        m = 50 + (50 * lengths * n_docs) // n_terms if n_terms else lengths
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        of_terms = rows.filter(pc.is_valid(rows.column("term")))
        names = ("shard", "term", "docs", "counts")
        for shard, term, docs, counts in zip(*(of_terms.column(c) for c in names), strict=True):
            docs = docs.values.to_numpy().astype(np.int64) + base[shard.as_py()]
            counts = counts.values.to_numpy().astype(np.int64)
            held.setdefault(term.as_py(), []).append((docs, counts))
        postings = {}
        for term, parts in held.items():
            docs, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            postings[term] = Postings(docs, impacts(term, counts, m[docs]))
        pairs: dict[tuple[str, ...], Pair] = {}
        for key in {key for keys in paired for key in keys}:
            lists = [postings[t] for t in key if t in postings]
            if lists:
                pairs[key] = join_pair(lists, wanted)
        known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
        order_ids = pc.fill_null(ids, 0).to_numpy()
        part = rows.column("part")[0].as_py() if rows.num_rows else 0
        out = []
        for number, keys in zip(block.numbers, paired, strict=True):
            docs, scores = best_of([pairs[k] for k in keys if k in pairs], len(ids), wanted)
            first = np.lexsort((order_ids[docs], known[docs], -scores))[:wanted]
            n = len(first)
            columns = [
                pa.array(np.full(n, number)),
                pa.array(np.full(n, part)),
                ids.take(pa.array(docs[first])),
                pa.array(scores[first]),
            ]
            out.append(pa.RecordBatch.from_arrays(columns, schema=FOUND_ARROW))
        return pa.Table.from_batches(out, FOUND_ARROW)

    return run


def _ranked(found: DataFrame, wanted: int, parts: int) -> DataFrame:
    """The best of each item: first among groups that share a remainder, then of all."""
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    some = F.pmod("part", F.lit(math.isqrt(parts) + 1))
    first = F.row_number().over(Window.partitionBy("number", some).orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("number").orderBy(*order))
    return (
        found.withColumn("rank", first)
        .where(F.col("rank") <= wanted)
        .withColumn("rank", rank)
        .where(F.col("rank") <= wanted)
        .select("number", "rank", "doc_id", "score")
    )


def search(index: DataFrame, items: DataFrame, wanted: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of every item, from rank 1."""
    spark = index.sparkSession
    numbered = store(
        items.select(
            "item_id", F.col("text").cast("string"), F.monotonically_increasing_id().alias("number")
        ),
        "items",
    )
    own = index.where(F.col("term").isNull())
    with_terms = F.size(F.filter("lengths", lambda n: n > 0)).cast("long")
    all_terms = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    n_docs, n_terms = own.agg(F.sum(with_terms), F.sum(all_terms)).first()
    n_docs, n_terms = n_docs or 0, n_terms or 0
    parts = n_terms // GROUP_TERMS + 1
    part = F.pmod(F.xxhash64("shard"), F.lit(parts)).alias("part")
    found = []
    for block in read_blocks(numbered):
        words = spark.createDataFrame([(t,) for t in block.vocabulary()], "term string")
        postings = store(index.join(words, "term").select(index.columns), "postings")
        counted = postings.groupBy("term").agg(F.sum(F.size("docs")).alias("df")).collect()
        weights = {t: term_weight(n_docs, df) for t, df in counted}
        run = _search(block, weights, n_docs, n_terms, wanted)
        gathered = postings.unionByName(own).select("*", part)
        hits = gathered.groupBy("part").applyInArrow(run, FOUND)
        found.append(store(_ranked(hits, wanted, parts), "found"))
        discard(postings)
    ranked = spark.createDataFrame([], "number long, rank int, doc_id long, score long")
    for hits in found:
        ranked = ranked.unionByName(hits)
    return ranked.join(numbered.select("number", "item_id"), "number").select(
        "item_id", "rank", "doc_id", "score"
    )
