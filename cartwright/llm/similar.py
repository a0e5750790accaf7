"""Near-duplicate documents by the Jaccard similarity of their shingles, in two passes.

Fingerprints of several tables (``simhash.py``) propose pairs, shingles joined to them
decide. Proposing every pair of a family of copies would be quadratic, so the first pass
tries a few pairs of each: the links among them give parts. What it left out could only
join two parts. The second pass therefore proposes every pair of near fingerprints that
share a variant and lie in different parts, without exception, and lets shingles decide
these as well. The components are those of trying all pairs of near fingerprints that meet.

For the second pass, chunks tell each bucket of hashes which parts meet in a hash; hashes
of one part only are done. Members of the others are sent to the bucket and compared
across parts, a pair at its first common variant only, so it is given once. A hash with
very many members is dealt into blocks, and pairs of blocks meet in tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import discard, store
from .components import connected_components
from .simhash import (
    FIVE_SHINGLES,
    Ball,
    Meetings,
    Scheme,
    _pack,
    _unpack,
    bits_apart,
    chunk_links,
    fingerprint,
    first_shared,
    forests,
    meetings,
    shingle_hashes,
)

BLOCK = 8192
FOREST_PAIRS = 1 << 20


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before in any column."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _across(keys: np.ndarray, parts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs with one key and two parts, as many at a time as there are rows.

    One member after the other is paired with all members of later parts. The largest part
    of a key comes last, so its members only wait.
    """
    order = np.lexsort((parts, keys))
    run = np.cumsum(_runs(keys[order], parts[order])) - 1
    size = np.bincount(run)[run]
    order = order[np.lexsort((parts[order], size, keys[order]))]
    starts = np.flatnonzero(_runs(keys[order]))
    stops = np.append(starts[1:], len(order))
    run_starts = np.flatnonzero(_runs(keys[order], parts[order]))
    run_stops = np.append(run_starts[1:], len(order))
    run = np.cumsum(_runs(keys[order], parts[order])) - 1
    last = run_starts[np.searchsorted(run_starts, stops) - 1]
    member = starts
    while len(member := member[more := member < last]):
        stops, last = stops[more], last[more]
        others = run_stops[run[member]]
        count = stops - others
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        yield order[np.repeat(member, count)], order[np.repeat(others, count) + place]
        member = member + 1


def crossing_pairs(told: Meetings, parts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b, part_a, part_b), each once, of nodes in different parts that share a
    variant and are within the limit.

    ``parts`` (node, component) may leave out nodes that are alone in theirs.
    """
    ball, chunks, met = told
    if ball.scheme.radius != 2:
        raise ValueError("variants of one flipped bit are needed")
    low_bits, limit = np.uint64(ball.low_bits), ball.scheme.limit

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        members, names = (group[c].to_numpy("<i8").tobytes() for c in ("node", "component"))
        row = int(group["chunk"].iloc[0]), members, names
        return pd.DataFrame([row], columns=["chunk", "members", "names"])

    def opened(chunk: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row = chunk.iloc[0]
        ids, prints = np.frombuffer(row["ids"], "<i8"), ball.words_of(row["prints"])
        names = ids.copy()
        if row["members"] is not None:
            order = np.argsort(ids)
            place = np.searchsorted(ids, np.frombuffer(row["members"], "<i8"), sorter=order)
            names[order[place]] = np.frombuffer(row["names"], "<i8")
        return ids, prints, names

    def announce(key: tuple, chunk: pd.DataFrame, met: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "chunk", "keys", "parts", "counts"]
        if not len(chunk) or not len(met):
            return pd.DataFrame([], columns=columns)
        _, prints, names = opened(chunk)
        keys, owners = ball.meeting(prints, met)
        order = np.lexsort((names[owners], keys))
        keys, held = keys[order], names[owners[order]]
        first = np.flatnonzero(_runs(keys, held))
        counts = np.diff(np.append(first, len(keys)))
        keys, held = keys[first], held[first]
        buckets = keys >> low_bits
        cuts = np.append(np.flatnonzero(_runs(buckets)), len(buckets))
        rows = [
            (int(buckets[i]), key[0], keys[i:j].tobytes(), held[i:j].tobytes(), counts[i:j].tobytes())
            for i, j in zip(cuts[:-1], cuts[1:])
        ]
        return pd.DataFrame(rows, columns=columns)

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        keys, held, counts = (
            np.frombuffer(b"".join(group[c]), t) for c, t in (("keys", "<u8"), ("parts", "<i8"), ("counts", "<i8"))
        )
        chunk = np.repeat(group["chunk"].to_numpy(), group["keys"].str.len() // 8)
        order = np.lexsort((held, keys))
        which = np.cumsum(_runs(keys[order])) - 1
        several = np.bincount(which, _runs(keys[order], held[order])) > 1
        blocks = -(-np.bincount(which, counts[order]).astype(np.int64) // block)
        go = several[which]
        order, which = order[go], which[go]
        keys, chunk, blocks = keys[order], chunk[order], blocks[which]
        order = np.lexsort((keys, chunk))
        order = order[_runs(chunk[order], keys[order])]
        cuts = np.append(np.flatnonzero(_runs(chunk[order])), len(order))
        rows = [
            (chunk[order[i]], _pack(keys[order[i:j]]), blocks[order[i:j]].astype("<i8").tobytes())
            for i, j in zip(cuts[:-1], cuts[1:])
        ]
        return pd.DataFrame(rows, columns=["chunk", "hashes", "blocks"])

    def send(key: tuple, chunk: pd.DataFrame, crossed: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "one", "two", "keys", "ids", "parts", "blocks", "prints"]
        if not len(chunk) or not len(crossed):
            return pd.DataFrame([], columns=columns)
        ids, prints, names = opened(chunk)
        keys, owners = ball.meeting(prints, crossed)
        wanted = np.concatenate([_unpack(x) for x in crossed["hashes"]])
        order = np.argsort(wanted)
        blocks = np.frombuffer(b"".join(crossed["blocks"]), "<i8")[order]
        blocks = blocks[np.searchsorted(wanted[order], keys)]
        # A member of a hash in n blocks goes to n pairs of blocks.
        place = np.repeat(np.arange(len(keys)), blocks)
        other = np.arange(len(place)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        keys, owners, blocks = keys[place], owners[place], blocks[place]
        own = key[0] % blocks
        one, two = np.minimum(own, other), np.maximum(own, other)
        alone = -1 - keys.astype(np.int64)
        bucket = np.where(blocks > 1, alone, (keys >> low_bits).astype(np.int64))
        order = np.lexsort((two, one, bucket))
        bucket, one, two = bucket[order], one[order], two[order]
        keys, owners, own = keys[order], owners[order], own[order]
        cuts = np.append(np.flatnonzero(_runs(bucket, one, two)), len(bucket))
        rows = [
            (
                *(int(x[i]) for x in (bucket, one, two)),
                keys[i:j].tobytes(),
                ids[owners[i:j]].tobytes(),
                names[owners[i:j]].tobytes(),
                own[i:j].tobytes(),
                prints[owners[i:j]].tobytes(),
            )
            for i, j in zip(cuts[:-1], cuts[1:])
        ]
        return pd.DataFrame(rows, columns=columns)

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(group["keys"]), "<u8")
        ids, names, own = (np.frombuffer(b"".join(group[c]), "<i8") for c in ("ids", "parts", "blocks"))
        prints = ball.words_of(b"".join(group["prints"]))
        two_blocks = group["one"].iloc[0] != group["two"].iloc[0]
        found = [np.zeros((0, 4), np.int64)]
        for left, right in _across(keys, names):
            if two_blocks:
                apart = own[left] != own[right]
                left, right = left[apart], right[apart]
            for i in range(0, len(left), 1 << 16):
                a, b = left[i : i + (1 << 16)], right[i : i + (1 << 16)]
                near = bits_apart(prints[a], prints[b]) <= limit
                a, b = a[near], b[near]
                first = first_shared(ball, prints[a], prints[b]) == keys[a]
                a, b = a[first], b[first]
                a, b = np.where(ids[a] < ids[b], a, b), np.where(ids[a] < ids[b], b, a)
                found.append(np.column_stack([ids[a], ids[b], names[a], names[b]]))
        return pd.DataFrame(np.concatenate(found), columns=["a", "b", "part_a", "part_b"])

    placed = parts.select(ball.chunk().alias("chunk"), "node", "component")
    placed = placed.groupBy("chunk").applyInPandas(gather, "chunk long, members binary, names binary")
    named = store(chunks.join(placed, "chunk", "left"), "named-chunks")
    by_chunk = named.groupBy("chunk")
    announced = by_chunk.cogroup(met.groupBy("chunk")).applyInPandas(
        announce, "bucket long, chunk long, keys binary, parts binary, counts binary"
    )
    crossed = announced.groupBy("bucket").applyInPandas(meet, "chunk long, hashes binary, blocks binary")
    crossed = store(crossed, "crossed", "none")
    sent = by_chunk.cogroup(crossed.groupBy("chunk")).applyInPandas(
        send,
        "bucket long, one long, two long, keys binary, ids binary, parts binary, blocks binary, prints binary",
    )
    pairs = sent.groupBy("bucket", "one", "two").applyInPandas(
        verify, "a long, b long, part_a long, part_b long"
    )
    pairs = store(pairs, "crossing")
    discard(named)
    discard(crossed)
    return pairs


def _fewer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs (a, b, apart) of some spanning forests of a partition."""
    pairs = pd.concat([pd.DataFrame([], columns=["a", "b", "apart"], dtype="int64"), *batches])
    kept = forests(pairs[["a", "b"]].to_numpy(), pairs["apart"].to_numpy())
    yield pairs.iloc[kept][["a", "b"]]


def similar_documents(
    docs: DataFrame,
    scheme: Scheme = FIVE_SHINGLES,
    least: float = 0.8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id and component_id (smallest id reachable, itself included) of every row.

    Rows link when the Jaccard similarity of their sets of shingles is ``least`` or more
    and their fingerprints meet. Rows with equal sets are one node, and texts without a
    word have equal sets. Ids must be distinct and not null, so a node's name is its
    smallest id. Other columns are not read.
    """

    def sets(texts: pd.Series) -> list[np.ndarray]:
        return [np.unique(shingle_hashes(t, scheme.shingle)) for t in texts]

    def print_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = sets(batch["text"])
            same = [xxhash.xxh3_128_digest(x.tobytes()) for x in found]
            prints = [fingerprint(x, scheme.words) for x in found]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "same": same, "prints": prints})

    def list_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [x.view(np.int64) for x in sets(batch["text"])]
            yield pd.DataFrame({"node": batch["doc_id"], "shingles": found})

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))

    def alike(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs whose shingles are alike, stored."""
        met = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        of_pairs = rows.join(met, "doc_id", "left_semi")
        shingles = store(of_pairs.mapInPandas(list_sets, "node long, shingles array<long>"), "shingles")
        of_a = shingles.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
        of_b = shingles.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
        shared = F.size(F.array_intersect("left", "right"))
        total = F.size("left") + F.size("right") - shared
        linked = pairs.join(of_a, "a").join(of_b, "b")
        linked = linked.where(shared >= F.lit(least) * total - F.lit(1e-9))
        linked = store(linked.select(*pairs.columns), name)
        discard(shingles)
        return linked

    printed = store(rows.mapInPandas(print_sets, "doc_id long, same binary, prints binary"), "prints")
    nodes = store(printed.groupBy("same", "prints").agg(F.min("doc_id").alias("node")), "nodes")
    told = meetings(nodes.select("node", "prints"), scheme)
    proposed = store(chunk_links(told, partners=True).distinct(), "proposed")
    # As many partitions as the pairs ask for, whatever number shuffles have.
    dealt = proposed.repartition(-(-max(1, proposed.count()) // FOREST_PAIRS))
    tried = store(dealt.mapInPandas(_fewer, "a long, b long").distinct(), "tried")
    parts = connected_components(alike(tried, "alike"))

    crossing = crossing_pairs(told, parts)
    rest = alike(crossing.join(tried, ["a", "b"], "left_anti"), "alike-crossing")
    whole = connected_components(rest.select(F.col("part_a").alias("a"), F.col("part_b").alias("b")))
    whole = whole.select(F.col("node").alias("part"), F.col("component").alias("whole"))
    named = nodes.join(parts, "node", "left").select("same", F.coalesce("component", "node").alias("part"))
    named = named.join(whole, "part", "left").select("same", F.coalesce("whole", "part").alias("component_id"))
    named = store(named, "named")
    for done in (nodes, told.chunks, told.met, proposed, tried, parts, crossing):
        discard(done)
    return printed.join(named, "same").select("doc_id", "component_id")
