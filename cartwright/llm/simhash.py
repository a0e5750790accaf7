"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits have a common neighbour within half of it of
both. So each fingerprint emits all its variants within ``radius / 2`` flipped bits,
equal variants meet in a shuffle, and pairs that meet are verified.

Most variants meet nothing, so they travel in two passes. First each chunk of
fingerprints announces a hash of every variant: sorted, as gaps of a few bits, cut into
buckets by the upper bits. A bucket tells each chunk which of its hashes occur more than
once. Then the chunks make their variants again and only those travel with their
fingerprint. No pass holds more than a chunk or a bucket in memory, and both have a
bounded size; false meetings of hashes only cost a verification.

A group that meets in a variant is linked to its smallest member that verifies; members
that do not are tried against the next one. Groups are reduced inside each chunk before
they are shuffled, so a variant shared by very many fingerprints sends one row per
chunk, in the name of the chunk's own component. Equal fingerprints are one node from
the start.

Long fingerprints serve looser similarities: several tables of fewer bits, each with its
own ball. Here a member stays in its group until it was ``sure`` to belong to a leader or
was tried with ``tries`` leaders. ``similar.py`` has what this leaves out.

Defined results: a null text is an empty one; a text with fewer words than a shingle is
one shingle; no word at all gives fingerprint zero, linked like any other. Rows with a
null id keep their component; they do not name it unless it has no other id (then it is
null). Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cartwright.operators.keys import number_in_order

from .common import store
from .components import connected_components

GOLDEN = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of words, A-Z lowered, repeats included."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if len(words) <= size:
        shingles = [b" ".join(words)] if words else []
        return np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[a:b], 42) for a, b in zip(starts, ends[size - 1 :].tolist())]
    return np.array(found, np.uint64)


def fingerprint(hashes: np.ndarray, words: int = 1) -> bytes:
    """64 * ``words`` majority bits, little-endian; the first word uses the hashes as they are."""
    n = len(hashes)
    if not n:
        return bytes(8 * words)
    totals = np.zeros(64 * words, np.int64)
    steps = (np.arange(words, dtype=np.uint64) * np.uint64(GOLDEN))[None, :]
    for i in range(0, n, 255):
        part = hashes[i : i + 255, None]
        if words > 1:
            part = np.where(steps == 0, part, mixed(part + steps))
        bits = np.unpackbits(np.ascontiguousarray(part).view(np.uint8), axis=1, bitorder="little")
        totals += bits.sum(0, dtype=np.uint8)
    return np.packbits(2 * totals > n, bitorder="little").tobytes()


@dataclass(frozen=True)
class Scheme:
    """``tables`` fingerprints of ``bits`` bits within ``radius``; all bits within ``limit``.

    Pairs within ``sure`` bits need no other partner in their group, others up to ``tries``.
    Pairs beyond ``likely`` bits are left to the second pass of ``similar.py``.
    """

    shingle: int
    tables: int = 1
    bits: int = 64
    radius: int = 4
    limit: int = 4
    sure: int | None = None
    likely: int | None = None
    tries: int = 1

    @property
    def words(self) -> int:
        return self.tables * self.bits // 64

    def table_prints(self, prints: np.ndarray) -> np.ndarray:
        """(fingerprint, table) from rows of 64-bit words."""
        if self.bits == 64:
            return prints
        return prints.view(f"<u{self.bits // 8}").astype(np.uint64)


@lru_cache
def _masks(scheme: Scheme) -> np.ndarray:
    """Flips of at most half the radius, for each table."""
    flips = [
        sum(1 << b for b in c)
        for n in range(scheme.radius // 2 + 1)
        for c in combinations(range(scheme.bits), n)
    ]
    return np.array(flips, np.uint64)


# Word five-shingles of similarity 0.8: the angle between the shingle vectors is
# acos(2J / (1 + J)), so 15 % of the bits differ, 155 of 1,024 with a deviation of 11.5.
# The limit is 2.5 deviations wider, sure is 4 narrower (J of about 0.9). 32 tables of
# 32 bits within 2 bits find a pair at 0.8 with probability 0.98, closer ones more surely.
FIVE_SHINGLES = Scheme(shingle=5, tables=32, bits=32, radius=2, limit=184, sure=109, likely=155, tries=4)
FOUR_SHINGLES = Scheme(shingle=4)

CHUNK_VARIANTS = 1 << 22
BUCKET_VARIANTS = 1 << 20


def _pack(sorted_values: np.ndarray) -> bytes:
    """Sorted 64-bit values as gaps, in planes of bytes."""
    import zstandard

    gaps = np.diff(sorted_values, prepend=np.uint64(0))
    planes = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)
    width = max(1, int(np.max(np.flatnonzero(planes.any(0)), initial=0)) + 1)
    data = np.ascontiguousarray(planes[:, :width].T).tobytes()
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes) -> np.ndarray:
    import zstandard

    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    planes = planes.reshape(width, -1)
    gaps = np.zeros((planes.shape[1], 8), np.uint8)
    gaps[:, :width] = planes.T
    return np.cumsum(gaps.reshape(-1).view("<u8"), dtype=np.uint64)


def bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(1, dtype=np.int64)


def _linked(keys: np.ndarray, nodes: np.ndarray, prints: np.ndarray, scheme: Scheme):
    """Links inside groups of equal keys, and the members that others were tried against,
    both by position.

    Each group is compared with its smallest node; what does not verify (or is not sure,
    and has tries left) is compared with the next, until none is left.
    """
    order = np.lexsort((nodes, keys))
    sure = scheme.limit if scheme.sure is None else scheme.sure
    pairs, leaders, tried = [], [], np.zeros(len(keys), np.int64)
    while len(order):
        first = np.append(True, keys[order][1:] != keys[order][:-1])
        leader = order[first][np.cumsum(first) - 1]
        apart = bits_apart(prints[order], prints[leader])
        near = apart <= scheme.limit
        linked = near & (order != leader)
        pairs.append(np.stack([leader[linked], order[linked]], 1))
        leaders.append(order[first])
        tried[order[near]] += 1
        done = (apart <= sure) | (near & (tried[order] >= scheme.tries))
        order = order[~done & ~first]
    none = np.zeros(0, np.int64)
    found = np.concatenate(pairs) if pairs else none.reshape(0, 2)
    return found, np.concatenate(leaders) if leaders else none


def _spanning(pairs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs that connect what all of them connect, without circles; and the
    roots of ``n``."""
    root, kept = list(range(n)), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, (a, b) in enumerate(pairs.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append(i)
    return np.array(kept, np.int64), np.array([find(x) for x in range(n)], np.int64)


# Of the first pass only; similar.py tries what these leave out.
FORESTS = 3


def forests(ids: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Places of the pairs in ``FORESTS`` spanning forests, each of the pairs left by those
    before, the closest first. Between any two sides that few pairs connect all are kept."""
    nodes, pairs = np.unique(ids, return_inverse=True)
    pairs, rest, out = pairs.reshape(-1, 2), np.argsort(apart, kind="stable"), []
    for _ in range(FORESTS):
        kept, _ = _spanning(pairs[rest], len(nodes))
        out.append(rest[kept])
        rest = np.delete(rest, kept)
    return np.concatenate(out)


def _roots(pairs: np.ndarray, n: int) -> np.ndarray:
    """The smallest position that links lead to from each of ``n``."""
    root = np.arange(n)
    a, b = pairs.T
    while True:
        new = root.copy()
        np.minimum.at(new, root[a], root[b])
        np.minimum.at(new, root[b], root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new


@dataclass(frozen=True)
class Ball:
    """How variants are dealt: nodes into chunks, hashes of ``hash_bits`` bits into buckets."""

    scheme: Scheme
    n_chunks: int
    hash_bits: int
    bucket_bits: int

    @classmethod
    def of(cls, count: int, scheme: Scheme) -> Ball:
        """For so many nodes, whatever partitions they come in."""
        each = scheme.tables * len(_masks(scheme))
        total = max(1, count) * each
        return cls(
            scheme,
            n_chunks=-(-max(1, count) // max(1, CHUNK_VARIANTS // each)),
            hash_bits=min(63, math.ceil(math.log2(total)) + 12),
            bucket_bits=max(8, math.ceil(math.log2(total / BUCKET_VARIANTS))),
        )

    @property
    def low_bits(self) -> int:
        return self.hash_bits - self.bucket_bits

    def chunk(self) -> Column:
        return F.pmod(F.xxhash64("node"), F.lit(self.n_chunks))

    def shortened(self, variants: np.ndarray) -> np.ndarray:
        """Hashes of variants, one column (and whatever else) per table."""
        if self.scheme.tables > 1:
            steps = np.arange(1, self.scheme.tables + 1, dtype=np.uint64) * np.uint64(GOLDEN)
            variants = variants ^ mixed(steps).reshape(1, -1, *[1] * (variants.ndim - 2))
        return mixed(variants) >> np.uint64(64 - self.hash_bits)

    def hashes(self, prints: np.ndarray) -> np.ndarray:
        """Hashes of all variants, a row per fingerprint."""
        tables = self.scheme.table_prints(prints)
        return self.shortened(tables[:, :, None] ^ _masks(self.scheme)).reshape(len(tables), -1)

    def words_of(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, "<u8").reshape(-1, self.scheme.words)

    def meeting(self, prints: np.ndarray, met: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """(hash, place of its fingerprint) for the hashes named in ``met``."""
        wanted = np.sort(np.concatenate([_unpack(x) for x in met["hashes"]]))
        low = np.uint64((1 << 24) - 1)
        maybe = np.zeros(1 << 24, bool)
        maybe[wanted & low] = True
        keys, owners = [], []
        for i in range(0, len(prints), 256):
            values = self.hashes(prints[i : i + 256])
            at = np.flatnonzero(maybe[values & low])
            value = values.reshape(-1)[at]
            place = np.minimum(np.searchsorted(wanted, value), len(wanted) - 1)
            hit = wanted[place] == value
            keys.append(value[hit])
            owners.append(i + at[hit] // values.shape[1])
        return np.concatenate(keys), np.concatenate(owners)


def first_shared(ball: Ball, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of one common variant of each pair, the same in whatever bucket it is asked
    for; where no table has one, the largest number."""
    a, b = ball.scheme.table_prints(left), ball.scheme.table_prints(right)
    differ = a ^ b
    one = differ & (~differ + np.uint64(1))
    # Apart in two bits, a variant has either flipped; in one bit, both texts are variants.
    variants = np.minimum(a ^ one, a ^ (differ ^ one))
    near = np.bitwise_count(differ) <= ball.scheme.radius
    table = near.argmax(1)[:, None]
    found = np.take_along_axis(ball.shortened(variants), table, 1)[:, 0]
    return np.where(near.any(1), found, np.uint64(2**64 - 1))


class Meetings(NamedTuple):
    """Stored tables: chunks (chunk, ids, prints), and of each the hashes others share."""

    ball: Ball
    chunks: DataFrame
    met: DataFrame


def meetings(nodes: DataFrame, scheme: Scheme) -> Meetings:
    """Deal nodes (node long, prints binary) into chunks that tell each other their variants."""
    ball = Ball.of(nodes.count(), scheme)
    low_bits, bucket_bits = ball.low_bits, ball.bucket_bits

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["node"].to_numpy("<i8").tobytes()
        row = int(group["chunk"].iloc[0]), ids, b"".join(group["prints"])
        return pd.DataFrame([row], columns=["chunk", "ids", "prints"])

    def announce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, prints in zip(batch["chunk"], batch["prints"]):
                values = np.sort(ball.hashes(ball.words_of(prints)), axis=None)
                buckets = np.arange((1 << bucket_bits) + 1, dtype=np.uint64) << np.uint64(low_bits)
                cuts = np.searchsorted(values, buckets)
                values &= np.uint64((1 << low_bits) - 1)
                full = np.flatnonzero(np.diff(cuts))
                for i in range(0, len(full), 256):
                    part = full[i : i + 256]
                    packed = [_pack(values[cuts[j] : cuts[j + 1]]) for j in part]
                    yield pd.DataFrame({"bucket": part, "chunk": chunk, "hashes": packed})

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        found = [_unpack(x) for x in group["hashes"]]
        which = np.repeat(np.arange(len(found), dtype=np.uint64), [len(x) for x in found])
        order = np.argsort(values := np.concatenate(found), kind="stable")
        values, which = values[order], which[order]
        same = values[1:] == values[:-1]
        again = np.append(same, False) | np.append(False, same)
        values, which = values[again], which[again]
        values += np.uint64(int(group["bucket"].iloc[0]) << low_bits)
        rows = [(group["chunk"].iloc[i], _pack(np.unique(values[which == i]))) for i in np.unique(which)]
        return pd.DataFrame(rows, columns=["chunk", "hashes"])

    dealt = nodes.select("node", "prints", ball.chunk().alias("chunk"))
    chunks = store(
        dealt.groupBy("chunk").applyInPandas(gather, "chunk long, ids binary, prints binary"),
        "chunks",
    )
    chunks_dealt = chunks.repartitionByRange(min(4096, ball.n_chunks), "chunk")
    announced = chunks_dealt.mapInPandas(announce, "bucket long, chunk long, hashes binary")
    met = announced.groupBy("bucket").applyInPandas(meet, "chunk long, hashes binary")
    return Meetings(ball, chunks, store(met, "met", "none"))


def ball_links(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """Links (a, b) between nodes (node long, prints binary).

    They stand for the components of near prints.
    """
    return chunk_links(meetings(nodes, scheme)).select("a", "b")


def chunk_links(told: Meetings, partners: bool = False) -> DataFrame:
    """Links (a, b, apart) by chunks, then by buckets of hashes that chunks share.

    With ``partners`` every link is a pair that was itself compared, ``apart`` bits from each
    other. Of a chunk's sure pairs a spanning part is given, of its others, between parts
    that sure pairs do not connect, some spanning forests. A bucket gives only pairs that it
    compared at their first common variant (the radius must be 2), so no two give the same.
    """
    ball, chunks, met = told
    scheme, low_bits, bucket_bits = ball.scheme, ball.low_bits, ball.bucket_bits
    likely = scheme.limit if scheme.likely is None else scheme.likely

    def emit(key: tuple, chunk: pd.DataFrame, met: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "keys", "roots", "prints", "links"]
        if not len(chunk) or not len(met):
            return pd.DataFrame([], columns=columns)
        ids, prints = np.frombuffer(chunk["ids"].iloc[0], "<i8"), ball.words_of(chunk["prints"].iloc[0])
        keys, owners = ball.meeting(prints, met)
        pairs, leaders = _linked(keys, ids[owners], prints[owners], scheme)
        if partners:
            pairs = np.unique(np.sort(owners[pairs], axis=1), axis=0)
            apart = bits_apart(prints[pairs[:, 0]], prints[pairs[:, 1]])
            is_sure = apart <= scheme.sure
            tree, part = _spanning(pairs[is_sure], len(ids))
            tree = pairs[is_sure][tree]
            other = ~is_sure & (apart <= likely) & (part[pairs[:, 0]] != part[pairs[:, 1]])
            pairs, apart = pairs[other], apart[other]
            few = forests(pairs, apart)
            pairs = np.concatenate([tree, pairs[few]])
            apart = np.append(bits_apart(prints[tree[:, 0]], prints[tree[:, 1]]), apart[few])
            links = np.column_stack([ids[pairs], apart])
            root = np.arange(len(ids))
        else:
            root = _roots(owners[pairs], len(ids))
            inner = np.flatnonzero(root != np.arange(len(ids)))
            links = np.stack([ids[root[inner]], ids[inner], np.zeros(len(inner), np.int64)], 1)
        keys, owners = keys[leaders], owners[leaders]
        buckets = keys >> np.uint64(low_bits)
        order = np.argsort(buckets, kind="stable")
        keys, owners, buckets = keys[order], owners[order], buckets[order]
        cuts = np.append(np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])), len(buckets))
        rows = [
            (int(buckets[a]), keys[a:b].tobytes(), ids[root[owners[a:b]]].tobytes(), prints[owners[a:b]].tobytes(), b"")
            for a, b in zip(cuts[:-1], cuts[1:])
        ]
        # Links inside a chunk need no further meeting; they ride along.
        rows.append((-1 - key[0] % (1 << bucket_bits), b"", b"", b"", links.astype("<i8").tobytes()))
        return pd.DataFrame(rows, columns=columns)

    def once(keys: np.ndarray, prints: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The likely pairs that were compared at their first common variant, and their distance:
        whatever number of variants two copies share, their pair is given for one of them."""
        kept, apart = [found[:0]], [found[:0, 0]]
        for i in range(0, len(found), 1 << 16):
            part = found[i : i + (1 << 16)]
            bits = bits_apart(prints[part[:, 0]], prints[part[:, 1]])
            part, bits = part[bits <= likely], bits[bits <= likely]
            first = first_shared(ball, prints[part[:, 0]], prints[part[:, 1]]) == keys[part[:, 0]]
            kept.append(part[first])
            apart.append(bits[first])
        return np.concatenate(kept), np.concatenate(apart)

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(group["keys"]), "<u8")
        roots = np.frombuffer(b"".join(group["roots"]), "<i8")
        pairs = np.frombuffer(b"".join(group["links"]), "<i8").reshape(-1, 3)
        if len(keys):
            prints = ball.words_of(b"".join(group["prints"]))
            found, _ = _linked(keys, roots, prints, scheme)
            apart = 0 * found[:, 0]
            if partners:
                found, apart = once(keys, prints, found)
            met = np.column_stack([np.sort(roots[found], axis=1), apart])
            pairs = np.concatenate([pairs, np.unique(met[met[:, 0] != met[:, 1]], axis=0)])
        return pd.DataFrame(pairs, columns=["a", "b", "apart"])

    kept = (
        chunks.groupBy("chunk")
        .cogroup(met.groupBy("chunk"))
        .applyInPandas(emit, "bucket long, keys binary, roots binary, prints binary, links binary")
    )
    return kept.groupBy("bucket").applyInPandas(verify, "a long, b long, apart long")


def near_duplicates(
    docs: DataFrame, scheme: Scheme, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, prints and component_id (smallest id reachable, itself included) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(t, scheme.shingle), scheme.words) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "prints": prints})

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    printed = store(rows.mapInPandas(run, "doc_id long, prints binary"), "prints")
    # One node per distinct fingerprint.
    distinct = printed.groupBy("prints").agg(F.min("doc_id").alias("first"))
    nodes = number_in_order(distinct, "prints", name="node")
    parts = connected_components(ball_links(nodes, scheme))
    labelled = store(
        nodes.join(parts, "node", "left").select(
            "prints", "first", F.coalesce("component", "node").alias("component")
        ),
        "labelled",
    )
    smallest = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    named = store(labelled.join(smallest, "component").select("prints", "component_id"), "named")
    return printed.join(named, "prints").select("doc_id", "prints", "component_id")
