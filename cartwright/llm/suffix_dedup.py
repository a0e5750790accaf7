"""Removal of repeated 100-byte strings by a distributed merge of sorted suffix runs.

A byte goes if a string of ``length`` bytes that also starts earlier (in a document with
a smaller id, or earlier in the same one) covers it. Strings never cross documents.

Each string of ``length`` bytes is anchored at the suffix that starts with its smallest
``seed`` bytes by hash. Equal strings have equal anchors, so it suffices to sort suffixes
at anchors, about one of 27, each with the bytes before it that its strings reach. Work
goes by runs, which are documents of some megabytes in order:

1. A run finds its anchors. Surroundings that occur again in it, byte by byte, are
   repeats already; of the others it announces a hash of the seed (sorted, as gaps).
2. Seeds announced once in all are dropped. The suffixes of the others are sorted in
   each run, cut by a hash of the seed, front-coded (shared prefix with the suffix before,
   and the rest), and exchanged.
3. A loser tree merges the runs. It keeps for every suffix how much it has in common with
   the last one put out, decides by these numbers where they differ, and looks at bytes
   only from there on, so no known prefix is compared again. The common prefixes it puts
   out bound the groups of equal seeds; in these every string but the first is a repeat.
4. Each run covers its repeated strings and drops the bytes.

A seed of very many different surroundings would make one large group. Beyond ``hot`` of
them, its strings are told apart by their XXH3 128-bit hashes, each of which goes its own
way in the shuffle: among 10^13 strings two different ones agree with odds of 10^-13.

Defined results: a null text is an empty one; texts shorter than ``length`` stay whole.
Null ids come first in order; rows that repeat an id are ordered by where they are
stored. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import store
from .simhash import _pack, _unpack

U = np.uint64
FIRST = -(1 << 63)  # order of a null id


@dataclass(frozen=True)
class Setup:
    length: int = 100
    seed: int = 48
    run_bytes: int = 8_000_000
    hot: int = 4000


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * U(0x9E3779B97F4A7C15) + b * U(0xC2B2AE3D27D4EB4F)
    x ^= x >> U(29)
    return x


def _hashes(data: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of all substrings of the given sizes, from halves."""
    letters = np.random.default_rng(9).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
    powers = {1: letters[data]}
    while 2 * max(powers) <= max(sizes):
        n = max(powers)
        powers[2 * n] = _pair(powers[n][:-n], powers[n][n:])
    out = []
    for size in sizes:
        done, value = 0, None
        for n in sorted(powers, reverse=True):
            while size - done >= n:
                part = powers[n][done : done + len(data) - size + 1]
                value = part if value is None else _pair(value, part)
                done += n
        out.append(value)
    return out


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    n = 1
    out = values
    while 2 * n <= width:
        out = np.minimum(out[:-n], out[n:])
        n *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - n :][: len(values) - width + 1])


@dataclass
class Anchors:
    """Per anchor its place, the first and last string anchored there, and hashes of the
    seed and of all its surroundings."""

    place: np.ndarray
    low: np.ndarray
    high: np.ndarray
    seed: np.ndarray
    around: np.ndarray


BLOCK = 1 << 17


def find_anchors(data: np.ndarray, sizes: np.ndarray, setup: Setup) -> Anchors:
    """Anchors of all strings inside documents of ``sizes`` bytes, block by block."""
    size, seed = setup.length, setup.seed
    ends = np.cumsum(sizes)
    mask = U((1 << 18) - 1)
    parts = []
    for i in range(0, len(data) - size + 1, BLOCK):
        n = min(BLOCK, len(data) - size + 1 - i)
        h_seed, h_all = _hashes(data[i : i + n + size - 1], (seed, size))
        ranked = (h_seed & ~mask) | np.arange(len(h_seed), dtype=U)
        at = (_smallest(ranked, size - seed + 1) & mask).astype(np.int64)
        low, high = np.searchsorted(ends, (i, i + n), "right")
        near = ends[low : high + 1] - i  # ends of the documents that the block touches
        doc = np.searchsorted(near, np.arange(n), "right")
        valid = np.flatnonzero(near[doc] - np.arange(n) >= size)
        if not len(valid):
            continue
        place, doc = at[valid], doc[valid]
        first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])))
        last = np.append(first[1:], len(valid)) - 1
        lows, highs, place = valid[first], valid[last], place[first]
        parts.append((i + place, i + lows, i + highs, h_seed[place], h_all[lows], h_all[highs]))
    if not parts:
        none = np.zeros(0, np.int64)
        return Anchors(none, none, none, none.astype(U), none.astype(U))
    place, low, high, seeds, start, end = (np.concatenate(x) for x in zip(*parts))
    # An anchor may have strings on both sides of a block's edge.
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    last = np.append(first[1:], len(place)) - 1
    place, low, high, seeds = place[first], low[first], high[last], seeds[first]
    around = _pair(start[first], end[last])
    around += (high - low).astype(U) * U(131) + (place - low).astype(U)
    return Anchors(place, low, high, seeds, _pair(seeds, around))


def _fresh(found: Anchors, data: bytes, length: int) -> np.ndarray:
    """Whether an anchor's surroundings do not occur earlier in the run.

    Hashes find the earlier place, bytes decide."""
    _, first, back = np.unique(found.around, return_index=True, return_inverse=True)
    earlier = first[back]
    fresh = earlier == np.arange(len(earlier))
    again = np.flatnonzero(~fresh)
    low, end = found.low, found.high + length
    places = (low[again], end[again], low[earlier[again]], end[earlier[again]])
    for i, a, b, c, d in zip(again.tolist(), *(x.tolist() for x in places)):
        fresh[i] = data[a:b] != data[c:d]
    return fresh


def _first_rows(values: np.ndarray) -> np.ndarray:
    """Whether each row of two words is the first of its kind."""
    out = np.zeros(len(values), bool)
    order = np.lexsort((values[:, 1], values[:, 0]))
    new = (values[order][1:] != values[order][:-1]).any(1)
    out[order[np.append(True, new)]] = True
    return out


def _bundle(*parts: np.ndarray | bytes) -> bytes:
    data = [p if isinstance(p, bytes) else np.ascontiguousarray(p).tobytes() for p in parts]
    head = np.array([len(x) for x in data], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(bytes([len(data)]) + head + b"".join(data))


def _unbundle(blob: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = data[0]
    cuts = np.cumsum([1 + 8 * n, *np.frombuffer(data[1 : 1 + 8 * n], "<i8")])
    return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def front_code(items: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Of sorted strings: prefix shared with the one before, length of the rest, the rests."""
    longest = max(map(len, items))
    grid = np.frombuffer(b"".join(x.ljust(longest, b"\0") for x in items), np.uint8)
    grid = grid.reshape(len(items), longest)
    lengths = np.array([len(x) for x in items])
    differ = grid[1:] != grid[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), longest)
    shared = np.append(0, np.minimum(shared, np.minimum(lengths[1:], lengths[:-1])))
    rest = b"".join([x[n:] for x, n in zip(items, shared.tolist())])
    return shared.astype("<u2"), (lengths - shared).astype("<u2"), rest


def decode_front(shared: bytes, rests: bytes, rest: bytes) -> Iterator[tuple[bytes, int]]:
    """The strings and what each shares with the one before."""
    value, at = b"", 0
    for n, more in zip(np.frombuffer(shared, "<u2").tolist(), np.frombuffer(rests, "<u2").tolist()):
        value = value[:n] + rest[at : at + more]
        at += more
        yield value, n


class LoserTree:
    """Merges sorted streams of (string, prefix shared with the stream's string before)."""

    def __init__(self, streams: list[Iterator[tuple[bytes, int]]]) -> None:
        self.streams = streams
        self.size = 1 << max(0, (len(streams) - 1).bit_length())
        self.value: list[bytes | None] = [None] * self.size
        self.shared = [0] * self.size  # with the last string put out
        self.loser = [-1] * self.size
        for s in range(len(streams)):
            self._advance(s)
        self.winner = self._build(1)

    def _advance(self, s: int) -> None:
        got = next(self.streams[s], None)
        self.value[s], self.shared[s] = got if got is not None else (None, 0)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        winner, self.loser[node] = self._play(a, b)
        return winner

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(smaller, larger) of two streams' strings.

        Both are at or after the last output. The one that shares more with it comes
        first; only if they share equally much are bytes compared, from there on, and
        the loser then remembers what it shares with the winner.
        """
        x, y = self.value[a], self.value[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        n, m = self.shared[a], self.shared[b]
        if n > m:
            return a, b
        if n < m:
            return b, a
        p, q = x[n:], y[n:]
        if p == q:
            self.shared[b] = len(y)
            return a, b
        width = max(len(p), len(q))
        differ = int.from_bytes(p.ljust(width, b"\0"), "big") ^ int.from_bytes(q.ljust(width, b"\0"), "big")
        common = width - (differ.bit_length() + 7) // 8 if differ else min(len(p), len(q))
        common = n + min(common, len(p), len(q))
        if p < q:
            self.shared[b] = common
            return a, b
        self.shared[a] = common
        return b, a

    def __iter__(self) -> Iterator[tuple[int, bytes, int]]:
        """(stream, string, prefix shared with the string put out before)."""
        while (value := self.value[self.winner]) is not None:
            s = self.winner
            yield s, value, self.shared[s]
            self._advance(s)
            node, best = (s + self.size) // 2, s
            while node:
                best, self.loser[node] = self._play(best, self.loser[node])
                node //= 2
            self.winner = best


Key = tuple[int, int, int]  # order of a string: document id, run, place in the run


def _repeats(group: list[tuple], length: int) -> Iterator[tuple[int, int, int]]:
    """(run, place, strings) that are repeats, from the anchors of one seed.

    A member is (bytes, left, strings, document id, run, place of the first string).
    """
    head = group[0][:3]
    if all(x[:3] == head for x in group):
        first = min(group, key=lambda x: x[3:])
        for x in group:
            if x is not first:
                yield x[4], x[5], x[2]
        return
    earliest: dict[bytes, Key] = {}
    members = []
    for coded, left, strings, doc_id, run, place in group:
        right = len(coded) - left
        text = coded[right:][::-1] + coded[:right]
        found = [text[j : j + length] for j in range(strings)]
        members.append((found, doc_id, run, place))
        for j, value in enumerate(found):
            key = (doc_id, run, place + j)
            if (known := earliest.get(value)) is None or key < known:
                earliest[value] = key
    for found, doc_id, run, place in members:
        start = None
        for j, value in enumerate(found):
            repeat = earliest[value] != (doc_id, run, place + j)
            if repeat and start is None:
                start = j
            elif not repeat and start is not None:
                yield run, place + start, j - start
                start = None
        if start is not None:
            yield run, place + start, len(found) - start


def _merged(rows: list[tuple[int, list[bytes]]], setup: Setup) -> Iterator[tuple[int, int, int]]:
    """Repeats among the front-coded runs of one bucket."""
    tree = LoserTree([decode_front(*parts[:3]) for _, parts in rows])
    meta = [
        zip(*(np.frombuffer(p, k).tolist() for p, k in zip(parts[3:], ("<u1", "<u1", "<i8", "<i8"))))
        for _, parts in rows
    ]
    group: list[tuple] = []
    for s, value, shared in tree:
        if shared < setup.seed and group:
            if len(group) > 1:
                yield from _repeats(group, setup.length)
            group = []
        left, strings, doc_id, place = next(meta[s])
        group.append((value, left, strings, doc_id, rows[s][0], place))
    if len(group) > 1:
        yield from _repeats(group, setup.length)


def _met_by_hash(rows: list[tuple[int, list[bytes]]]) -> Iterator[tuple[int, int, int]]:
    """Repeats among strings given by their hashes."""
    value = np.concatenate([np.frombuffer(p[0], "<u8").reshape(-1, 2) for _, p in rows])
    doc_id = np.concatenate([np.frombuffer(p[1], "<i8") for _, p in rows])
    place = np.concatenate([np.frombuffer(p[2], "<i8") for _, p in rows])
    run = np.repeat(np.array([r for r, _ in rows]), [len(p[0]) // 16 for _, p in rows])
    order = np.lexsort((place, run, doc_id, value[:, 1], value[:, 0]))
    again = order[1:][(value[order][1:] == value[order][:-1]).all(1)]
    yield from zip(run[again].tolist(), place[again].tolist(), [1] * len(again))


def remove_repeats(
    docs: DataFrame,
    setup: Setup = Setup(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, removed (array of start, end in bytes) and kept (binary) of every row."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.encode(F.coalesce(F.col(text_column), F.lit("")), "utf-8").alias("text"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    anchors = max(2, total // 25)
    hash_bits = min(63, math.ceil(math.log2(anchors)) + 12)
    bucket_bits = max(8, math.ceil(math.log2(anchors / 100_000)))
    low_bits = hash_bits - bucket_bits
    edges = np.arange((1 << bucket_bits) + 1, dtype=U) << U(low_bits)

    def short(seed: np.ndarray) -> np.ndarray:
        return (seed * U(0xD6E8FEB86659FD93)) >> U(64 - hash_bits)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, k, held, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].astype("Int64").tolist(), batch["text"]):
                held.append((FIRST if doc_id is pd.NA else doc_id, doc_id is pd.NA, bytes(text)))
                size += len(text)
                if size >= setup.run_bytes:
                    yield ready(run + k, held)
                    held, size, k = [], 0, k + 1
        if held:
            yield ready(run + k, held)

    def ready(run: int, held: list[tuple]) -> pd.DataFrame:
        held.sort(key=lambda x: x[0])
        data = b"".join(x[2] for x in held)
        sizes = np.array([len(x[2]) for x in held], np.int64)
        found = find_anchors(np.frombuffer(data, np.uint8), sizes, setup)
        first = _fresh(found, data, setup.length)
        again = np.flatnonzero(~first)
        values = np.sort(short(found.seed[first]))
        cuts = np.searchsorted(values, edges)
        values &= U((1 << low_bits) - 1)
        packed = [_pack(values[a:b]) if b > a else None for a, b in zip(cuts[:-1], cuts[1:])]
        row = {
            "run": run,
            "doc_ids": [x[0] for x in held],
            "nulls": [x[1] for x in held],
            "sizes": sizes,
            "text": zstandard.ZstdCompressor(level=3).compress(data),
            "spans": _bundle(found.low[again], (found.high - found.low + 1)[again]),
            "seeds": packed,
        }
        return pd.DataFrame({k: [v] for k, v in row.items()})

    runs = store(
        rows.mapInPandas(
            gather,
            "run long, doc_ids array<long>, nulls array<boolean>, sizes array<long>, "
            "text binary, spans binary, seeds array<binary>",
        ),
        "suffix-runs",
        "none",
    )

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        """Seeds announced more than once, told to each run; very frequent ones apart."""
        found = [_unpack(x) for x in group["seeds"]]
        which = np.repeat(np.arange(len(found)), [len(x) for x in found])
        value, back, counts = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        value += U(int(group["bucket"].iloc[0]) << low_bits)
        out = []
        for i in range(len(found)):
            mine = np.unique(back[which == i])
            n = counts[mine]
            several, hot = mine[(n > 1) & (n <= setup.hot)], mine[n > setup.hot]
            if len(several) or len(hot):
                out.append((group["run"].iloc[i], _bundle(value[several], value[hot])))
        return pd.DataFrame(out, columns=["run", "seeds"])

    def exchange(key: tuple, run: pd.DataFrame, met: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "run", "kind", "blob"]
        if not len(run) or not len(met):
            return pd.DataFrame([], columns=columns)
        r = run.iloc[0]
        data = zstandard.ZstdDecompressor().decompress(r["text"])
        sizes = np.array(r["sizes"], np.int64)
        found = find_anchors(np.frombuffer(data, np.uint8), sizes, setup)
        seeds = short(found.seed)
        told = [_unbundle(x) for x in met["seeds"]]
        several, hot = (np.sort(np.frombuffer(b"".join(t[i] for t in told), "<u8")) for i in (0, 1))
        first = _fresh(found, data, setup.length)
        doc_of = np.searchsorted(np.cumsum(sizes), found.low, "right")
        doc_ids = np.array(r["doc_ids"], np.int64)
        out = []

        def among(values: np.ndarray) -> np.ndarray:
            if not len(values):
                return np.zeros(0, np.int64)
            near = np.minimum(np.searchsorted(values, seeds), len(values) - 1)
            return np.flatnonzero(first & (values[near] == seeds))

        picked = among(several)
        buckets = (seeds[picked] >> U(low_bits)).astype(np.int64)
        coded = []
        for at, low, high in zip(
            found.place[picked].tolist(), found.low[picked].tolist(), found.high[picked].tolist()
        ):
            coded.append(data[at : high + setup.length] + data[low:at][::-1])
        order = sorted(range(len(picked)), key=coded.__getitem__)
        order = np.array(order, np.int64)[np.argsort(buckets[order], kind="stable")] if len(picked) else order
        cuts = np.append(np.flatnonzero(np.diff(buckets[order], prepend=-1)), len(order)) if len(picked) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = order[a:b]
            which = picked[part]
            left, n = found.place[which] - found.low[which], found.high[which] - found.low[which] + 1
            blob = _bundle(
                *front_code([coded[i] for i in part]),
                left.astype("<u1"), n.astype("<u1"), doc_ids[doc_of[which]], found.low[which],
            )
            out.append((int(buckets[part[0]]), key[0], 0, blob))

        picked = among(hot)
        if len(picked):
            n = found.high[picked] - found.low[picked] + 1
            starts = np.repeat(found.low[picked], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            docs_of = np.repeat(doc_ids[doc_of[picked]], n)
            order = np.lexsort((starts, docs_of))
            starts, docs_of = starts[order], docs_of[order]
            digest, length = xxhash.xxh3_128_digest, setup.length
            values = b"".join([digest(data[a : a + length]) for a in starts.tolist()])
            values = np.frombuffer(values, "<u8").reshape(-1, 2)
            fresh = _first_rows(values)
            again = starts[~fresh]
            out.append((key[0] % (1 << bucket_bits), key[0], 2, _bundle(again, np.ones(len(again), np.int64))))
            values, docs_of, starts = values[fresh], docs_of[fresh], starts[fresh]
            buckets = (values[:, 0] >> U(64 - bucket_bits)).astype(np.int64)
            order = np.argsort(buckets, kind="stable")
            cuts = np.append(np.flatnonzero(np.diff(buckets[order], prepend=-1)), len(order))
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = order[a:b]
                blob = _bundle(values[part], docs_of[part], starts[part])
                out.append((int(buckets[part[0]]), key[0], 1, blob))
        return pd.DataFrame(out, columns=columns)

    def decide(group: pd.DataFrame) -> pd.DataFrame:
        rows = list(zip(group["run"].tolist(), group["kind"].tolist(), map(_unbundle, group["blob"])))
        found: dict[int, list[tuple[int, int]]] = {}
        sources = []
        if coded := [(r, p) for r, kind, p in rows if kind == 0]:
            sources.append(_merged(coded, setup))
        if hashed := [(r, p) for r, kind, p in rows if kind == 1]:
            sources.append(_met_by_hash(hashed))
        for source in sources:
            for run, place, n in source:
                found.setdefault(run, []).append((place, n))
        out = [(r, _bundle(p[0], p[1])) for r, kind, p in rows if kind == 2]
        for run, spans in found.items():
            place, n = np.array(spans, np.int64).T
            out.append((run, _bundle(place, n)))
        return pd.DataFrame(out, columns=["run", "spans"])

    def cut(key: tuple, run: pd.DataFrame, more: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "n_bytes", "removed", "kept"]
        if not len(run):
            return pd.DataFrame([], columns=columns)
        r = run.iloc[0]
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["text"]), np.uint8)
        edge = np.zeros(len(data) + 1, np.int32)
        for spans in [r["spans"], *more["spans"]]:
            place, n = (np.frombuffer(x, "<i8") for x in _unbundle(spans))
            np.add.at(edge, place, 1)
            np.add.at(edge, place + n + setup.length - 1, -1)
        gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
        out, at = [], 0
        for doc_id, null, size in zip(r["doc_ids"], r["nulls"], r["sizes"]):
            mask = gone[at : at + size]
            turns = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
            removed = [{"start": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()]
            kept = data[at : at + size][~mask].tobytes()
            out.append((None if null else int(doc_id), int(size), removed, kept))
            at += size
        frame = pd.DataFrame(out, columns=columns)
        return frame.assign(doc_id=frame["doc_id"].astype("Int64"))

    met = (
        runs.select("run", F.posexplode("seeds").alias("bucket", "seeds"))
        .where("seeds is not null")
        .groupBy("bucket")
        .applyInPandas(meet, "run long, seeds binary")
    )
    spans = (
        runs.groupBy("run")
        .cogroup(met.groupBy("run"))
        .applyInPandas(exchange, "bucket long, run long, kind int, blob binary")
        .groupBy("bucket")
        .applyInPandas(decide, "run long, spans binary")
    )
    spans = store(spans, "suffix-repeats", "none")
    return (
        runs.drop("seeds")
        .groupBy("run")
        .cogroup(spans.groupBy("run"))
        .applyInPandas(
            cut, "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
        )
    )
