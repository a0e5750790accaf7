"""Packing of documents into training sequences by best-two-fit.

A bin is filled greedily with the longest pieces that fit. Then its smallest piece is
exchanged for two unpacked pieces, if two fit the gap that its removal opens more
tightly than it did; this repeats until nothing gets tighter.

Pieces of one length are alike, so the plan is made from the number of pieces of each
length: at most ``capacity`` numbers, whatever the size of the corpus. A bin that can
be filled the same way many times becomes one pattern with a count. Each piece then
finds its place from its rank among the pieces of its length; ranks come from counts
per written shard, so no length, however frequent, is gathered in one task.

Defined results: a null text is an empty one (one piece with the end id). Rows with
null or repeated document ids are packed like others. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import encoder, slices, store

PIECES = (
    "shard int, row long, doc_id long, piece int, start long, length int, rank long, ids binary"
)


def _tightest_pair(lengths: list[int], left: Counter, room: int) -> tuple[int, int] | None:
    """The two unpacked pieces with the largest sum of at most ``room``."""
    best, pair, i, j = 0, None, 0, bisect_right(lengths, room) - 1
    while i <= j:
        total = lengths[i] + lengths[j]
        if total > room or (i == j and left[lengths[i]] < 2):
            j -= 1
            continue
        if total > best:
            best, pair = total, (lengths[i], lengths[j])
        i += 1
    return pair


def _fill(lengths: list[int], counts: Counter, capacity: int) -> Counter:
    """One bin: piece lengths and how often each is in it."""
    used: Counter = Counter()
    gap, at = capacity, bisect_right(lengths, capacity) - 1
    while at >= 0:
        length = lengths[at]
        if n := min(counts[length], gap // length):
            used[length] = n
            gap -= n * length
        at = min(at - 1, bisect_right(lengths, gap) - 1)
    while gap and used:
        smallest = min(used)
        left = counts - used
        open_lengths = [x for x in lengths if left[x]]
        pair = _tightest_pair(open_lengths, left, gap + smallest)
        if pair is None or sum(pair) <= smallest:
            break
        used -= Counter([smallest])
        used += Counter(pair)
        gap += smallest - sum(pair)
    return used


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pattern, number of bins filled like it), from the number of pieces per length."""
    left = Counter({k: n for k, n in counts.items() if n > 0})
    plan = []
    while left:
        used = _fill(sorted(left), left, capacity)
        times = min(left[k] // n for k, n in used.items())
        plan.append((dict(used), times))
        left -= Counter({k: n * times for k, n in used.items()})
    return plan


def _slots(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length: first rank, first sequence, pieces per sequence and offset of each run."""
    ranks: Counter = Counter()
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for length, n in sorted(pattern.items(), reverse=True):
            rows.setdefault(length, []).append((ranks[length], sequence, n, offset))
            ranks[length] += n * times
            offset += n * length
        sequence += times
    return {k: np.array(v, np.int64) for k, v in rows.items()}


@dataclass
class Packing:
    """``pieces`` holds the ids of every piece, ``layout`` where it goes and their checksum."""

    pieces: DataFrame
    layout: DataFrame
    n_sequences: int

    def placed(self) -> DataFrame:
        """Pieces with ids, sequence_id and offset."""
        return self.pieces.drop("rank").join(
            self.layout.select("shard", "row", "sequence_id", "offset"), ["shard", "row"]
        )

    def sequences(self) -> DataFrame:
        """sequence_id and its ids; a sequence never exceeds the capacity."""
        parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
        joined = F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
        return (
            self.placed()
            .groupBy("sequence_id")
            .agg(parts.alias("parts"))
            .select("sequence_id", joined.alias("ids"))
        )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Packing:
    """Tokenize, cut what exceeds ``capacity`` and place every piece.

    A longer document is cut into pieces of ``capacity`` tokens, the first one shorter
    where the length is no multiple.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, row, seen = TaskContext.get().partitionId(), 0, Counter()
        names = [c.split()[0] for c in PIECES.split(", ")]
        for batch in batches:
            texts = batch["text"].tolist()
            doc_ids = batch["doc_id"].astype("Int64").tolist()
            for part in slices(texts):
                out = []
                for doc_id, ids in zip(doc_ids[part], encoder(tokenizer).encode(texts[part])):
                    ids += end
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1
                    for piece, stop in enumerate(range(first, n + 1, capacity)):
                        start = max(0, stop - capacity)
                        length = stop - start
                        out.append(
                            (shard, row, doc_id, piece, start, length, seen[length], ids[4 * start : 4 * stop])
                        )
                        row += 1
                        seen[length] += 1
                frame = pd.DataFrame(out, columns=names)
                yield frame.assign(doc_id=frame["doc_id"].astype("Int64"))

    pieces = store(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        ).mapInPandas(run, PIECES),
        "pieces",
    )
    per_shard = pieces.groupBy("length", "shard").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_shard.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_two_fit(counts, capacity)
    slots = _slots(plan)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(length), 2), np.int64)
        values = length.to_numpy()
        for k in np.unique(values):
            at = np.flatnonzero(values == k)
            r, runs = rank.to_numpy()[at], slots[int(k)]
            first, sequence, n, offset = runs[np.searchsorted(runs[:, 0], r, "right") - 1].T
            out[at, 0] = sequence + (r - first) // n
            out[at, 1] = offset + (r - first) % n * k
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_shard.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    layout = (
        pieces.withColumn("ids_crc32", F.crc32("ids"))
        .drop("ids")
        .join(bases, ["shard", "length"])
        .withColumn("place", place("length", F.col("rank") + F.col("base")))
        .select("shard", "row", "doc_id", "piece", "start", "length", "ids_crc32", "place.*")
    )
    return Packing(pieces, layout, sum(times for _, times in plan))
