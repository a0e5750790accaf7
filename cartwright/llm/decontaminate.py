"""Benchmark decontamination by latent semantic retrieval.

Texts are windows of words, each half overlapping the next, over the vocabulary of the
benchmark. A randomised SVD of their TF-IDF matrix gives a latent space: every task
multiplies its windows with a random test matrix and back, the small products are added
up in a shuffle, and the decomposition follows from their sum in one pass over all
windows. Benchmark items count as much as all documents together, so that their own
directions are among those kept. Items are searched by pieces that fit into a window. A
window is a candidate for an item if its cosine with a piece reaches a threshold and its
projection on the piece is a good part of the piece's own length. The latent space keeps
little of some pieces and other words of a window can take away from a projection, so
words are counted too: a window with enough words of a piece is a candidate, whatever
else it holds and whatever the rank. The longest common subsequence
of content words between the item and the surroundings of the window then decides. An item that is nearly all there is a leak;
one of which a good part is there in order is a paraphrase if its answer is there too.
The answer is a column of the benchmark or, without one, the last sentence.

Items are taken in blocks, so what a task holds is bounded by the size of a block and
never by the corpus. Words in more than ``common`` of all half windows carry no weight,
unless an item would keep fewer than four words that do.

Defined results: one row per document row and leaked item. Null or empty texts, and
items without words, give none; null ids stay null, repeated rows are all reported.
Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import discard, slices, store

WORD = re.compile(r"\w+")
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")
HALF = 32  # words in half a window
HITS = (
    "doc_id long, item_id long, first_word int, cosine double, lcs_share double, "
    "answer_share double, verbatim boolean"
)


@dataclass(frozen=True)
class Limits:
    rank: int = 160
    oversample: int = 16
    common: float = 0.05
    cosine: float = 0.25
    projection: float = 0.5
    held: float = 0.5  # words of a window from a piece, as a share of the piece's words
    verbatim: float = 0.8
    paraphrase: float = 0.6
    answer: float = 0.8
    items_at_once: int = 400


class Vocabulary(dict):
    """Numbers of the benchmark's words; -1 for others."""

    def __missing__(self, word: str) -> int:
        return -1


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


@dataclass
class Item:
    item_id: int | None
    ids: list[int]
    answer: list[int]
    content: list[int] = field(default_factory=list)
    answer_content: list[int] = field(default_factory=list)


def common_subsequence(item: list[int], region: list[int]) -> int:
    """Length of the longest common subsequence, a bit per word of the item."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    every = (1 << len(item)) - 1
    row = every
    for w in region:
        if mask := masks.get(w):
            kept = row & mask
            row = ((row + kept) | (row - kept)) & every
    return len(item) - row.bit_count()


class Windows:
    """Content words of a batch of documents, by half windows."""

    def __init__(self, docs: list[np.ndarray], weighs: np.ndarray) -> None:
        sizes = np.array([len(d) for d in docs], np.int64)
        halves = -(-sizes // HALF)
        self.first_half = np.cumsum(halves) - halves
        self.n_halves = int(halves.sum())
        joined = np.concatenate(docs) if docs else np.zeros(0, np.int32)
        place = np.arange(len(joined)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        half = np.repeat(self.first_half, sizes) + place // HALF
        keep = (joined >= 0) & weighs[joined]
        self.word, self.half = joined[keep], half[keep]
        # A window starts at each half; the last half of a document has no next one.
        self.ends = np.zeros(self.n_halves, bool)
        self.ends[self.first_half[halves > 0] + halves[halves > 0] - 1] = True

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """Per window the sum of the rows of its words."""
        out = np.zeros((self.n_halves, rows.shape[1]), np.float32)
        if len(self.word):
            cuts = np.flatnonzero(np.append(True, self.half[1:] != self.half[:-1]))
            out[self.half[cuts]] = np.add.reduceat(rows[self.word], cuts)
        following = np.roll(out, -1, axis=0)
        following[self.ends] = 0
        return out + following

    def held(self, starts: np.ndarray, pieces: np.ndarray, n_pieces: int) -> np.ndarray:
        """Per window and piece the words that are of the piece; word w is of
        pieces[starts[w] : starts[w + 1]]."""
        n = starts[self.word + 1] - starts[self.word]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[self.word], n)
        key = np.repeat(self.half, n) * n_pieces + pieces[at]
        out = np.bincount(key, minlength=self.n_halves * n_pieces).astype(np.int32)
        out = out.reshape(self.n_halves, n_pieces)
        following = np.roll(out, -1, axis=0)
        following[self.ends] = 0
        return out + following

    def spread(self, values: np.ndarray, n_words: int) -> np.ndarray:
        """Per word the sum of the values of the windows it is in, with repeats."""
        before = np.roll(values, 1, axis=0)
        before[np.roll(self.ends, 1)] = 0
        both = values + before
        out = np.zeros((n_words, values.shape[1]))
        order = np.argsort(self.word, kind="stable")
        word = self.word[order]
        if len(word):
            cuts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            out[word[cuts]] = np.add.reduceat(both[self.half[order]], cuts)
        return out


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[np.ndarray]]]:
    for batch in batches:
        ids = batch["doc_id"].astype("Int64").tolist()
        docs = [np.frombuffer(x, "<i4") for x in batch["ids"]]
        sizes = [range(len(d)) for d in docs]
        for part in slices(sizes, 100_000):
            yield ids[part], docs[part]


def _added(parts: DataFrame, n: int, width: int) -> np.ndarray:
    """Rows (word long, value binary) added up by word, as one matrix of bounded size."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, "<f8") for x in group["value"]], axis=0)
        return pd.DataFrame({"word": group["word"][:1], "value": [total.tobytes()]})

    out = np.zeros((n, width))
    for r in parts.groupBy("word").applyInPandas(add, "word long, value binary").collect():
        rows = np.frombuffer(r.value, "<f8").reshape(-1, width)
        out[r.word : r.word + len(rows)] = rows
    return out


def _rows(matrix: np.ndarray, at_once: int = 64) -> pd.DataFrame:
    starts = range(0, len(matrix), at_once)
    values = [np.ascontiguousarray(matrix[i : i + at_once], "<f8").tobytes() for i in starts]
    return pd.DataFrame({"word": list(starts), "value": values})


def find_leaks(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Rows of HITS for every document row and benchmark item leaked into it."""
    spark = docs.sparkSession
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", answer.alias("answer"))
    found, block = [], []
    for row in items.orderBy("item_id", "text").toLocalIterator():
        block.append(row)
        if len(block) == limits.items_at_once:
            found.append(_leaks_of(docs, block, limits))
            block = []
    if block:
        found.append(_leaks_of(docs, block, limits))
    found = [x for x in found if x is not None]
    if not found:
        return spark.createDataFrame([], HITS)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _items(rows: list, vocabulary: Vocabulary) -> list[Item]:
    items = []
    for r in rows:
        text = words(r.text)
        if not text:
            continue
        for w in text:
            vocabulary.setdefault(w, len(vocabulary))
        last = r.answer if r.answer is not None else [s for s in SENTENCE_END.split(r.text) if words(s)][-1]
        answer = [vocabulary.setdefault(w, len(vocabulary)) for w in words(last)]
        items.append(Item(r.item_id, [vocabulary[w] for w in text], answer))
    return items


def _leaks_of(docs: DataFrame, rows: list, limits: Limits) -> DataFrame | None:
    vocabulary = Vocabulary()
    items = _items(rows, vocabulary)
    if not items:
        return None
    n_words = len(vocabulary)
    everything = np.ones(n_words, bool)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = vocabulary.__getitem__
        for batch in batches:
            ids = [np.fromiter(map(find, words(t)), "<i4").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "ids": ids})

    numbered = store(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
            number, "doc_id long, ids binary"
        ),
        "numbered",
    )

    def frequency(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((n_words + 1, 1))
        for _, part in _batches(batches):
            w = Windows(part, everything)
            seen = np.unique(w.half * n_words + w.word)
            total[:n_words, 0] += np.bincount(seen % n_words, minlength=n_words)
            total[n_words] += w.n_halves
        yield _rows(total, 1024)

    counts = _added(numbered.mapInPandas(frequency, "word long, value binary"), n_words + 1, 1)[:, 0]
    n_windows, df = max(1.0, counts[n_words]), counts[:n_words]
    weighs = df <= limits.common * n_windows
    for item in items:
        if sum(weighs[w] for w in set(item.ids)) < 4:
            weighs[item.ids] = True
    idf = np.where(weighs, np.log((1 + n_windows) / (1 + df)) + 1, 0.0)
    for item in items:
        item.content = [w for w in item.ids if weighs[w]]
        item.answer_content = [w for w in item.answer if weighs[w]]

    pieces, owner = [], []
    for k, item in enumerate(items):
        n = -(-len(item.ids) // HALF)
        cuts = [len(item.ids) * j // n for j in range(n + 1)]
        pieces += [item.ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        owner += [k] * n
    own = np.zeros((len(pieces), n_words))
    for i, piece in enumerate(pieces):
        np.add.at(own[i], piece, idf[piece])
    piece_of, word_of = np.nonzero(own)
    by_word = np.argsort(word_of, kind="stable")
    starts = np.searchsorted(word_of[by_word], np.arange(n_words + 1))
    piece_of = piece_of[by_word]
    # A piece without words that weigh asks for more than any window has.
    lengths = np.array([sum(weighs[w] for w in piece) for piece in pieces])
    enough = np.where(lengths > 0, np.ceil(limits.held * lengths), 4 * HALF).astype(np.int32)
    width = min(limits.rank + limits.oversample, n_words)
    test = np.random.default_rng(5).standard_normal((n_words, width))
    sketch_rows = (idf[:, None] * test).astype(np.float32)

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((n_words + 1, width))
        for _, part in _batches(batches):
            w = Windows(part, weighs)
            values = w.sums(sketch_rows)
            total[:n_words] += w.spread(values, n_words)
            total[n_words] += float(np.einsum("ij,ij->", values, values))
        yield _rows(total)

    product = _added(numbered.mapInPandas(sketch, "word long, value binary"), n_words + 1, width)
    energy = product[n_words, 0]
    product = product[:n_words] * idf[:, None]
    seen = own @ test
    weight = max(1.0, energy) / max(1e-9, float((seen**2).sum()))
    product += weight * (own.T @ seen)
    basis = _leading(product, test, limits.rank)
    latent_rows = (idf[:, None] * basis).astype(np.float32)
    latent_items = own @ basis
    sizes = np.maximum(np.linalg.norm(latent_items, axis=1), 1e-9)
    latent_items = (latent_items / sizes[:, None]).astype(np.float32).T.copy()
    least = (limits.projection * sizes).astype(np.float32)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, part in _batches(batches):
            w = Windows(part, weighs)
            latent = w.sums(latent_rows)
            norms = np.sqrt(np.einsum("ij,ij->i", latent, latent))
            along = latent @ latent_items
            norms = np.maximum(norms, 1e-9)[:, None]
            hits: dict[tuple[int, int], dict[int, float]] = {}
            near = (along >= least) & (along >= limits.cosine * norms)
            near |= w.held(starts, piece_of, len(pieces)) >= enough
            for half, j in np.argwhere(near).tolist():
                doc = int(np.searchsorted(w.first_half, half, "right")) - 1
                places = hits.setdefault((doc, owner[j]), {})
                cosine = float(along[half, j] / norms[half, 0])
                places[half] = max(places.get(half, 0.0), cosine)
            out = []
            for (doc, k), places in hits.items():
                best = _checked(items[k], part[doc], int(w.first_half[doc]), places, weighs, limits)
                if best:
                    doc_id = None if ids[doc] is pd.NA else ids[doc]
                    out.append((doc_id, items[k].item_id, *best))
            if out:
                frame = pd.DataFrame(out, columns=[c.split()[0] for c in HITS.split(", ")])
                for c in ("doc_id", "item_id"):
                    frame[c] = frame[c].astype("Int64")
                yield frame

    return numbered.mapInPandas(search, HITS)


def _leading(product: np.ndarray, test: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors of A, from AᵀA·test alone."""
    basis, _ = np.linalg.qr(product)
    small = (basis.T @ product) @ np.linalg.pinv(basis.T @ test)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return basis @ vectors[:, np.argsort(-np.abs(values))[:rank]]


def _checked(
    item: Item,
    doc: np.ndarray,
    first_half: int,
    places: dict[int, float],
    weighs: np.ndarray,
    limits: Limits,
) -> tuple | None:
    """The best place of an item in a document where it counts as leaked."""
    best = None
    for half, cosine in sorted(places.items()):
        start = (half - first_half) * HALF
        low, high = max(0, start - len(item.ids)), start + 2 * HALF + len(item.ids)
        every = doc[low:high]
        every = every[every >= 0]
        region = every[weighs[every]].tolist()
        share = common_subsequence(item.content, region) / len(item.content)
        if share < limits.paraphrase or (best and share <= best[2]):
            continue
        # An answer of common words only is looked for among all words.
        wanted, among = (item.answer_content, region) if item.answer_content else (item.answer, every.tolist())
        answer = common_subsequence(wanted, among) / len(wanted) if wanted else 0.0
        if share >= limits.verbatim or answer >= limits.answer:
            best = (int(start), cosine, share, answer, share >= limits.verbatim)
    return best
