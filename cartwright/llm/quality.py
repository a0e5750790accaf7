"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks of bytes that cover all of it. Learned filters
slide over the embedded bytes of a chunk; the largest response of each filter in the
chunk, and a hidden layer over them, describe the chunk. The mean and the maximum of
these descriptions over all chunks of a document give one logit, hence one probability.

Training uses a bounded sample of labelled rows (``Sample``); scoring reads every byte.
Only the text is an input.

Defined results: a null or empty text is one chunk of padding and gets the score the
network has for it. Without labels of both kinds every score is the share of label 1
(0.5 without any label). Repeated and null ids keep their own rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices

CHUNK, STEP = 512, 384  # bytes in a chunk and between starts of chunks
WIDTH, STRIDE = 12, 4  # bytes under a filter and between its places
EMBED, FILTERS, HIDDEN = 8, 40, 24
PLACES = (CHUNK - WIDTH) // STRIDE + 1


@dataclass(frozen=True)
class Sample:
    """Bounds of the training sample: labelled documents, taken by a hash of their id,
    and chunks of each, evenly spaced."""

    documents: int = 3000
    chunks: int = 16


def chunked(text: str | None) -> np.ndarray:
    """All chunks of a text, padded with zeros, as rows of bytes."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-max(0, len(data) - CHUNK) // STEP) + 1)
    padded = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


class ByteNetwork:
    """Parameters, scoring and training."""

    def __init__(self, seed: int = 7) -> None:
        r = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (r.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "embed": normal(256, EMBED, scale=0.5),
            "filters": normal(WIDTH * EMBED, FILTERS, scale=(WIDTH * EMBED) ** -0.5),
            "bias": np.zeros(FILTERS, np.float32),
            "mix": normal(FILTERS, HIDDEN, scale=FILTERS**-0.5),
            "mix_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(2 * HIDDEN, scale=0.1),
            "out_bias": np.zeros(1, np.float32),
        }

    def _columns(self, chunks: np.ndarray) -> np.ndarray:
        embedded = self.p["embed"][chunks].reshape(len(chunks), CHUNK * EMBED)
        view = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * EMBED, axis=1)
        return view[:, :: STRIDE * EMBED]

    def _pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per chunk and filter the largest response and its place."""
        best = np.empty((len(chunks), FILTERS), np.float32)
        place = np.empty((len(chunks), FILTERS), np.int64)
        for i in range(0, len(chunks), 64):
            part = chunks[i : i + 64]
            columns = np.ascontiguousarray(self._columns(part)).reshape(-1, WIDTH * EMBED)
            response = (columns @ self.p["filters"]).reshape(len(part), PLACES, FILTERS)
            place[i : i + 64] = response.argmax(1)
            best[i : i + 64] = response.max(1)
        return best + self.p["bias"], place

    def _documents(self, hidden: np.ndarray, starts: np.ndarray) -> np.ndarray:
        counts = np.diff(np.append(starts, len(hidden)))[:, None]
        mean = np.add.reduceat(hidden, starts) / counts
        return np.hstack([mean, np.maximum.reduceat(hidden, starts)])

    def describe(self, chunks: np.ndarray) -> np.ndarray:
        pooled, _ = self._pooled(chunks)
        return np.tanh(np.maximum(pooled, 0) @ self.p["mix"] + self.p["mix_bias"])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        cut = [chunked(t) for t in texts]
        starts = np.cumsum([0] + [len(x) for x in cut[:-1]])
        hidden = np.vstack([self.describe(x) for x in self._batches(cut)])
        logits = self._documents(hidden, starts) @ self.p["out"] + self.p["out_bias"]
        return 1 / (1 + np.exp(-logits.astype(np.float64)))

    @staticmethod
    def _batches(cut: list[np.ndarray]) -> Iterator[np.ndarray]:
        """The chunks of all documents in order, some thousand at a time."""
        held: list[np.ndarray] = []
        for x in cut:
            held.append(x)
            if sum(map(len, held)) >= 2048:
                yield from np.array_split(np.vstack(held), max(1, sum(map(len, held)) // 4096))
                held = []
        if held:
            yield np.vstack(held)

    def gradients(self, chunks: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict:
        p = self.p
        pooled, place = self._pooled(chunks)
        active = np.maximum(pooled, 0)
        hidden = np.tanh(active @ p["mix"] + p["mix_bias"])
        docs = self._documents(hidden, starts)
        score = 1 / (1 + np.exp(-(docs @ p["out"] + p["out_bias"])))
        error = ((score - y) / len(y)).astype(np.float32)
        g = {"out": docs.T @ error, "out_bias": error.sum(keepdims=True)}
        d_docs = error[:, None] * p["out"]
        counts = np.diff(np.append(starts, len(chunks)))
        doc_of = np.repeat(np.arange(len(starts)), counts)
        d_hidden = d_docs[doc_of, :HIDDEN] / counts[doc_of, None]
        top = hidden == docs[doc_of, HIDDEN:]
        ties = np.add.reduceat(top, starts, dtype=np.float32)
        d_hidden += top * (d_docs[:, HIDDEN:] / ties)[doc_of]
        d_mixed = d_hidden * (1 - hidden**2)
        g["mix"], g["mix_bias"] = active.T @ d_mixed, d_mixed.sum(0)
        d_pooled = (d_mixed @ p["mix"].T) * (pooled > 0)
        g["bias"] = d_pooled.sum(0)
        at = place[:, :, None] * STRIDE + np.arange(WIDTH)
        seen = chunks[np.arange(len(chunks))[:, None, None], at]
        flat = p["embed"][seen].reshape(len(chunks), FILTERS, WIDTH * EMBED)
        g["filters"] = np.einsum("nf,nfk->kf", d_pooled, flat, optimize=True)
        d_seen = (d_pooled[:, :, None] * p["filters"].T).reshape(-1, EMBED)
        bytes_seen = seen.ravel()
        g["embed"] = np.stack(
            [np.bincount(bytes_seen, d_seen[:, k], 256) for k in range(EMBED)], 1
        ).astype(np.float32)
        return g

    def fit(
        self, docs: list[np.ndarray], y: np.ndarray, batch: int = 32, rate: float = 0.004
    ) -> None:
        """Adam on the cross-entropy, documents in a seeded order; few ones more often."""
        epochs = max(8, min(24, 7680 // len(docs)))
        r = np.random.default_rng(11)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        steps, step = epochs * -(-len(docs) // batch), 0
        for _ in range(epochs):
            order = r.permutation(len(docs))
            for i in range(0, len(docs), batch):
                pick = order[i : i + batch]
                starts = np.cumsum([0] + [len(docs[k]) for k in pick[:-1]])
                g = self.gradients(np.vstack([docs[k] for k in pick]), starts, y[pick])
                step += 1
                now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
                for k, d in g.items():
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.99 * v[k] + 0.01 * d * d
                    unbiased = m[k] / (1 - 0.9**step)
                    self.p[k] -= now * unbiased / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)


class Constant:
    def __init__(self, score: float) -> None:
        self.score = score

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return np.full(len(texts), self.score)


def train(labelled: DataFrame, sample: Sample = Sample()) -> ByteNetwork | Constant:
    """A network from rows of (doc_id, text, label), label 0 or 1."""
    rows = labelled.where(F.col("label").isin(0, 1))
    n = rows.count()
    rank = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1_000_000))
    share = min(1.0, 0.9 * sample.documents / max(1, n))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t in batch.itertuples():
                chunks = chunked(t.text)
                pick = np.unique(np.linspace(0, len(chunks) - 1, sample.chunks).astype(int))
                out.append((t.rank, t.label, chunks[pick].tobytes()))
            yield pd.DataFrame(out, columns=["rank", "label", "chunks"])

    picked = (
        rows.select(rank.alias("rank"), F.col("label").cast("int"), "text")
        .where(F.col("rank") < int(1_000_000 * share) + 1)
        .limit(sample.documents)
        .mapInPandas(run, "rank long, label int, chunks binary")
        .collect()
    )
    picked = sorted((r.rank, bytes(r.chunks), r.label) for r in picked)
    y = np.array([x[2] for x in picked], np.float32)
    if len(set(y.tolist())) < 2:
        return Constant(float(y.mean()) if len(y) else 0.5)
    network = ByteNetwork()
    network.fit([np.frombuffer(x[1], np.uint8).reshape(-1, CHUNK) for x in picked], y)
    return network


def quality_score(text: Column, model: ByteNetwork | Constant) -> Column:
    """Probability of label 1 for each text."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = [t or "" for t in batch]
            parts = [model.scores(texts[s]) for s in slices(texts, 2_000_000)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score(text)


def held_out(doc_id: Column) -> Column:
    """Rows never used for training: a quarter, by the CRC-32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train_on(docs: DataFrame, labels: DataFrame, sample: Sample = Sample()) -> ByteNetwork | Constant:
    """Train on the labelled documents that are not held out."""
    known = labels.select("doc_id", F.col("quality").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return train(docs.select("doc_id", "text").join(known, "doc_id"), sample)
