"""Helpers shared by the operators: stored tables and tokenizing inside tasks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from cartwright.session import scratch_path


def store(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: what follows survives lost executors without running the
    plan of ``df`` again, and several readers share one computation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table written by ``store`` that nothing reads any more."""
    spark = df.sparkSession
    for path in {file.rpartition("/")[0] for file in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# What byte-level vocabularies use for a space and a line's end.
SPACE, NEWLINE = "\u0120", "\u010a"
# Up to here no version of Unicode disagrees on what a letter is.
LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
MARKS = re.escape("".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'"))
# One token's worth in the usual word pattern: letters, marks, or a line's end. Behind each
# stands what cannot belong to it, so a piece is the same in any text.
USUAL = rf" ?[{LETTERS}]++(?=[\x00-@\[-`{{-\x7f]|\Z)| ?[{MARKS}]++(?=[ \nA-Za-z0-9]|\Z)|\n(?=\S)"
# Anything else goes on to the next space before a visible character, where no token crosses.
PIECES = re.compile(rf"{USUAL}|.[^ ]*+(?: (?!\S)[^ ]*+)*+", re.DOTALL)
ONE_TOKEN = re.compile(rf" ?[{LETTERS}]++| ?[{MARKS}]++|\n")


class PartEncoder:
    """Encodes texts with a byte-level BPE of the tokenizers library, piece by piece.

    Texts are cut where no token can cross. Every distinct piece of a batch is encoded once;
    pieces stay in a bounded cache of the worker. What the word pattern leaves whole goes to
    the library's model without it, all in one call. The ids are those of the whole text;
    ``tests/llm`` compares them.

    The vocabulary's special tokens are found in texts as the library finds them, and their
    ids stand alone; with ``plain`` they are text like any other.
    """

    def __init__(
        self,
        path: str,
        plain: bool = False,
        cached_pieces: int = 500_000,
        cached_length: int = 48,
    ) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        special = [] if plain else self.tokenizer.get_added_tokens_decoder().values()
        names = [re.escape(x.content) for x in special]
        self.special = re.compile("|".join(sorted(names, key=len, reverse=True))) if names else None
        size = self.tokenizer.get_vocab_size()
        self.opens = np.array([self.tokenizer.id_to_token(i)[:1] == SPACE for i in range(size)])
        # The same model for one piece a line, in the characters that stand for its bytes.
        self.by_line = Tokenizer.from_file(path)
        self.by_line.encode_special_tokens = plain
        self.by_line.pre_tokenizer = CharDelimiterSplit("\r")
        spelled = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = str.maketrans({c: spelled(c)[0][0] for c in LETTERS if not c.isascii()})
        self.cached_pieces = cached_pieces
        self.cached_length = cached_length
        self._forget()

    def _forget(self) -> None:
        """``ids`` holds those of each known piece, from ``starts`` at its place to the next."""
        self.places: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _ids(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, "<u4")

    def _by_line(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that are one token's worth, and how many of each. Only a piece's first
        token can open with a space; a piece without one follows a line that is a space."""
        bare = np.array([x[0] != " " for x in pieces])
        text = "\r".join([f" \r{x}" if b else x for x, b in zip(pieces, bare.tolist())])
        text = text if text.isascii() else text.translate(self.spelling)
        text = text.replace(" ", SPACE).replace("\n", NEWLINE)
        found = self.by_line.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found[0].ids, "<u4")
        cuts = np.flatnonzero(self.opens[ids])
        if len(cuts) != len(pieces):
            raise ValueError("a vocabulary without spaces at the start of its tokens")
        return np.delete(ids, cuts[bare]), np.diff(cuts, append=len(ids)) - bare

    def _learn(self, new: set[str]) -> int:
        """Give new pieces their places, those to be kept first; how many to keep in all."""
        whole = ONE_TOKEN.fullmatch
        usual = [x for x in new if len(x) <= self.cached_length and whole(x)]
        other = sorted(new.difference(usual), key=lambda x: len(x) > self.cached_length)
        # Only what is not ASCII must be spelled out.
        groups = [x for x in usual if x.isascii()], [x for x in usual if not x.isascii()]
        found = [self._by_line(group) for group in groups if group]
        found += [(ids, [len(ids)]) for ids in map(self._ids, other)]
        first = len(self.places)
        self.ids = np.concatenate([self.ids, *(ids for ids, _ in found)])
        counts = np.concatenate([self.starts[:0], *(n for _, n in found)])
        self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(counts))
        self.places.update(zip(chain(*groups, other), range(first, first + len(new))))
        return first + sum(len(x) <= self.cached_length for x in new)

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        texts = list(texts)
        marked = [i for i, t in enumerate(texts) if self.special and self.special.search(t)]
        if not marked:
            return self._encode(texts)
        out: list[bytes] = [b""] * len(texts)
        odd = set(marked)
        usual = [i for i in range(len(texts)) if i not in odd]
        for i, ids in zip(usual, self._encode([texts[i] for i in usual]), strict=True):
            out[i] = ids
        for i in marked:
            found = self.special.findall(texts[i])
            between = self._encode(self.special.split(texts[i]))
            marks = [self._ids(x).tobytes() for x in found] + [b""]
            out[i] = b"".join(chain.from_iterable(zip(between, marks, strict=True)))
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.places) > self.cached_pieces:
            self._forget()
        pieces = list(map(PIECES.findall, texts))
        every, kept = list(chain.from_iterable(pieces)), len(self.places)
        at = np.fromiter(map(self.places.get, every, repeat(-1)), np.int64, len(every))
        if len(new := np.flatnonzero(at < 0)):
            missing = [every[i] for i in new.tolist()]
            kept = self._learn(set(missing))
            at[new] = np.fromiter(map(self.places.__getitem__, missing), np.int64, len(missing))
            for x in {x for x in missing if len(x) > self.cached_length}:
                del self.places[x]
        counts = self.starts[at + 1] - self.starts[at]
        stops = np.append(0, np.cumsum(counts))
        take = np.arange(stops[-1]) + np.repeat(self.starts[at] - stops[:-1], counts)
        data = self.ids[take].tobytes()
        cuts = (4 * stops[np.cumsum([0, *map(len, pieces)])]).tolist()
        self.starts = self.starts[: kept + 1]
        self.ids = self.ids[: self.starts[-1]]
        return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


_encoders: dict[tuple[str, bool], PartEncoder] = {}


def encoder(path: str, plain: bool = False) -> PartEncoder:
    """The encoder of this Python worker for a vocabulary file."""
    if (path, plain) not in _encoders:
        _encoders[path, plain] = PartEncoder(path, plain)
    return _encoders[path, plain]


def slices(values: list[str], most_chars: int = 800_000) -> Iterator[slice]:
    """Ranges of ``values`` of bounded total length, so long texts do not add up."""
    start = size = 0
    for i, value in enumerate(values):
        size += len(value)
        if size >= most_chars:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(values):
        yield slice(start, len(values))
