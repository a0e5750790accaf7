r"""Chat formatting at token level, reversible.

A turn is written as

    <|turn|> role <|role|> text <|end|>

where the three marks are reserved ids above the vocabulary, never text. Role and text
are encoded separately, so no token crosses a mark. Strings in them that look like a
control string of this or a common other template are escaped with a backslash after
their first character, and backslashes are doubled; ``unescape`` takes that back.

The loss mask covers the text of the turns of ``loss_role`` and nothing else. Its range
and the place of each turn in its conversation are prefix sums of segment lengths. They
are taken in two levels, within sorted ranges of turns and over the ranges, so that a
conversation of any length is spread over tasks.

Defined results: a null text or role is an empty one. Turns are ordered by turn (null
first); repeated turn numbers stay, in an order fixed by a hash of role and text. Rows without a
conversation id form one conversation. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import encoder, slices, store

MARKS = ("<|turn|>", "<|role|>", "<|end|>")
# Control strings that a text must not hold unescaped.
CONTROL_STRINGS = (
    *MARKS,
    "<|endoftext|>",
    "<|startoftext|>",
    "<|im_start|>",
    "<|im_end|>",
    "<|system|>",
    "<|user|>",
    "<|assistant|>",
    "<<SYS>>",
    "<</SYS>>",
    "[INST]",
    "[/INST]",
    "<s>",
    "</s>",
)
_CONTROL = re.compile("|".join(re.escape(x) for x in CONTROL_STRINGS))
_ESCAPED = re.compile(r"\\(\\?)")

SEGMENTS = (
    "conv_id long, shard int, row long, before long, n_tokens long, "
    "loss_from long, loss_to long, ids binary"
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(
    turns: DataFrame, tokenizer: str, loss_role: str = "assistant"
) -> DataFrame:
    """One row per turn: conv_id, start (tokens of its conversation before it),
    n_tokens, loss_from and loss_to (token range under the loss mask, in the
    conversation; empty if equal) and ids (unsigned 32-bit little-endian).

    The rows of a conversation in order of ``start`` are its token sequence.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = encoder(tokenizer, plain=True).tokenizer.get_vocab_size()
        turn, role_end, end = (np.array([first + i], "<u4").tobytes() for i in range(3))
        shard, row, last, total = TaskContext.get().partitionId(), 0, object(), 0
        for batch in batches:
            conv_ids = batch["conv_id"].astype("Int64").tolist()
            roles, texts = batch["role"].tolist(), batch["text"].tolist()
            for part in slices(texts):
                head = encoder(tokenizer, plain=True).encode([escape(x) for x in roles[part]])
                body = encoder(tokenizer, plain=True).encode([escape(x) for x in texts[part]])
                out = []
                for conv, role, a, b in zip(conv_ids[part], roles[part], head, body):
                    conv = None if conv is pd.NA else conv
                    if conv != last:
                        last, total = conv, 0
                    lengths = np.cumsum([1, len(a) // 4, 1, len(b) // 4, 1])
                    low = lengths[2]
                    high = lengths[3] if role == loss_role else low
                    ids = turn + a + role_end + b + end
                    out.append((conv, shard, row, total, lengths[4], low, high, ids))
                    total += lengths[4]
                    row += 1
                frame = pd.DataFrame(out, columns=[c.split()[0] for c in SEGMENTS.split(", ")])
                yield frame.assign(conv_id=frame["conv_id"].astype("Int64"))

    ordered = (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .withColumn("h", F.xxhash64("role", "text"))
        # The hash lets a range boundary fall among rows that repeat a turn.
        .repartitionByRange("conv_id", "turn", "h")
        .sortWithinPartitions("conv_id", "turn", "h", "role", "text")
    )
    segments = store(ordered.select("conv_id", "role", "text").mapInPandas(run, SEGMENTS), "chat")
    earlier = Window.partitionBy("conv_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        segments.groupBy("conv_id", "shard")
        .agg(F.sum("n_tokens").alias("n"))
        .select("conv_id", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    )
    joined = segments.alias("s").join(
        bases.alias("b"),
        F.col("s.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("s.shard") == F.col("b.shard")),
    )
    start = F.col("base") + F.col("before")
    return joined.select(
        "s.conv_id",
        start.alias("start"),
        "n_tokens",
        (start + F.col("loss_from")).alias("loss_from"),
        (start + F.col("loss_to")).alias("loss_to"),
        "ids",
    )


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_tokens long, loss_tokens long"
)


def read_conversations(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """Digests of each conversation, from its tokens and mask alone.

    A task streams over the turns of its conversations in order and keeps one turn.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = encoder(tokenizer, plain=True).tokenizer
        first = decoder.get_vocab_size()
        last, state = object(), None

        def text(ids: np.ndarray) -> str:
            return decoder.decode(ids.tolist(), skip_special_tokens=False)

        def closed(conv, s) -> tuple:
            return (conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4], s[5], s[6])

        for batch in batches:
            out = []
            for r, conv in zip(batch.itertuples(), batch["conv_id"].astype("Int64").tolist()):
                conv = None if conv is pd.NA else conv
                if conv != last:
                    if state is not None:
                        out.append(closed(last, state))
                    last, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                ids = np.frombuffer(r.ids, "<u4")
                marks = np.flatnonzero(ids >= first)
                if ids[marks].tolist() != [first, first + 1, first + 2] or r.start != state[5]:
                    raise ValueError(f"conversation {conv} is not well formed")
                role, body = text(ids[1 : marks[1]]), text(ids[marks[1] + 1 : marks[2]])
                under = unescape(text(ids[r.loss_from - r.start : r.loss_to - r.start]))
                state[0] += 1
                state[1].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                state[2] += len(under)
                state[3].update(under.encode())
                state[4] += sum(map(len, MARKS)) + len(role) + len(body)
                state[5] += len(ids)
                state[6] += r.loss_to - r.loss_from
            if out:
                yield _digest_frame(out)
        if state is not None:
            yield _digest_frame([closed(last, state)])

    return (
        formatted.repartition("conv_id").sortWithinPartitions("conv_id", "start").mapInPandas(run, DIGESTS)
    )


def _digest_frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in DIGESTS.split(", ")])
    return frame.assign(conv_id=frame["conv_id"].astype("Int64"))
