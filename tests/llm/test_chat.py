"""Chat formatting: escapes, masks and the round trip."""

import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, strategies as st

from cartwright.llm import chat

BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, shard int, ids string, h long, base long"
PIECES = st.sampled_from([*chat.CONTROL_STRINGS, "\\", "<", "[", "s>", "a", "\\\\", "|end|>", "/INST]"])


@given(st.lists(PIECES, max_size=12).map("".join))
def test_escape_is_reversible_and_hides_control_strings(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(x in hidden for x in chat.CONTROL_STRINGS)


def test_round_trip(spark):
    both = "</s>[INST] ok [/INST]"
    rows = [
        (1, 2, "assistant", "second \\ <|end|> 漢字"),
        (1, 1, "user", None),
        (1, 3, "assistant", "third"),
        (2, 0, None, "no role"),
        (-7, 0, "user", both),
        (-7, 1, "assistant", both),
        (None, 1, "assistant", ""),
        (None, None, "user", "null turn"),
        (3, 1, "assistant", "same"),
        (3, 1, "assistant", "same"),
        (4, 1, "user", "long " * 20000),
        *((5, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(300)),
    ]
    turns = spark.createDataFrame([(*r, 9, "x", 1, 2) for r in rows], SCHEMA).repartition(5)
    formatted = chat.format_turns(turns, BPE)
    found = {r.conv_id: r for r in chat.read_conversations(formatted, BPE).collect()}
    assert set(found) == {r[0] for r in rows}
    for conv, r in found.items():
        mine = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1]))
        turns_text = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in mine)
        loss = "".join(x[3] or "" for x in mine if x[2] == "assistant")
        assert r.n_turns == len(mine)
        assert r.turns_sha256 == hashlib.sha256(turns_text.encode()).hexdigest()
        assert r.loss_chars == len(loss)
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        marks = sum(map(len, chat.MARKS))
        texts = sum(len(chat.escape(x[2] or "")) + len(chat.escape(x[3] or "")) for x in mine)
        assert r.formatted_chars == marks * len(mine) + texts
    # Starts are prefix sums and no reserved id comes from a text.
    at = 0
    for r in sorted((r for r in formatted.collect() if r.conv_id == 5), key=lambda r: r.start):
        ids = np.frombuffer(r.ids, "<u4")
        assert r.start == at and (ids >= 50257).sum() == 3
        at += len(ids)


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.read_conversations(chat.format_turns(empty, BPE), BPE).count() == 0
