"""Ranked search against a plain loop over all documents, and against its SQL."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from cartwright.llm import queries, ranked
from workload.compare import connect, sorted_rows

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def terms_of(text):
    return TERM.findall((text or "").translate(UPPER))


def plain_search(docs, items, wanted):
    """docs: (id, text); items: texts. Per item the ranked (id, score)."""
    counts = [Counter(terms_of(text)) for _, text in docs]
    sizes = [sum(c.values()) for c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in counts for t in c)
    out = []
    for text in items:
        scored = []
        for (doc_id, _), c, size in zip(docs, counts, sizes, strict=True):
            score = 0
            for t in set(terms_of(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                m = 50 + 50 * size * n // total
                score += w * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0, doc_id))
        out.append([(d, -s) for s, _, _, d in sorted(scored, key=lambda x: x[:3])[:wanted]])
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZé0_\x00 .-漢İK\x7f\n", max_size=12))))
def test_terms(texts):
    terms, owners = ranked.split_terms(pa.array(texts, pa.string()))
    want = [(t, i) for i, text in enumerate(texts) for t in terms_of(text)]
    assert list(zip(terms.to_pylist(), owners.tolist(), strict=True)) == want


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 6), st.integers(1, 40))
def test_bounds_lose_nothing(seed, n_pairs, wanted):
    """All documents down to the last score that counts, ties included."""
    random = np.random.default_rng(seed)
    n_docs = int(random.integers(1, 120))
    pairs, full = [], np.zeros(n_docs, np.int64)
    for _ in range(n_pairs):
        lists = []
        for _ in range(random.integers(1, 3)):
            docs = np.flatnonzero(random.random(n_docs) < random.choice([0.02, 0.3, 1.0]))
            if len(docs):
                scale = int(random.choice([3, 50, 1000]))
                lists.append(ranked.Postings(docs, random.integers(1, scale, len(docs))))
                full[docs] += lists[-1].impacts
        if lists:
            pairs.append(ranked.join_pair(lists, wanted))
    docs, scores = ranked.best_of(pairs, n_docs, wanted)
    positive = np.sort(full[full > 0])[::-1]
    last = positive[min(wanted, len(positive)) - 1] if len(positive) else 1
    want = np.flatnonzero(full >= last)
    assert docs.tolist() == want.tolist() and scores.tolist() == full[want].tolist()


DOCS = [
    (1, "Apple pie, apple tart. The end"),
    (2, "THE apple_tree É é"),
    (2, "the the the"),
    (None, "pie"),
    (None, None),
    (4, ""),
    (5, " ... "),
    (6, "pie"),
    (7, "pie"),
    (8, "rare " + "the apple " * 30_000),
]
ITEMS = ["the apple pie", None, "", "RARE the pie", "unknown", "the apple pie"]
SCHEMA = "doc_id long, text string, shard int, term string, ids int, part int"


def run(spark, docs, items, wanted):
    frame = spark.createDataFrame([(*d, 1, "x", 2, 3) for d in docs], SCHEMA)
    queries_ = spark.createDataFrame(
        [(i // 2 if i else None, t, 7) for i, t in enumerate(items)],
        "item_id long, text string, number int",
    )
    found = ranked.search(ranked.build_index(frame.repartition(3)), queries_, wanted)
    return sorted(
        ((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=str
    )


@pytest.mark.parametrize("wanted", [1, 3, 50])
def test_odd_rows(spark, monkeypatch, wanted):
    monkeypatch.setattr(ranked, "BLOCK_ITEMS", 2)
    monkeypatch.setattr(ranked, "GROUP_TERMS", 20_000)
    monkeypatch.setattr(ranked, "SHARD_BYTES", 20)
    want = [
        (i // 2 if i else None, rank + 1, doc, score)
        for i, hits in enumerate(plain_search(DOCS, ITEMS, wanted))
        for rank, (doc, score) in enumerate(hits)
    ]
    assert run(spark, DOCS, ITEMS, wanted) == sorted(want, key=str)


def test_empty_tables(spark):
    assert run(spark, [], ITEMS, 5) == []
    assert run(spark, DOCS, [], 5) == []
    assert run(spark, [(1, None), (2, "-")], ITEMS, 5) == []


def test_query_and_its_sql(spark):
    df = queries.op12_pair_maxscore(spark, SF)
    got = sorted_rows(df.columns, df.collect())
    cursor = connect(SF).execute(queries.ORACLES["op12_pair_maxscore"])
    assert got == sorted_rows([c[0] for c in cursor.description], cursor.fetchall())
    assert len(got) > 1000
