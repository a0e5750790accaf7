"""Components, near-duplicates, leaks and repeated strings against brute force."""

import dataclasses
import os
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from cartwright.llm import decontaminate, embed_dedup, similar, simhash, suffix_dedup
from cartwright.llm.components import connected_components


def united(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ---- components -------------------------------------------------------------------


def test_components(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(100, 140)]  # a chain
    links += [(200, 200 + i) for i in range(1, 60)] + [(1, 259)]  # a star with a tail
    links += [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)]
    links += [(5, 5), (7, 6), (7, 6)]
    edges = spark.createDataFrame([*links, (None, 3), (3, None)], "a long, b long").repartition(4)
    found = {x.node: x.component for x in connected_components(edges).collect()}
    assert found == united({n for e in links for n in e}, links)
    assert connected_components(edges.limit(0)).count() == 0


# ---- SimHash ----------------------------------------------------------------------


def plain_fingerprint(text, size):
    words = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    if len(words) < size:
        shingles = [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    assert simhash.fingerprint(simhash.shingle_hashes(None, 4)) == bytes(8)
    for text in ("A b", "a b c d", "É é Z z  x\ty\nq " * 200, "w " * 700, "  a b c"):
        found = int.from_bytes(simhash.fingerprint(simhash.shingle_hashes(text, 4)), "little")
        assert found == plain_fingerprint(text, 4)


def test_ball_links_find_every_near_pair(spark):
    r = random.Random(5)
    seeds = [r.getrandbits(64) for _ in range(30)]
    prints = {0}
    for s in seeds:
        prints.add(s)
        for flips in (1, 2, 3, 4, 5, 6):
            prints.add(s ^ sum(1 << b for b in r.sample(range(64), flips)))
    prints |= {1 << i for i in range(40)}  # all two apart, a hub in the middle
    prints = sorted(prints)
    rows = [(i, bytearray(p.to_bytes(8, "little"))) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "node long, prints binary").repartition(3)
    links = [(x.a, x.b) for x in simhash.ball_links(nodes, simhash.FOUR_SHINGLES).collect()]
    near = [
        (a, b)
        for a in range(len(prints))
        for b in range(a)
        if (prints[a] ^ prints[b]).bit_count() <= 4
    ]
    # Links stand for components of chunks, so components are what must agree.
    assert united(range(len(prints)), links) == united(range(len(prints)), near)


def test_simhash_rows(spark):
    long = "word " * 30000
    rows = [(4, "a b c"), (9, "a b c"), (9, "a b c"), (None, "a b c"), (2, None), (3, " "), (None, "only null"), (1, long), (8, long)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, node int, prints string")
    out = simhash.near_duplicates(docs, simhash.FOUR_SHINGLES).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in out) == sorted(
        [("4", "4"), ("9", "4"), ("9", "4"), ("None", "4"), ("2", "2"), ("3", "2"), ("None", "None"), ("1", "1"), ("8", "1")]
    )
    assert simhash.near_duplicates(docs.limit(0), simhash.FOUR_SHINGLES).count() == 0


def test_five_shingles_find_near_copies(spark):
    r = random.Random(8)
    vocabulary = ["".join(r.choices("abcdefghij", k=6)) for _ in range(5000)]
    texts = {}
    for i in range(60):
        words = r.choices(vocabulary, k=400)
        texts[2 * i] = " ".join(words)
        for _ in range(6):  # J of about 0.86
            words[r.randrange(400)] = r.choice(vocabulary)
        texts[2 * i + 1] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = simhash.near_duplicates(docs, simhash.FIVE_SHINGLES).collect()
    found = {x.doc_id: x.component_id for x in out}
    assert sum(found[2 * i + 1] == 2 * i for i in range(60)) >= 57
    assert len(set(found.values())) >= 60


def jaccard(a, b, size=5):
    a, b = ({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def test_similar_documents_at_the_threshold(spark):
    r = random.Random(21)
    vocabulary = ["".join(r.choices("abcdefghij", k=6)) for _ in range(5000)]
    texts, expected = {}, {}
    for i in range(600):
        words = r.choices(vocabulary, k=300)
        texts[2 * i] = " ".join(words)
        for _ in range(r.randrange(3, 11)):  # J from about 0.70 to 0.90
            words[r.randrange(300)] = r.choice(vocabulary)
        texts[2 * i + 1] = " ".join(words)
        expected[i] = jaccard(texts[2 * i], texts[2 * i + 1])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = {x.doc_id: x.component_id for x in similar.similar_documents(docs).collect()}
    linked = {i for i in expected if found[2 * i + 1] == 2 * i}
    near = {i for i, j in expected.items() if j >= 0.8}
    assert sum(0.7 <= j < 0.8 for j in expected.values()) > 100 < len(near)
    assert linked <= near and len(linked) >= 0.97 * len(near)
    assert all(found[2 * i] == 2 * i for i in expected)


def test_similar_documents_hold_families_and_odd_rows(spark):
    r = random.Random(22)
    vocabulary = ["".join(r.choices("abcdefghij", k=6)) for _ in range(5000)]
    words = r.choices(vocabulary, k=300)
    line = " ".join(r.choices(vocabulary, k=12))
    rows = [(100, None), (101, ""), (102, " \t"), (103, "a b"), (104, "A b"), (105, "a b c"), (106, "word " * 30000)]
    rows += [(107, "word " * 20000), (108, (line + " ") * 50 + " ".join(words)), (109, (line + " ") * 50)]
    for i in range(120):  # copies of one text, some of them equal, in a chain of J >= 0.8 or not
        changed = list(words)
        for _ in range(r.randrange(0, 7)):
            changed[r.randrange(300)] = r.choice(vocabulary)
        rows.append((1000 + i, " ".join(changed)))
    docs = spark.createDataFrame([(*x, 1, "x") for x in rows], "doc_id long, text string, node int, same string")
    found = {x.doc_id: x.component_id for x in similar.similar_documents(docs.repartition(4)).collect()}
    family = [x for x in rows if x[0] >= 1000]
    pairs = [(i, j) for i in range(120) for j in range(i) if jaccard(family[i][1], family[j][1]) >= 0.8]
    parts = united(range(120), pairs)
    got = [found[1000 + i] for i in range(120)]
    assert sum((parts[i] == parts[j]) == (got[i] == got[j]) for i in range(120) for j in range(i)) >= 0.98 * 7140
    assert [found[i] for i in range(100, 110)] == [100, 100, 100, 103, 103, 105, 106, 106, 108, 109]
    assert similar.similar_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [similar.BLOCK, 40])
def test_crossing_pairs_are_all_pairs_of_different_parts(spark, monkeypatch, block):
    scheme = simhash.Scheme(shingle=5, tables=4, bits=32, radius=2, limit=14, sure=3, tries=1)
    monkeypatch.setattr(simhash, "CHUNK_VARIANTS", 20 * 4 * 33)  # some ten chunks
    r = random.Random(41)
    seed, prints = r.getrandbits(128), []
    for i in range(220):  # one family, pairs of neighbours, and strangers
        start = seed if i < 120 else prints[-1] if i % 2 else r.getrandbits(128)
        prints.append(start ^ sum(1 << b for b in r.sample(range(128), r.randrange(0, 9))))
    prints = sorted(set(prints))
    parts = {i: i if r.random() < 0.2 else r.randrange(3) for i in range(len(prints))}
    parts = {i: min(j for j in parts if parts[j] == p) for i, p in parts.items()}
    rows = [(i, bytearray(p.to_bytes(16, "little"))) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "node long, prints binary").repartition(3)
    named = [(i, p) for i, p in parts.items() if sum(q == p for q in parts.values()) > 1]
    told = simhash.meetings(nodes, scheme)
    assert told.ball.n_chunks > 5
    out = similar.crossing_pairs(told, spark.createDataFrame(named, "node long, component long"), block)

    def meet(a, b):
        apart = prints[a] ^ prints[b]
        return apart.bit_count() <= 14 and any((apart >> 32 * t & 0xFFFFFFFF).bit_count() <= 2 for t in range(4))

    pairs = [(a, b) for b in range(len(prints)) for a in range(b) if parts[a] != parts[b] and meet(a, b)]
    assert len(pairs) > 1000
    assert sorted(tuple(x) for x in out.collect()) == sorted((a, b, parts[a], parts[b]) for a, b in pairs)


@pytest.mark.parametrize("members", [300, 600])
def test_buckets_give_a_pair_of_a_family_once(spark, monkeypatch, members):
    # Two chunks, so buckets compare all pairs a second time: copies share many variants.
    r = random.Random(47)
    seed = r.getrandbits(1024)
    prints = [seed ^ sum(1 << b for b in r.sample(range(1024), 60)) for _ in range(members)]
    rows = [(i, bytearray(p.to_bytes(128, "little"))) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "node long, prints binary")
    monkeypatch.setattr(simhash, "CHUNK_VARIANTS", members // 2 * 32 * 33)
    told = simhash.meetings(nodes, simhash.FIVE_SHINGLES)
    assert told.ball.n_chunks == 2
    given_ = Counter((x.a, x.b) for x in simhash.chunk_links(told, partners=True).collect())
    assert len(given_) >= members - 1
    assert max(given_.values()) <= 2  # by a chunk and by a bucket


def test_similar_documents_lose_no_link_of_a_dense_family(spark, monkeypatch):
    # With one partner tried and one forest kept, the second pass must find the rest.
    monkeypatch.setattr(simhash, "CHUNK_VARIANTS", 40 * 32 * 33)
    r = random.Random(43)
    vocabulary = ["".join(r.choices("abcdefghij", k=6)) for _ in range(5000)]
    words = r.choices(vocabulary, k=300)
    texts = []
    for _ in range(300):  # most pairs lie near the threshold, on either side
        changed = list(words)
        for _ in range(r.randrange(2, 7)):
            changed[r.randrange(300)] = r.choice(vocabulary)
        texts.append(" ".join(changed))
    scheme = dataclasses.replace(simhash.FIVE_SHINGLES, tries=1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    found = {x.doc_id: x.component_id for x in similar.similar_documents(docs, scheme).collect()}
    sets = [np.unique(simhash.shingle_hashes(t, 5)) for t in texts]
    tables = np.array([np.frombuffer(simhash.fingerprint(x, 16), "<u4") for x in sets])
    links = []
    for b in range(300):
        for a in range(b):
            bits = np.bitwise_count(tables[a] ^ tables[b])
            if jaccard(texts[a], texts[b]) >= 0.8 and bits.sum() <= scheme.limit and bits.min() <= 2:
                links.append((a, b))
    assert found == united(range(300), links)


# ---- embeddings -------------------------------------------------------------------


def test_embeddings(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal((40, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (v + 0.03 * r.standard_normal(32)).tolist()) for i, v in enumerate(base)]
    hot = r.standard_normal(32)
    rows += [(1000 + i, (hot + 0.1 * r.standard_normal(32)).tolist()) for i in range(300)]
    rows += [(2000, hot.tolist()), (2001, hot.tolist()), (2001, (3 * hot).tolist())]
    odd = [(3000, None), (3001, [0.0] * 32), (3002, [float("nan")] * 32), (3003, [1.0]), (None, [float("inf")] * 32), (3004, [None] * 32), (3005, [])]
    frame = spark.createDataFrame([(*x, "l", 1) for x in rows + odd], "vec_id long, embedding array<double>, data string, node int")
    setup = embed_dedup.Passes(window=16, tile=64)
    out = embed_dedup.near_duplicates(frame.repartition(4), setup).collect()
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    parts = united(range(len(rows)), np.argwhere(linked).tolist())
    names = {}
    for k, part in parts.items():
        names[part] = min(names.get(part, 10**9), rows[k][0])
    expected = sorted((rows[k][0], int(linked[k].sum()), names[parts[k]]) for k in range(len(rows)))
    got = sorted((o.vec_id, o.n_links, o.component_id) for o in out if o.vec_id is not None and o.vec_id < 3000)
    assert got == expected
    assert sorted(str((o.vec_id, o.n_links, o.component_id)) for o in out if o.vec_id is None or o.vec_id >= 3000) == sorted(
        str((i, 0, i)) for i, _ in odd
    )
    assert embed_dedup.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("mutual", [None, 0.8, 0.9])
def test_isolated_pairs_in_a_dense_cluster(spark, mutual):
    r = np.random.default_rng(11)
    n, pairs = 6000, 150

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    x = unit(r.standard_normal((n, 64)))
    if mutual:
        centre = unit(r.standard_normal(64))
        inside = r.standard_normal((n // 2, 64))
        inside = unit(inside - (inside @ centre)[:, None] * centre)
        x[: n // 2] = mutual**0.5 * centre + (1 - mutual) ** 0.5 * inside
    # A mate of cosine 0.955 for some, within the cluster where there is one.
    base = x[:pairs]
    if mutual:
        rest = unit(base - (base @ centre)[:, None] * centre)
        away = r.standard_normal((pairs, 64))
        away -= (away @ centre)[:, None] * centre
        away = unit(away - (away * rest).sum(1, keepdims=True) * rest)
        cos = (0.955 - mutual) / (1 - mutual)
        mates = mutual**0.5 * centre + (1 - mutual) ** 0.5 * (cos * rest + (1 - cos**2) ** 0.5 * away)
    else:
        away = r.standard_normal((pairs, 64))
        away = unit(away - (away * base).sum(1, keepdims=True) * base)
        mates = 0.955 * base + (1 - 0.955**2) ** 0.5 * away
    every = np.concatenate([x, mates])
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(every)), "embedding": every.tolist()}))
    out = embed_dedup.near_duplicates(frame.repartition(4), embed_dedup.Passes(window=16)).toPandas()
    linked = every @ every.T >= 0.95
    np.fill_diagonal(linked, False)
    found = out.sort_values("vec_id")["n_links"].to_numpy()
    lost = int((found != linked.sum(1)).sum())
    assert lost <= 0.005 * len(every[linked.any(1)]), lost


# ---- leaks ------------------------------------------------------------------------

COMMON = "the of and to in is that it was for on with as be at by this had not".split()


def sentence(r, n):
    words = [r.choice(COMMON) if r.random() < 0.4 else "".join(r.choices("abcdefghklmnor", k=7)) for _ in range(n)]
    return " ".join(words).capitalize() + "."


@pytest.fixture(scope="module")
def leak_case(spark):
    r = random.Random(4)
    items = [(i, f"{sentence(r, 20)} {sentence(r, 9)}") for i in range(20)] + [(50, None), (51, " ")]
    docs = []
    for i in range(300):
        docs.append((i, " ".join(sentence(r, 12) for _ in range(r.randrange(1, 30)))))
    expected = set()
    for i in range(40):  # whole, in upper case with other marks, anywhere
        item = items[i % 20][1]
        item = item.upper().replace(".", " !") if i % 2 else item
        docs.append((1000 + i, f"{sentence(r, r.randrange(1, 90))} {item} {sentence(r, r.randrange(1, 90))}"))
        expected.add((1000 + i, i % 20))
    for i in range(20):  # paraphrase: some words of the question replaced, answer kept
        question, answer = items[i][1].split(". ")
        words = question.split()
        for k in range(1, len(words), 6):
            words[k] = "other"
        docs.append((2000 + i, f"{sentence(r, 50)} {' '.join(words)}. {answer} {sentence(r, 50)}"))
        expected.add((2000 + i, i))
    return items, docs, expected


def test_leaks(spark, leak_case):
    items, docs, expected = leak_case
    rows = docs + [(3000, None), (3001, ""), (None, items[3][1]), (1000, docs[300][1])]
    frame = spark.createDataFrame([(*d, "x", 1) for d in rows], "doc_id long, text string, ids string, word int")
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    found = decontaminate.find_leaks(frame.repartition(4), bench).collect()
    assert {(f.doc_id, f.item_id) for f in found} == expected | {(None, 3)}
    assert len(found) == len(expected) + 2  # the repeated row is reported twice
    blocks = decontaminate.Limits(items_at_once=7)
    again = decontaminate.find_leaks(frame, bench, blocks).collect()
    assert {(f.doc_id, f.item_id) for f in again} == expected | {(None, 3)}


def test_leaks_of_nothing(spark, leak_case):
    items, docs, _ = leak_case
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.find_leaks(frame.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(frame, bench.limit(0)).count() == 0


def test_short_items_among_words_of_a_full_block(spark):
    r = random.Random(9)
    vocabulary = ["".join(r.choices("abcdefghklmnor", k=7)) for _ in range(1500)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice((4, 18, 60)))) + ".") for i in range(400)]
    docs = []
    for i, text in items:  # each whole, between other words of the benchmark
        for k in range(2):
            around = [" ".join(r.choices(vocabulary, k=r.randrange(40, 90))) for _ in range(2)]
            docs.append((10 * i + k, f"{around[0]} {text} {around[1]}"))
    docs += [(100_000 + i, " ".join(r.choices(vocabulary, k=200))) for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(f.doc_id, f.item_id) for f in decontaminate.find_leaks(frame, bench).collect()}
    assert found == {(10 * i + k, i) for i in range(400) for k in range(2)}


def test_answers_of_common_words_and_of_later_places():
    weighs = np.array([True] * 20 + [False] * 3 + [True] * 40)
    question = list(range(10))
    near = [*question[:7], 50, 51, 52]
    limits = decontaminate.Limits()
    common = decontaminate.Item(1, [*question, 20, 21], [20, 21], question, [])
    assert decontaminate._checked(common, np.array([*near, 20, 21]), 0, {0: 0.5}, weighs, limits)[3] == 1
    assert decontaminate._checked(common, np.array([*near, 22, 21]), 0, {0: 0.5}, weighs, limits) is None
    # The same share twice, the answer only at the second place.
    item = decontaminate.Item(1, [*question, 10], [10], [*question, 10], [10])
    doc = np.array([*near, *[40] * 310, *near[:6], 10])
    found = decontaminate._checked(item, doc, 0, {0: 0.5, 9: 0.5}, weighs, limits)
    assert found[0] == 9 * decontaminate.HALF and found[3] == 1


@given(st.lists(st.integers(0, 4), min_size=1, max_size=12), st.lists(st.integers(0, 4), max_size=20))
def test_common_subsequence(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    assert decontaminate.common_subsequence(a, b) == best[-1][-1]


# ---- repeated strings -------------------------------------------------------------


@settings(deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6), max_size=12).map(sorted), min_size=1, max_size=9))
def test_loser_tree(streams):
    coded = []
    for items in streams:
        shared = [len(os.path.commonprefix(p)) for p in zip(items, items[1:])]
        coded.append(iter(zip(items, [0, *shared])))
    out = list(suffix_dedup.LoserTree(coded))
    values = [v for _, v, _ in out]
    assert values == sorted(x for items in streams for x in items)
    for (_, before, _), (_, value, shared) in zip(out, out[1:]):
        assert shared == len(os.path.commonprefix([before, value]))


@given(st.lists(st.binary(min_size=1, max_size=9), min_size=1, max_size=20).map(sorted))
def test_front_code(items):
    shared, rests, rest = suffix_dedup.front_code(items)
    decoded = suffix_dedup.decode_front(shared.tobytes(), rests.tobytes(), rest)
    assert [x for x, _ in decoded] == items


def plain_removal(rows):
    """What stays of each text, given in order."""
    seen, out = set(), []
    for data in rows:
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            if (w := data[i : i + 100]) in seen:
                gone[i : i + 100] = True
            seen.add(w)
        out.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
    return out


@pytest.mark.parametrize("setup", [suffix_dedup.Setup(), suffix_dedup.Setup(run_bytes=3000, hot=2)])
def test_repeats(spark, setup):
    r = random.Random(6)
    word = lambda n: "".join(r.choices("abcdefgh éü", k=n))
    passages = [word(n) for n in (99, 100, 101, 150, 400, 90)]
    rows = [(i, word(r.randrange(0, 300)) + r.choice(passages) + word(r.randrange(0, 90))) for i in range(120)]
    rows += [(200, "ab" * 700), (201, "ab" * 60 + "x" + "ab" * 60), (202, None), (203, ""), (204, "x" * 99)]
    rows += [(205, word(5000)), (206, passages[4][1:] + passages[3]), (-5, passages[2])]
    docs = spark.createDataFrame([(*x, 1, "x") for x in rows], "doc_id long, text string, run int, kept string")
    out = {x.doc_id: x for x in suffix_dedup.remove_repeats(docs.repartition(5), setup).collect()}
    ordered = sorted(rows)
    expected = plain_removal([(t or "").encode() for _, t in ordered])
    for (doc_id, text), kept in zip(ordered, expected):
        assert bytes(out[doc_id].kept) == kept, doc_id
        data = (text or "").encode()
        spans = [(s.start, s.end) for s in out[doc_id].removed]
        assert out[doc_id].n_bytes == len(data)
        assert sum(b - a for a, b in spans) == len(data) - len(kept)
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_bytes_decide_where_hashes_of_a_run_agree():
    data = b"a" * 120 + b"b" * 120 + b"a" * 120 + b"b" * 120
    low = np.array([0, 120, 240, 360])
    same = np.zeros(4, np.uint64)
    found = suffix_dedup.Anchors(low, low, low + 20, same, same)
    assert suffix_dedup._fresh(found, data, 100).tolist() == [True, True, False, True]
    assert suffix_dedup._first_rows(np.array([[1, 2], [2, 1], [1, 2], [1, 3]], np.uint64)).tolist() == [True, True, False, True]


def test_repeated_rows_and_null_ids(spark):
    text = "".join(random.Random(1).choices("abcdefgh ", k=300))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (None, text)], "doc_id long, text string")
    out = suffix_dedup.remove_repeats(docs.repartition(3)).collect()
    assert sorted(len(x.kept) for x in out) == [0, 0, 0, 300]
    assert [x.doc_id for x in out if x.kept] == [None]
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0
