"""The registered queries of the corpus operators against plain versions of their results."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from cartwright.llm import queries

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def rows_of(spark, name):
    return [r.asDict() for r in spark.read.parquet(f"{SF}/{name}.parquet").collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return sorted(rows_of(spark, "documents"), key=lambda r: r["doc_id"])


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def run(spark, name):
    return entry_points.queries()[name](spark, SF).collect()


def smallest_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_all_are_registered():
    found = entry_points.queries()
    for n in range(1, 14):
        assert len([q for q in found if q.startswith(f"op{n}_")]) == 1
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)
    assert set(queries.ORACLES) <= set(entry_points.oracle_sql())


def test_token_files(spark, docs, tokenizer):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in run(spark, "op1_token_files")}
    start = 0
    for d in docs:
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 2]
        assert got.pop(d["doc_id"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


class Article(HTMLParser):
    """Text inside article elements, blocks apart."""

    INLINE = {"b", "i", "a", "em", "span", "strong", "br"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag not in self.INLINE:
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if tag not in self.INLINE:
            self.blocks.append("")
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth > 0:
            self.blocks[-1] += data


def test_page_text(spark):
    pages = {r["page_id"]: r for r in rows_of(spark, "pages")}
    got = run(spark, "op2_block_labeller")
    assert len(got) == len(pages)
    right = 0
    for r in got:
        reader = Article()
        reader.feed(pages[r.page_id]["html"] or "")
        reader.close()
        text = "\n".join(filter(None, (" ".join(b.split()) for b in reader.blocks)))
        right += r.text == text
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id]["url"]
    assert right >= 0.98 * len(got)


def test_packing(spark, docs, tokenizer):
    got = run(spark, "op3_best_two_fit")
    pieces = defaultdict(dict)
    bins = defaultdict(list)
    for r in got:
        pieces[r.doc_id][r.piece] = r
        bins[r.sequence_id].append((r.offset, r.length))
    for d in docs:
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        mine, at = pieces.pop(d["doc_id"]), 0
        assert sorted(mine) == list(range(-(-len(ids) // 2048)))
        for k in sorted(mine):
            part = ids[at : at + mine[k].length]
            assert mine[k].start == at and mine[k].ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            at += mine[k].length
        assert at == len(ids)
    assert not pieces
    for parts in bins.values():
        parts.sort()
        ends = np.cumsum([n for _, n in parts])
        assert [o for o, _ in parts] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
    # Best-fit decreasing as the yardstick.
    rooms: list[int] = []
    for n in sorted((r.length for r in got), reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= n]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(2048 - n)
    assert len(bins) <= len(rooms) + 1


def leaked(docs, items):
    norm = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    texts = {d["doc_id"]: f" {norm(d['text'])} " for d in docs}
    return {(d, i["item_id"]) for i in items for d, t in texts.items() if f" {norm(i['text'])} " in t}


def test_leaks(spark, docs):
    planted = leaked(docs, rows_of(spark, "benchmark"))
    got = {(r.doc_id, r.item_id) for r in run(spark, "op4_latent_retrieval")}
    assert planted and planted <= got
    assert {d for d, _ in got} == {d for d, _ in planted}


def test_simhash(spark, docs):
    prints = {}
    for d in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (d["text"] or "").encode()))
        shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        votes = Counter(
            b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s, 42) >> b & 1
        )
        prints[d["doc_id"]] = sum(1 << b for b, n in votes.items() if 2 * n > len(shingles))
    ids = list(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    near = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 4)
    parts = smallest_reachable(ids, [(ids[a], ids[b]) for a, b in near])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, "op5_simhash_balls")}
    assert got == {i: (f"{prints[i]:016x}", parts[i]) for i in ids}


def test_chat(spark):
    turns = defaultdict(list)
    for r in rows_of(spark, "conversations"):
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    turns[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in run(spark, "op6_chat_format")}
    assert set(got) == set(turns)
    for conv, rows in turns.items():
        rows.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        loss = "".join(text for _, role, text in rows if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(rows), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars > len(whole) - 2 * len(rows)


def test_embeddings(spark):
    rows = rows_of(spark, "embeddings")
    vector = next(k for k, v in rows[0].items() if isinstance(v, list))
    sound = {}
    for r in rows:
        v = np.array([np.nan if x is None else x for x in r[vector] or [0]], float)
        if np.isfinite(v).all() and v.any():
            sound[r["vec_id"]] = v / np.linalg.norm(v)
    ids = list(sound)
    cosine = np.stack([sound[i] for i in ids]) @ np.stack([sound[i] for i in ids]).T
    near = [(ids[a], ids[b]) for a, b in np.argwhere(cosine >= 0.95) if a != b]
    links, parts = Counter(a for a, _ in near), smallest_reachable([r["vec_id"] for r in rows], near)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in run(spark, "op7_sorted_projections")}
    assert got == {i: (links[i], parts[i], parts[i] == i) for i in parts}


def test_quality(spark, docs):
    labels = {r["doc_id"]: r["quality"] for r in rows_of(spark, "labels")}
    got = run(spark, "op8_byte_network")
    assert sorted(r.doc_id for r in got) == [d["doc_id"] for d in docs]
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) >= 0.85


def test_repeated_strings(spark, docs):
    seen, covered = set(), {}
    for d in docs:
        data = (d["text"] or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            part = data[i : i + 100]
            if part in seen:
                gone[i : i + 100] = True
            seen.add(part)
        covered[d["doc_id"]] = (data, gone)
    for r in run(spark, "op9_suffix_runs"):
        data, gone = covered.pop(r.doc_id)
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(data), int(gone.sum()), spans)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert not covered


ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def test_secrets(spark, docs):
    texts = {d["doc_id"]: d["text"] or "" for d in docs}
    for r in run(spark, "op10_token_efficiency"):
        text = texts.pop(r.doc_id)
        base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        kinds = ("assign", "access", "hex")
        joined = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(base))
        counts = Counter(k for _, k, _ in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (counts[0], counts[1], counts[2])
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == joined.split(",") * bool(joined)
    assert not texts


def test_pipeline_returns_packed_pieces(spark):
    got = run(spark, "pipeline")
    bins = Counter()
    for r in got:
        bins[r.sequence_id] += r.length
    assert got and max(bins.values()) <= 2048
