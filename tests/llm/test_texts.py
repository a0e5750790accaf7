"""Page text, quality and secrets."""

import re
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cartwright.llm import html_blocks, quality, secrets
from cartwright.llm.html_layouts import layouts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# ---- pages ------------------------------------------------------------------------


def test_blocks_of_broken_markup():
    texts = lambda page: [b.text for b in html_blocks.leaf_blocks(page)]
    assert texts(None) == texts("") == texts("<div></div>") == []
    assert texts("<p>a&amp;b&nbsp; c<br>d<p><b>e<i>f</b>g") == ["a&b c d", "efg"]
    assert texts("x<!-- no <p>y") == ["x"]
    assert texts("a<script>var t='</p>';</script>b") == ["ab"]
    assert texts("a<style>p{}") == ["a"]
    assert texts('<a title="x > y">k</a> < 3 <p class=\'"q\'>z') == ["k < 3", "z"]
    assert texts("<p" * 2000) == []
    assert texts("<div>" * 3000 + "deep") == ["deep"]
    assert texts("<p>Sum <math><mi>x</mi><mo>+</mo></math> end</p>") == ["Sum x+ end"]


def test_deep_and_unclosed_markup_takes_linear_time():
    started = time.monotonic()
    deep = html_blocks.leaf_blocks("".join(f"<div class=c{i % 7}>x{i} " for i in range(100_000)))
    assert [b.text for b in deep] == [f"x{i}" for i in range(100_000)]
    assert deep[-1].depth == 100_000 and deep[2].path == ("div c0", "div c1", "div c2")
    assert len(html_blocks.leaf_blocks("<b>x</i><hr>" * 100_000)) == 100_000
    assert len(html_blocks.leaf_blocks("<a>x" * 100_000 + "<p>y")) == 2
    assert html_blocks.leaf_blocks("<!" * 100_000) == []
    model = html_blocks.Labeller()
    assert len(model.content([deep])[0]) == 100_000
    assert time.monotonic() - started < 120


def test_path_sums_equal_means():
    blocks = html_blocks.leaf_blocks("a<div id='m n'><p>b<p class=q>c</div>d<ul><li><a>e</a><li>f")
    model = html_blocks.Labeller()
    x = model.inputs(model.ids(blocks))
    for row, b in zip(x, blocks, strict=True):
        ids = [i for label in b.path for i in html_blocks._element_ids(label)] or [0]
        assert np.allclose(row[: html_blocks.EMBED], model.p["paths"][ids].mean(0), atol=1e-6)


def test_labels_on_other_layouts():
    model = html_blocks.trained_labeller()
    pages = [html_blocks.leaf_blocks(p) for p in layouts(200, seed=77)]
    wrong = total = 0
    for blocks, keep in zip(pages, model.content(pages)):
        wrong += sum(b.marked != bool(k) for b, k in zip(blocks, keep))
        total += len(blocks)
    assert wrong < 0.01 * total


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = {r.page_id: r.text for r in html_blocks.extract_text(pages).collect()}
    assert len(found) == pages.count()
    right = 0
    for r in pages.collect():
        inside = [b.text for b in html_blocks.leaf_blocks(r.html) if "article" in b.path]
        right += found[r.page_id] == "\n".join(inside)
    assert right >= 0.99 * len(found)


def test_page_rows(spark):
    html = "<nav><a href=/>Home</a></nav><article><h1>T</h1><p>A long sentence here.</p></article>"
    rows = [(1, html), (1, html), (None, None), (3, ""), (4, "<p>" + "word " * 30000)]
    frame = spark.createDataFrame([(*r, "old", 1) for r in rows], "page_id long, html string, text string, path int")
    out = html_blocks.extract_text(frame).collect()
    texts = [(r.page_id, r.text[:30]) for r in out]
    assert texts[0] == texts[1] == (1, "T\nA long sentence here.")
    assert texts[2] == (None, "") and texts[3] == (3, "")
    assert html_blocks.extract_text(frame.limit(0)).count() == 0


# ---- quality ----------------------------------------------------------------------


def test_chunks_cover_the_text():
    for n in (0, 1, 511, 512, 513, 896, 897, 5000):
        chunks = quality.chunked("x" * n)
        covered = set()
        for i, c in enumerate(chunks):
            covered |= {i * quality.STEP + k for k in np.flatnonzero(c)}
        assert covered == set(range(n)) and len(chunks) >= 1


def test_gradients():
    net = quality.ByteNetwork()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    docs = [quality.chunked("some text " * 90), quality.chunked("OTHER! " * 10)]
    chunks, starts, y = np.vstack(docs), np.array([0, len(docs[0])]), np.array([1.0, 0.0])

    def loss():
        hidden = net.describe(chunks)
        z = net._documents(hidden, starts) @ net.p["out"] + net.p["out_bias"]
        return float(np.mean(np.log1p(np.exp(-(2 * y - 1) * z))))

    g = net.gradients(chunks, starts, y)
    for name, index in (("out", 3), ("mix", (2, 5)), ("filters", (7, 1)), ("embed", (ord("e"), 2))):
        keep, step = net.p[name][index], 1e-3
        net.p[name][index] = keep + step
        up = loss()
        net.p[name][index] = keep - step
        down = loss()
        net.p[name][index] = keep
        assert g[name][index] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-4)


def test_held_out_accuracy_and_rows(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").withColumn("label", F.lit("x"))
    labels = spark.read.parquet(f"{d}/labels.parquet")
    model = quality.train_on(docs, labels)
    scored = docs.select("doc_id", quality.quality_score(F.col("text"), model).alias("score"))
    rows = scored.join(labels, "doc_id").where(quality.held_out(F.col("doc_id"))).collect()
    right = np.mean([(r.score >= 0.5) == (r.quality == 1) for r in rows])
    assert right >= 0.9
    edge = spark.createDataFrame([(None,), ("",), ("word " * 40000,)], "text string")
    scores = [r[0] for r in edge.select(quality.quality_score(F.col("text"), model)).collect()]
    assert scores[0] == scores[1] and all(0 <= s <= 1 for s in scores)
    assert edge.limit(0).select(quality.quality_score(F.col("text"), model)).count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (3, "b")], "doc_id long, text string")
    one = spark.createDataFrame([(1, 1), (3, 1), (None, 0), (1, None)], "doc_id long, quality int")
    assert quality.train_on(docs, one.limit(0)).scores(["x"]).tolist() == [0.5]
    assert quality.train_on(docs, one).scores(["x", ""]).tolist() == [1.0, 1.0]


# ---- secrets ----------------------------------------------------------------------


def spans(text):
    return secrets.scanner(RANKS, 2.0).spans(text)


def test_base_patterns():
    text = "é Password: \"abcdef\" api_key=12345 APIKEY = 'abc.def_1' AKIA" + "A1" * 8 + " " + "0a" * 12 + " deadbeef"
    found = [(k, text[a:b]) for k, a, b in spans(text)]
    assert found == [
        ("assign", 'Password: "abcdef'),
        ("assign", "APIKEY = 'abc.def_1"),
        ("access", "AKIA" + "A1" * 8),
        ("hex", "0a" * 12),
    ]


def test_base_equals_plain_patterns():
    r = np.random.default_rng(1)
    parts = ["token=", "secret: '", "AKIA", "abcdef0123", "Z9", " ", '"', "pass", "password", "K", "ſecret=abcdefg", "0f" * 13]
    for _ in range(300):
        text = "".join(r.choice(parts, 12))
        expected = []
        for m in re.finditer(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
            expected += [(m.start(), 0, m.end())] if len(m[2]) >= 6 else []
        expected += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        expected += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert secrets.scanner(RANKS, 2.0).base(text) == sorted(expected)


def test_token_efficiency():
    random = "qX7zR2vK9pLm4TnW8sBd3FhJ"
    assert spans(f"see {random}.") == [("random", 4, 4 + len(random))]
    for known in (
        "internationalization_of_applications",
        "SomeVeryLongClassNameForTheFactory",
        "123e4567-E89B-12d3-a456-426614174000",
        "D41D8CD98F00B204E9800998ECF8427E",
        "2024-01-02/03/04/2024-01-02",
        "thisisaverylongwordwithoutanyspaces",
    ):
        assert spans(f"see {known}.") == [], known


def test_letters_of_one_case_and_parts_are_tested():
    r = np.random.default_rng(5)
    low, up = ("".join(r.choice(list(a), 32)) for a in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    assert spans(f"key {low} and {up}") == [("random", 4, 36), ("random", 41, 73)]
    path = f"documents/directory/configuration/{low}/information/description/"
    at = path.index(low)
    assert ("random", at, at + 32) in spans(path) or spans(path) == [("random", 0, len(path))]
    assert spans("internationalizationcommunications documents/configuration/information_management") == []
    assert spans("0" * 60 + " " + "1234567890" * 4) == [("hex", 0, 60), ("hex", 61, 101)]


def test_secret_rows_and_redaction(spark):
    rows = [(1, "x token=abcdefgh y"), (1, "x token=abcdefgh y"), (None, None), (2, ""), (3, "a " * 50000 + "0f" * 20)]
    docs = spark.createDataFrame([(*r, "old") for r in rows], "doc_id long, text string, secret_spans string")
    found = secrets.find_secrets(docs, RANKS)
    out = found.select("text", "secret_spans", secrets.redacted(F.col("text"), F.col("secret_spans")).alias("clean")).collect()
    assert out[0].clean == out[1].clean == "x [SECRET] y"
    assert out[2].clean is None and out[2].secret_spans == [] and out[3].clean == ""
    assert out[4].clean == "a " * 50000 + "[SECRET]"
    assert secrets.find_secrets(docs.limit(0), RANKS).count() == 0
    # Overlapping spans are one replacement.
    text = "token=" + "0f" * 20
    both = spark.createDataFrame([(text,)], "text string")
    assert secrets.find_secrets(both, RANKS).select(secrets.redacted(F.col("text"), F.col("secret_spans"))).head()[0] == "[SECRET]"
