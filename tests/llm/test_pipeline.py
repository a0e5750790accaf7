"""The corpus pipeline, stage by stage, against plain versions."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cartwright.llm import decontaminate, quality, secrets

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(r, n):
    return " ".join("".join(r.choices("abcdefghij", k=r.randrange(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r = random.Random(12)
    item = prose(r, 40)
    rows = []
    for i in range(0, 240):
        good = i % 4 != 0
        text = prose(r, 120) if good else " ".join(f"{w}%%%" for w in prose(r, 120).split())
        rows.append((i, text))
    rows += [(300, rows[1][1]), (301, rows[1][1]), (302, prose(r, 60) + " " + item)]
    rows += [(303, prose(r, 90) + " token = 0123456789abcdef0123456789abcdef"), (304, prose(r, 5000)), (305, prose(r, 3))]
    rows += [(None, prose(r, 80)), (3, rows[3][1]), (306, None)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 4 != 0), 0) for i in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_stages(spark, tables):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == corpus_pipeline.COLUMNS
        docs.write.parquet(path := f"{folder}/{name.replace(' ', '-')}")
        docs = spark.read.parquet(path)
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert docs.count() == len(kept[name]) + (name == "quality classifier")  # id 3 twice
    first, second, third, last = kept.values()
    model = quality.train_on(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    scores = model.scores([t for _, t in rows])
    assert set(first) == {i for (i, _), s in zip(rows, scores) if s >= 0.5}
    assert {i for i in range(240) if i % 4} <= set(first)
    gone = set(first) - set(second)
    assert {300, 301} <= gone and 1 in second and 3 in second and len(gone) <= 2 + (306 in gone) + (305 in gone)
    assert set(second) - set(third) == {302}
    assert set(last) == set(third)
    assert last[303].text.endswith(" [SECRET]")
    assert last[303].n_chars == len(last[303].text)
    assert all(last[i].text == third[i].text for i in last if i != 303)


def test_run(spark, tables):
    folder, _ = tables
    out = corpus_pipeline.run(spark, folder).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{folder}/secret-scans").collect()
    lengths = {r.doc_id: len(tokenizer.encode(r.text or "").ids) + 1 for r in docs}
    found = {}
    for r in out:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == lengths
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in bins.values():
        starts = np.cumsum([0] + [n for _, n in sorted(placed)])
        assert [o for o, _ in sorted(placed)] == starts[:-1].tolist() and starts[-1] <= 2048


def test_empty_tables(spark, tmp_path):
    empty = {"documents": COLUMNS, "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for name, schema in empty.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_operators_are_those_of_the_pipeline():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None and decontaminate and secrets


def test_stages_send_texts_in_small_batches(spark, tables):
    """Every row comes, a few megabytes at a time."""
    folder, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    corpus_pipeline.redact_secrets(spark, docs, folder)

    def sizes(batches):
        for batch in batches:
            yield batch.iloc[:0].reindex([0]).assign(n=len(batch), size=batch["t"].str.len().sum())[["n", "size"]]

    texts = spark.range(0, 9_000, 1, 1).selectExpr("repeat('x', 2000) AS t")
    seen = texts.mapInPandas(sizes, "n long, size long").collect()
    assert sum(r.n for r in seen) == 9_000
    assert max(r["size"] for r in seen) < 6_000_000
