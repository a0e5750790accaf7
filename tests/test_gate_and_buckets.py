"""Contracts at the door of a table, landed documents, and stores in buckets."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from cartwright import sinks, sources
from cartwright.operators.gate import ContractError
from cartwright.operators.keys import number_in_order
from cartwright.plans import jobs
from cartwright.schemas import USER, Contract
from cartwright.sinks import tables

CONTRACT = Contract(
    key="k", not_null=("k", "v"), max_length={"v": 3}, decimals={"n": (4, 2)}
)
SCHEMA = "k int, v string, n decimal(9,2)"
GOOD = [(1, "a", 1), (2, "b", 99), (3, None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(k, v, n) for k, v, n in rows], "k int, v string, n int").select(
        "k", "v", F.col("n").cast("decimal(9,2)").alias("n")
    )


def content(spark, name):
    return sorted(((r.k, r.v) for r in spark.table(name).collect()), key=str)


def test_a_broken_batch_changes_no_table(spark, tmp_path):
    name, root = "shop.gated", str(tmp_path)
    good = frame(spark, GOOD[:2])
    assert sinks.publish_table(good, name, root, contract=CONTRACT).columns == ["k", "v", "n"]
    rows = [(1, "x", 1), (1, "y", 1), (2, "long", 100), (None, "z", 1), (None, "w", 1), (4, "ok", 1)]
    with pytest.raises(ContractError) as refused:
        sinks.publish_table(frame(spark, rows), name, root, contract=CONTRACT)
    assert refused.value.violations == {
        "unique:k": 2, "max_length:v": 1, "range:n": 1, "not_null:k": 2,
    }
    listed = {(r.k, r.v): r.broken_rules for r in refused.value.rows.collect()}
    assert listed == {
        (1, "x"): ["unique:k"], (1, "y"): ["unique:k"], (2, "long"): ["max_length:v", "range:n"],
        (None, "z"): ["not_null:k"], (None, "w"): ["not_null:k"],
    }
    assert content(spark, name) == [(1, "a"), (2, "b")]
    assert spark.table(f"{name}_quarantine").count() == 5


def test_good_rows_pass_alone(spark, tmp_path):
    name, root = "shop.passed", str(tmp_path)
    sinks.publish_table(frame(spark, GOOD), name, root, contract=CONTRACT, keep_good=True)
    assert content(spark, name) == [(1, "a"), (2, "b")]
    assert spark.table(f"{name}_quarantine").collect()[0].broken_rules == ["not_null:v"]
    # In another format too, and nothing is refused twice.
    json_table = sinks.publish_table(frame(spark, GOOD[:2]), "shop.j", root, "json", CONTRACT)
    assert json_table.columns == ["k", "v", "n"] and json_table.count() == 2
    empty = sinks.publish_table(frame(spark, []), name, root, contract=CONTRACT)
    assert empty.count() == 0


def test_upsert_refuses_a_broken_batch(spark, tmp_path):
    name, root = "shop.up", str(tmp_path)
    assert sinks.upsert_table(frame(spark, GOOD[:2]), name, "k", root, "1998-01-01", contract=CONTRACT) == (2, 0)
    broken = frame(spark, [(2, "new", 1), (5, None, 1)])
    with pytest.raises(ContractError, match="not_null:v 1"):
        sinks.upsert_table(broken, name, "k", root, "1999-01-01", contract=CONTRACT)
    assert content(spark, name) == [(1, "a"), (2, "b")]
    twice = frame(spark, [(2, "x", 1), (2, "y", 2), (6, "z", 1)])
    assert sinks.upsert_table(twice, name, "k", root, "1999-01-01", ("n",), contract=CONTRACT) == (1, 2)
    assert content(spark, name) == [(1, "a"), (2, "y"), (6, "z")]


def test_a_small_batch_writes_its_buckets_only(spark, tmp_path):
    name, root = "shop.wide", str(tmp_path)
    rows = spark.range(5_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    assert sinks.upsert_table(rows, name, "k", root, "1998-01-01", buckets=100) == (5_000, 0)
    before = {r.partition: r.path for r in _locations(spark, name)}
    reader = spark.table(name).where("k < 10").select("k", "v")
    batch = rows.where("k in (7, 8, 4001)").withColumn("v", F.lit("new")).union(
        spark.createDataFrame([(9_999, "first")], "k long, v string")
    )
    assert sinks.upsert_table(batch, name, "k", root, "1999-01-01") == (1, 3)
    after = {r.partition: r.path for r in _locations(spark, name)}
    moved = {p for p in after if after[p] != before.get(p)}
    touched = {r.b for r in batch.select(tables.bucket_of("k", 100).alias("b")).collect()}
    assert moved == touched and len(moved) <= 4
    found = {r.k: (r.v, r.created_at, r.updated_at) for r in spark.table(name).collect()}
    old, new = dt.datetime(1998, 1, 1), dt.datetime(1999, 1, 1)
    assert len(found) == 5_001
    assert found[7] == ("new", old, new) and found[9_999] == ("first", new, new)
    assert found[6] == ("6", old, old)
    # A frame planned before still reads files that are there.
    assert reader.count() == 10
    assert sinks.upsert_table(batch.limit(0), name, "k", root, "2000-01-01") == (0, 0)


def _locations(spark, name):
    parts = spark.table(name).select("_bucket", F.input_file_name().alias("f")).distinct().collect()
    seen = {(r._bucket, r.f.rpartition("/")[0]) for r in parts}
    return spark.createDataFrame(sorted(seen), "partition int, path string").collect()


def test_documents_go_to_their_buckets(spark, tmp_path):
    name, root = "shop.docs_b", str(tmp_path)
    rows = spark.range(300).select("id", F.lit("a").alias("v"))
    assert sinks.write_documents(rows, ("id", "v"), "id", name, root, buckets=50) == 300
    before = {r.partition: r.path for r in _locations(spark, name)}
    again = rows.where("id = 5").withColumn("v", F.lit("b"))
    assert sinks.write_documents(again, ("id", "v"), "id", name, root) == 1
    after = {r.partition: r.path for r in _locations(spark, name)}
    assert sum(after[p] != before[p] for p in after) == 1
    docs = {r.doc_id: json.loads(r.doc)["v"] for r in spark.table(name).collect()}
    assert len(docs) == 300 and docs["5"] == "b" and docs["6"] == "a"


def test_broken_documents_are_set_aside_and_counted(spark, tmp_path):
    sound = [json.dumps({"id": i, "firstName": f"F{i}"}) for i in range(20)]
    broken = ['{"id": 1, "firstName": ', '{"id": "no number"}', "nonsense"]
    (tmp_path / "u.json").write_text("\n".join([*sound, *broken, '{"other": 1}', ""]))
    landed = sources.read_landed(spark, str(tmp_path / "u.json"), USER)
    assert landed.documents.schema == USER
    assert landed.documents.select("id").where("id is not null").count() == 20
    assert landed.broken_count() == 3
    assert landed.seen.get == {"rows": 24, "broken": 3, "blank": 1}
    assert sorted(r.document for r in landed.broken.collect()) == sorted(broken)
    # The same documents are broken when no field of theirs is asked for.
    again = sources.read_landed(spark, str(tmp_path / "u.json"), USER)
    assert again.documents.select("email").count() == 21 and again.broken_count() == 3


def test_numbers_in_order(spark):
    rows = [(i * 7919 % 1000, i) for i in range(3_000)] + [(None, -1)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(6)
    got = number_in_order(df, "a", "b").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert {r.number: (r.a, r.b) for r in got} == dict(enumerate(order))
    down = number_in_order(df.limit(9), F.desc("b"), name="place").collect()
    assert [r.b for r in sorted(down, key=lambda r: r.place)] == sorted((r.b for r in down), reverse=True)
    assert number_in_order(df.limit(0), "a").collect() == []


def test_figures_need_no_scan_of_their_own(spark, tmp_path):
    users = [{"id": i, "firstName": f"F{i}", "email": f"u{i}@x.y"} for i in range(1, 6)]
    (tmp_path / "users.json").write_text("\n".join(map(json.dumps, users)))
    cfg = jobs.JobConfig(
        root=str(tmp_path / "out"), as_of="1999-01-01", n_orders=40, namespace="run_s",
        seed_users=str(tmp_path / "users.json"),
    )
    store = spark._jsparkSession.sharedState().statusStore()
    first = store.executionsCount()
    done = jobs.run_warehouse(spark, cfg)
    assert done["customer_rows"] == done["unique_customers"] == 5
    assert (done["order_rows"], done["skipped_orders"]) == (40, 0)
    plans = store.executionsList(int(first), 10_000)
    texts = [plans.apply(i).physicalPlanDescription() for i in range(plans.size())]
    # One job draws the carts and stores the order table; no other draws them again, and
    # none reads a stored table for a number of rows.
    drawing = [t for t in texts if "Range (1, 41" in t and "payment_method" in t]
    assert len(drawing) == 1
    assert not [t for t in texts if "FileScan" in t and re.search(r"ReadSchema: struct<>", t)]
