"""Files, tables, the key-value sink and whole runs, on temporary folders."""

import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cartwright import schemas, sinks, sources
from cartwright.operators import items as I
from cartwright.plans import jobs
from cartwright.schemas import CART
from cartwright.session import shared_root

from cartwright.operators.keys import dedupe_users
from cartwright.sinks.tables import merge_statement
from conftest import AS_OF


def test_indented_json_arrays(spark, tmp_path):
    docs = [
        {"id": 1, "userId": 2, "products": [{"id": 5, "price": 1.5, "quantity": 2}]},
        {"id": 2, "userId": 3, "products": []},
    ]
    (tmp_path / "carts.json").write_text(json.dumps(docs, indent=2))
    carts = sources.read_carts(spark, str(tmp_path / "carts.json"), lines=False)
    assert carts.schema == CART
    rows = {r.id: r for r in carts.collect()}
    assert rows[1].products[0].price == 1.5 and rows[2].products == []
    (tmp_path / "users.json").write_text('[{"id": 1, "address": {"city": "Rome", "zip": 1}}]')
    user = sources.read_users(spark, str(tmp_path / "users.json"), lines=False).first()
    assert user.address.city == "Rome" and user.email is None


def test_missing_seed_is_empty_but_other_errors_are_not_hidden(spark, tmp_path):
    carts, users = sources.load_seed(spark, str(tmp_path / "no"), str(tmp_path / "none"))
    assert carts.count() == users.count() == 0 and carts.schema == CART
    with pytest.raises(Exception):
        sources.load_seed(spark, "nosuchscheme://x", str(tmp_path / "none"))


def test_envelope(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps({"carts": [{"id": i} for i in range(9)], "total": 9}))
    df = spark.read.option("multiLine", True).json(str(tmp_path / "e.json"))
    assert sources.unwrap_envelope(df, "carts").count() == 9


def test_csv_survives_quotes_and_line_ends(spark, tmp_path):
    text = 'He said "hi", then\nleft\\'
    df = spark.createDataFrame([(1, text)], "id int, note string")
    path = sinks.write_processed_csv(df, str(tmp_path / "csv"))
    back = spark.read.schema(df.schema).options(header=True, escape='"', multiLine=True).csv(path)
    assert tuple(back.first()) == (1, text)


def test_publish_replaces_and_keeps_history(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([(1,)], "id int")
    assert sinks.publish_table(one, "shop.t", root).count() == 1
    reader = spark.table("shop.t")
    sinks.publish_table(spark.table("shop.t").union(one), "shop.t", root)
    assert spark.table("shop.t").count() == 2 and reader.count() == 1
    wider = one.withColumn("name", F.lit("x"))
    assert sinks.publish_table(wider, "shop.t", root).columns == ["id", "name"]
    assert len(list((tmp_path / "shop" / "t").iterdir())) == 3


def test_failed_publish_leaves_the_table_alone(spark, tmp_path):
    one = spark.createDataFrame([(1,)], "id int")
    sinks.publish_table(one, "shop.u", str(tmp_path))
    with pytest.raises(Exception):
        sinks.publish_table(one.select(F.raise_error(F.lit("no")).cast("int").alias("id")), "shop.u", str(tmp_path))
    assert [r.id for r in spark.table("shop.u").collect()] == [1]


def test_upsert_table(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    name, root = "shop.v", str(tmp_path)
    assert sinks.upsert_table(rows, name, "k", root, "1998-01-01") == (2, 0)
    more = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sinks.upsert_table(more, name, "k", root, "1999-01-01") == (1, 1)
    got = {r.k: (r.v, r.created_at.year, r.updated_at.year) for r in spark.table(name).collect()}
    assert got == {1: ("a", 1998, 1998), 2: ("c", 1998, 1999), 3: ("d", 1999, 1999)}


def test_write_documents(spark, tmp_path):
    fields, root = ("id", "v"), str(tmp_path)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert sinks.write_documents(rows.limit(0), fields, "id", "shop.docs", root) == 0
    assert not spark.catalog.tableExists("shop.docs")
    assert sinks.write_documents(rows, fields, "id", "shop.docs", root) == 2
    newer = spark.createDataFrame([(2, "z"), (3, "c")], "id int, v string")
    assert sinks.write_documents(newer, fields, "id", "shop.docs", root) == 2
    docs = {r.doc_id: json.loads(r.doc)["v"] for r in spark.table("shop.docs").collect()}
    assert docs == {"1": "a", "2": "z", "3": "c"}


def _items(spark, n):
    rows = spark.range(n).select(F.col("id").cast("int").alias("customer_id"))
    return I.to_items(rows, "customer_id", "customer")


def test_kv_status(spark, tmp_path):
    def refuse(batch):
        if (batch["record_id"] == "customer#3").any():
            raise OSError("refused")

    assert sources.load_write_status(spark, str(tmp_path / "none")) is None
    items = _items(spark, 200).unionByName(_items(spark, 200)).repartition(8)
    path = str(tmp_path / "status")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        status = sinks.write_kv(items, refuse, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = {r.record_id: r.written for r in status.collect()}
    assert len(rows) == status.count() == 200
    assert rows["customer#3"] is False and any(rows.values())
    stored = sources.load_write_status(spark, path)
    assert {r.record_id: r.written for r in stored.collect()} == rows
    strict = sinks.write_kv(items, refuse, path, all_or_nothing=True)
    assert {r.written for r in strict.collect()} == {False}
    fine = sinks.write_kv(items, lambda batch: None, path, all_or_nothing=True)
    assert {r.written for r in fine.collect()} == {True}
    assert sinks.write_kv(items.limit(0), refuse, path, all_or_nothing=True).count() == 0


def _config(tmp_path, namespace, **kw):
    users = [{"id": i, "firstName": f"F{i}", "email": f"u{i}@x.y"} for i in range(1, 6)]
    (tmp_path / "users.json").write_text(json.dumps(users, indent=2))
    return jobs.JobConfig(
        root=str(tmp_path / "out"), as_of=AS_OF, n_orders=60, namespace=namespace,
        seed_users=str(tmp_path / "users.json"), seed_as_lines=False, **kw,
    )


def test_warehouse_run(spark, tmp_path):
    cfg = _config(tmp_path, "run_a")
    first = jobs.run_warehouse(spark, cfg)
    assert first == {
        "customer_rows": 5, "unique_customers": 5, "order_rows": 60, "items_total": 65,
        "items_written": 65, "items_failed": 0, "skipped_orders": 0,
    }
    before = sorted(spark.table("run_a.order_analytics").collect())
    assert jobs.run_warehouse(spark, cfg) == first
    assert sorted(spark.table("run_a.order_analytics").collect()) == before
    assert spark.table("run_a.items").count() == 65
    spent = spark.table("run_a.customer_analytics").agg(F.sum("total_spent")).first()[0]
    assert spent == spark.table("run_a.order_analytics").agg(F.sum("final_amount")).first()[0] > D(0)
    assert [f.name for f in spark.table("run_a.order_analytics").schema] == schemas.ORDER_ANALYTICS.fieldNames()


def test_serving_run_twice_updates(spark, tmp_path):
    cfg = _config(tmp_path, "run_b")
    first = jobs.run_serving(spark, cfg)
    second = jobs.run_serving(spark, cfg)
    assert (first["orders_created"], first["orders_updated"]) == (60, 0)
    assert (second["orders_created"], second["orders_updated"]) == (0, 60)
    assert (second["customers_created"], second["customers_updated"]) == (0, 5)
    assert second["order_docs"] == 60 and spark.table("run_b.order_documents").count() == 60
    csv = spark.read.schema(schemas.CUSTOMER_ANALYTICS).option("header", True)
    assert csv.csv(f"{cfg.root}/processed/customer_analytics").count() == 5


def test_one_branch_failing_does_not_stop_the_other(spark, tmp_path, monkeypatch):
    cfg = _config(tmp_path, "run_c")

    def broken(_spark, _cfg):
        raise OSError("disk gone")

    monkeypatch.setitem(jobs.BRANCHES, "serving", broken)
    with pytest.raises(RuntimeError, match="serving branch failed: disk gone") as failed:
        jobs.run(spark, cfg)
    assert failed.value.results["warehouse"]["order_rows"] == 60
    assert isinstance(failed.value.errors["serving"], OSError)
    assert spark.table("run_c.order_analytics").count() == 60
    done = jobs.run(spark, cfg, ("warehouse",))
    assert done["warehouse"]["order_rows"] == 60


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stored_status_is_the_returned_one(spark, tmp_path):
    """Quoted ids survive, and refused ids fail alone whatever the batches."""
    rows = [('a "b", c\nd', "x", "{}"), ("plain", "x", "{}"), ("3", "x", "{}")]
    items = spark.createDataFrame(rows, "record_id string, record_type string, item string")
    path = str(tmp_path / "status")
    returned = sinks.write_kv(items, lambda batch: [i for i in batch["record_id"] if i == "3"], path)
    expected = {'a "b", c\nd': True, "plain": True, "3": False}
    assert {r.record_id: r.written for r in returned.collect()} == expected
    stored = sources.load_write_status(spark, path)
    assert {r.record_id: r.written for r in stored.collect()} == expected
    sinks.write_kv(items, lambda batch: ["3"], path, all_or_nothing=True)
    assert {r.written for r in sources.load_write_status(spark, path).collect()} == {False}


def test_csv_tells_empty_from_null(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "a\nb"), (4, '"')], "id int, note string")
    path = sinks.write_processed_csv(df, str(tmp_path / "csv"))
    assert sorted(sources.read_processed_csv(spark, path, df.schema).collect()) == sorted(df.collect())


def test_publish_in_another_format_and_over_a_managed_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    sinks.publish_table(df, "shop.fmt", str(tmp_path))
    assert sinks.publish_table(df, "shop.fmt", str(tmp_path), "json").collect() == df.collect()
    df.write.saveAsTable("shop.managed")
    with pytest.raises(ValueError, match="managed"):
        sinks.publish_table(df, "shop.managed", str(tmp_path))
    assert spark.table("shop.managed").count() == 1


def test_upsert_into_an_older_table(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sinks.upsert_table(old, "shop.older", "k", str(tmp_path), "1998-01-01")
    new = spark.createDataFrame([(2, "c", 5)], "k int, v string, score int")
    counts = sinks.upsert_table(new, "shop.older", "k", str(tmp_path), "1999-01-01", defaults={"score": 0})
    assert counts == (0, 1)
    rows = {r.k: (r.v, r.score) for r in spark.table("shop.older").collect()}
    assert rows == {1: ("a", 0), 2: ("c", 5)}


def test_merge_statement():
    text = merge_statement("cat.db.t", "batch", "k", ["k", "v"])
    assert text == (
        "MERGE INTO cat.db.t t USING batch s ON t.k = s.k "
        "WHEN MATCHED THEN UPDATE SET t.v = s.v, t.updated_at = s.now "
        "WHEN NOT MATCHED THEN INSERT (k, v, created_at, updated_at) VALUES (s.k, s.v, s.now, s.now)"
    )


def test_unparsable_signup_loses(spark):
    rows = [(1, "not a date"), (1, "2024-01-01T10:00:00+02:00"), (1, "2024-01-01T09:00:00Z"), (2, None)]
    users = spark.createDataFrame(rows, "id long, createdAt string")
    assert {r.id: r.createdAt for r in dedupe_users(users).collect()} == {1: "2024-01-01T09:00:00Z", 2: None}


def test_published_tables_are_not_stored_again(spark, tmp_path):
    """One hand-over folder per published table; stores and documents read it."""
    users = [{"id": i, "firstName": f"F{i}", "email": f"u{i}@x.y"} for i in range(1, 6)]
    (tmp_path / "users.json").write_text("\n".join(map(json.dumps, users)))
    cfg = jobs.JobConfig(
        root=str(tmp_path / "out"), as_of="1999-01-01", n_orders=30, namespace="run_once",
        seed_users=str(tmp_path / "users.json"),
    )
    first, again = jobs.run_serving(spark, cfg), jobs.run_serving(spark, cfg)
    assert len(list((tmp_path / "out" / "handover").iterdir())) == 2 * 2
    assert (first["orders_created"], first["orders_updated"], first["order_docs"]) == (30, 0, 30)
    assert (again["orders_created"], again["orders_updated"], again["order_docs"]) == (0, 30, 30)
    assert spark.table(cfg.table("order_store")).count() == 30
    assert spark.table(cfg.table("order_documents")).count() == 30
    raw = [p.name for p in (tmp_path / "out" / "raw" / "synthetic_carts").glob("part-*")]
    assert raw and all(name.endswith(".json.gz") for name in raw)


def test_rows_without_a_key_meet_none(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([(None, 1), (1, 1)], "k int, v int")
    assert sinks.upsert_table(rows, "shop.keyless", "k", root, "1998-01-01") == (2, 0)
    assert sinks.upsert_table(rows, "shop.keyless", "k", root, "1999-01-01") == (1, 1)
    assert sinks.upsert_table(rows, "shop.keyless", "k", root, "2000-01-01") == (1, 1)
    assert sorted(r.k or 0 for r in spark.table("shop.keyless").collect()) == [0, 0, 0, 1]
