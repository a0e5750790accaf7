"""Upsert, contract, evolution, documents, items, reports."""

import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F, types as T

from cartwright import schemas
from cartwright.operators import analytics as A
from cartwright.operators import items as I
from cartwright.operators import store as S

OLD = dt.datetime(1998, 1, 1)
NOW = dt.datetime(1999, 1, 1)
STORED = "k int, v string, created_at timestamp, updated_at timestamp"


def test_upsert(spark):
    existing = spark.createDataFrame([(1, "a", OLD, OLD), (2, "b", OLD, OLD)], STORED)
    incoming = spark.createDataFrame(
        [(2, None, 1), (3, "x", 1), (3, "y", 2)], "k int, v string, seq int"
    ).cache()
    counts = S.upsert_counts(existing, incoming, "k").first()
    assert (counts.created, counts.updated) == (1, 2)
    stored = existing.withColumn("seq", F.lit(0))
    got = S.upsert(stored, incoming, "k", "1999-01-01", ("seq",)).orderBy("k").collect()
    assert [(r.k, r.v, r.created_at, r.updated_at) for r in got] == [
        (1, "a", OLD, OLD), (2, None, OLD, NOW), (3, "y", NOW, NOW),
    ]


def test_upsert_of_nothing_and_twice(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    empty = S.empty_store(rows)
    once = S.upsert(empty, rows, "k", "1998-01-01")
    twice = S.upsert(once, rows, "k", "1998-01-01")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert tuple(S.upsert_counts(once, rows, "k").first()) == (0, 2)
    assert tuple(S.upsert_counts(once, rows.limit(0), "k").first()) == (0, 0)
    assert sorted(S.upsert(once, rows.limit(0), "k", "1999-01-01").collect()) == sorted(once.collect())


def test_contract(spark):
    good = (1, "Ann", "a@b", "b", "Rome", 1, 1, D("1.00"), D("1.00"), D("1.00"), "Low")
    df = spark.createDataFrame([good], schemas.CUSTOMER_ANALYTICS)
    assert {r.violations for r in S.check_contract(df, schemas.CUSTOMER_CONTRACT).collect()} == {0}
    long_name = (2, "x" * 256, *good[2:])
    nameless = (None, None, *good[2:])
    broken = spark.createDataFrame([good, good, long_name, nameless], schemas.CUSTOMER_ANALYTICS)
    found = {
        r.rule: r.violations
        for r in S.check_contract(broken, schemas.CUSTOMER_CONTRACT).collect()
        if r.violations
    }
    assert found == {
        "unique:customer_id": 1, "max_length:full_name": 1,
        "not_null:customer_id": 1, "not_null:full_name": 1,
    }


def test_evolve(spark):
    target = T.StructType(
        [T.StructField("id", T.IntegerType()), T.StructField("email_domain", T.StringType()),
         T.StructField("score", T.IntegerType()), T.StructField("note", T.StringType())]
    )
    old = spark.createDataFrame([(1, "USD", None)], "id bigint, currency string, score int")
    got = S.evolve(old, target, {"email_domain": "", "score": 0})
    assert got.schema.simpleString() == target.simpleString()
    assert tuple(got.first()) == (1, "", 0, None)


def test_coerce_types(spark):
    raw = spark.createDataFrame([("12", "3.456"), ("x", "")], "order_hour string, final_amount string")
    target = T.StructType([schemas.ORDER_ANALYTICS[c] for c in raw.columns])
    assert [tuple(r) for r in S.coerce_types(raw, target).collect()] == [(12, D("3.46")), (None, None)]


def test_documents_are_strict(spark):
    df = spark.createDataFrame([(1, "x")], "customer_id int, currency string")
    with pytest.raises(ValueError, match="currency"):
        I.to_documents(df, schemas.CUSTOMER_DOCUMENT_FIELDS, "customer_id")
    with pytest.raises(ValueError, match="no id column"):
        I.to_documents(df.select("currency"), ("currency",), "customer_id")
    doc = I.to_documents(df.drop("currency"), schemas.CUSTOMER_DOCUMENT_FIELDS, "customer_id").first()
    assert tuple(doc) == ("1", '{"customer_id":1}')


def test_items(spark):
    customers = spark.createDataFrame([(1, D("2.50"))], "customer_id int, total_spent decimal(14,2)")
    orders = spark.createDataFrame([("a", dt.date(2024, 1, 2))], "order_id string, order_date date")
    items = {r.record_id: r for r in I.to_kv_items(customers, orders).collect()}
    assert set(items) == {"customer#1", "order#a"}
    assert json.loads(items["order#a"].item) == {
        "record_id": "order#a", "record_type": "order", "order_id": "a", "order_date": "2024-01-02",
    }
    assert '"total_spent":2.50' in items["customer#1"].item
    with pytest.raises(Exception, match="null key"):
        I.to_items(orders.withColumn("order_id", F.lit(None).cast("string")), "order_id", "order").collect()


def test_status_view_counts_before_the_limit(spark):
    status = spark.createDataFrame(
        [(f"order#{i}", i % 3 != 0) for i in range(10)], schemas.WRITE_STATUS
    )
    shown, summary = A.view_status(status, only_failed=True, limit=2)
    assert [r.record_id for r in shown.collect()] == ["order#0", "order#3"]
    assert tuple(summary.first()) == (10, 6, 4)


def test_search_and_facets(spark):
    df = spark.createDataFrame(
        [("Ann Lee", "Rome"), ("Bo Roman", "Oslo"), ("Cy", None)], "full_name string, city string"
    )
    fields = ["full_name", "city"]
    assert [r.full_name for r in A.search(df, "ROM ann", fields).collect()] == ["Ann Lee"]
    assert A.search(df, "rom", fields).count() == 2
    assert A.search(df, "%", fields).count() == 0
    assert A.search(df, "  ", fields).count() == 3
    assert {tuple(r) for r in A.facet(df, "city").collect()} == {("Rome", 1), ("Oslo", 1), (None, 1)}
    assert A.apply_facets(df, {"city": "Rome", "full_name": "Bo"}).count() == 0


def test_orderings(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01", 5), ("b", "2024-01-02", 9), ("c", "2024-01-02", 1)],
        "order_id string, order_date string, order_hour int",
    )
    assert [r.order_id for r in A.order_orders(df).collect()] == ["c", "b", "a"]
    scores = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0)], "customer_id int, lifetime_value_score double")
    assert [r.customer_id for r in A.order_customers(scores).collect()] == [2, 3, 1]
    assert [r.customer_id for r in A.head(scores, 2, "customer_id").collect()] == [1, 2]
