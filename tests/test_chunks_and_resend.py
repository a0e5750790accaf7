"""Orders in chunks, items sent again, and files in order."""

import collections

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwright import sinks, sources
from cartwright.operators import enrich as E
from cartwright.operators import items as I
from cartwright.sinks import keyvalue

LINE = "orderId string, id long, title string, category string, price double, quantity int, discountPercentage double"


def test_chunks_of_a_hot_order(spark):
    rows = [("hot", i % 700, f"t{i % 3}", "c", 1.0, 1, 0.0) for i in range(2_000)]
    rows += [("small", 1, None, None, None, None, None), (None, 5, "x", "c", 1.0, 1, 0.0)]
    lines = spark.createDataFrame(rows, LINE).repartition(7)
    chunks = E.nest_in_chunks(lines, 64)
    got = collections.defaultdict(dict)
    for r in chunks.collect():
        got[r.orderId][r.chunk] = ([tuple(p) for p in r.products], r.n_lines)
    hot = got["hot"]
    assert sorted(hot) == list(range(32)) and {n for _, n in hot.values()} == {2_000}
    assert [len(hot[c][0]) for c in range(32)] == [64] * 31 + [16]
    joined = [p for c in range(32) for p in hot[c][0]]
    assert joined == sorted(r[1:] for r in rows if r[0] == "hot")
    assert got["small"] == {0: ([(1, None, None, None, None, None)], 1)}
    assert len(got[None][0][0]) == 1
    whole = {r.orderId: [tuple(p) for p in r.products] for r in E.nest_products(lines).collect()}
    assert whole["hot"] == joined
    # No group of the last step is a whole order.
    text = chunks._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(orderId" in text and "chunk" in text
    with pytest.raises(ValueError, match="at least one line"):
        E.nest_in_chunks(lines, 0)
    assert E.nest_in_chunks(lines.limit(0), 5).collect() == []


def _batches(ids, size):
    for i in range(0, len(ids), size):
        yield pd.DataFrame({"record_id": ids[i : i + size]})


class Store:
    """Refuses each id as often as ``times`` says; raises for a batch with ``poison``."""

    def __init__(self, times, poison=None, raises=0):
        self.left, self.poison, self.raises, self.calls = dict(times), poison, raises, []

    def __call__(self, batch):
        self.calls.append(list(batch["record_id"]))
        if self.raises and self.poison in self.calls[-1]:
            self.raises -= 1
            raise OSError("no batch with it now")
        refused = [i for i in batch["record_id"] if self.left.get(i, 0) > 0]
        for i in refused:
            self.left[i] -= 1
        return refused


def _status(store, ids, size, resend):
    out = pd.concat(list(keyvalue._put(_batches(ids, size), store, resend)))
    assert sorted(out["record_id"]) == sorted(ids)
    return dict(zip(out["record_id"], out["written"]))


def test_refused_items_are_sent_again(monkeypatch):
    waits = []
    monkeypatch.setattr(keyvalue.time, "sleep", waits.append)
    ids = [f"i{n}" for n in range(20)]
    store = Store({"i3": 1, "i4": 3, "i5": 9})
    status = _status(store, ids, 6, keyvalue.Resend(attempts=4, first_wait=1.0))
    assert [i for i in ids if not status[i]] == ["i5"]
    assert waits == [1.0, 2.0, 4.0]  # doubled, once for all that wait
    assert store.calls[4:] == [["i3", "i4", "i5"], ["i4", "i5"], ["i4", "i5"]]


def test_the_queue_is_bounded(monkeypatch):
    monkeypatch.setattr(keyvalue.time, "sleep", lambda s: None)
    ids = [f"i{n}" for n in range(30)]
    store = Store({i: 1 for i in ids})
    status = _status(store, ids, 5, keyvalue.Resend(attempts=2, pending=10))
    assert all(status.values()) and max(map(len, store.calls)) == 10
    failing = Store({}, poison="i7", raises=1)
    assert all(_status(failing, ids, 5, keyvalue.Resend(attempts=2)).values())
    for_good = Store({}, poison="i7", raises=99)
    status = _status(for_good, ids, 5, keyvalue.Resend(attempts=3))
    assert [i for i in ids if not status[i]] == [f"i{n}" for n in range(5, 10)]


def test_one_attempt_is_the_default(spark, tmp_path):
    rows = spark.range(9).select(F.col("id").alias("customer_id"))
    items = I.to_items(rows, "customer_id", "customer")
    status = sinks.write_kv(items, lambda b: ["customer#3"], str(tmp_path / "s"))
    assert [r.record_id for r in status.where("not written").collect()] == ["customer#3"]


def test_files_follow_one_another(spark, tmp_path):
    df = spark.range(1_000).select((F.col("id") * 7919 % 1000).alias("a"), F.col("id").alias("b"))
    path = sinks.write_ordered(df.repartition(9), str(tmp_path / "o"), F.desc("a"), F.asc("b"))
    rows = sorted(sources.read_ordered(spark, path, df.schema).collect(), key=lambda r: r.place)
    assert [r.place for r in rows] == list(range(1_000))
    assert [r.a for r in rows] == list(range(999, -1, -1))
    nothing = sinks.write_ordered(df.limit(0), str(tmp_path / "e"), "a")
    assert sources.read_ordered(spark, nothing, df.schema).collect() == []


def test_unique_keys_stay_where_they_are(spark):
    """Rows move only when a key repeats; a null key counts as one."""
    from cartwright.operators.keys import last_if_repeated

    rows = spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    kept = last_if_repeated(rows, "k")
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(kept.collect()) == sorted(rows.collect())
    twice = rows.unionByName(spark.sql("SELECT '7' AS k, 900L AS v"))
    assert {r.k: r.v for r in last_if_repeated(twice, "k").collect()}["7"] == 900
    null = spark.sql("SELECT CAST(NULL AS string) AS k, 1L AS v UNION ALL SELECT NULL, 2L")
    assert [tuple(r) for r in last_if_repeated(null, "k").collect()] == [(None, 2)]


def test_a_hot_order_is_no_join_key(spark, monkeypatch):
    """Its lines meet their order block by block, so they spread by order and block."""
    monkeypatch.setattr(E, "_BLOCK", 8)
    lines = spark.range(100).select(
        F.when(F.col("id") < 60, F.lit("hot")).when(F.col("id") < 95, F.col("id").cast("string")).alias("orderId"),
        (F.col("id") % 50).alias("id"), F.lit("t").alias("title"), F.lit("c").alias("category"),
        F.lit(1.0).alias("price"), F.lit(1).alias("quantity"), F.lit(0.0).alias("discountPercentage"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chunks = E.nest_in_chunks(lines, 7)
        text = chunks._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = [x for x in text.splitlines() if "SortMergeJoin" in x]
    assert len(join) == 1 and "block" in join[0]
    rows = sorted((r.chunk, r.n_lines, len(r.products)) for r in chunks.collect() if r.orderId == "hot")
    assert rows == [(i, 60, 7) for i in range(8)] + [(8, 60, 4)]
    assert [(r.n_lines, len(r.products)) for r in chunks.collect() if r.orderId is None] == [(5, 5)]
