"""Mixing against exact fractions, and against its SQL."""

import math
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st

from cartwright.llm import mixing, queries
from workload.compare import connect, sorted_rows

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, size string, target int, number int, copy int"


def exact_targets(sizes: dict, share=Fraction(3, 2), most=2) -> dict:
    """Targets as the contract words them: share, cut, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    limit = {s: most * sizes[s] for s in order}
    target = {s: Fraction(0) for s in order}
    left, open_ = share * sum(sizes.values()), list(order)
    while left > 0 and open_:
        whole = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / whole
        left = sum(max(target[s] - limit[s], 0) for s in open_)
        for s in open_:
            target[s] = min(target[s], limit[s])
        open_ = [s for s in open_ if target[s] < limit[s]]
    return target


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 2, 3) for r in rows], SCHEMA)


def sizes_frame(spark, sizes):
    return spark.createDataFrame(list(sizes.items()), "source string, source_size long")


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 10, "c": 10, "d": 10},
        {"a": 1, "b": 1000, "c": 3, None: 50, "": 7, "é": 9, "Z": 0},
        {f"s{i}": 7**i % 1009 for i in range(40)},
        {"only": 5},
        {"none": 0, "at all": 0},
    ],
)
def test_targets(spark, sizes):
    got = mixing.source_targets(sizes_frame(spark, sizes)).collect()
    want = exact_targets(sizes)
    assert {r.source for r in got} == set(want) and len(got) == len(want)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-12, abs_tol=1e-12)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=9))
def test_yardstick_keeps_the_sum(sizes):
    found = exact_targets({f"{i}": n for i, n in enumerate(sizes)})
    assert sum(found.values()) == Fraction(3, 2) * sum(sizes)


WORDS = ["one", "", None, " \t\n", "two  words", "  \x1f", "x" * 200_000, "a\x0bb\x0cc\rd ", " z"]


def test_words(spark):
    rows = spark.createDataFrame([(t,) for t in WORDS], "text string")
    got = [r.n for r in rows.select(mixing.n_words(rows.text).alias("n")).collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in WORDS]


def corpus():
    draw = random.Random(3)
    rows = [(i, "w " * draw.randint(0, 60), "hot" if i % 3 else f"s{i % 11}") for i in range(6000)]
    return rows + [(None, f"no id {i}", None) for i in range(300)] + [(1, "tie", "s0")] * 2


def test_plan_and_mix(spark):
    rows = corpus()
    docs = frame(spark, rows)
    plan = mixing.mixing_plan(docs)
    got = plan.collect()
    assert len(got) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert r.taken == r.copies * r["size"] and r.copies in (0, 1, 2)
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = exact_targets(sizes)
    for s in sizes:
        assert math.isclose(target[s], want[s], rel_tol=1e-9)
        # Three standard deviations of the draws, for documents of at most 60 words.
        assert abs(taken[s] - target[s]) < 3 * 0.5 * 60 * len([r for r in rows if r[2] == s]) ** 0.5
    again = mixing.mixing_plan(docs.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.text, str(r.source), r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))
    mixed = mixing.mix(plan)
    assert mixed.count() == sum(r.copies for r in got)
    assert mixed.groupBy("doc_id", "text", "source", "copy").count().where("copy > 1").isEmpty()


def test_empty_table_and_no_words(spark):
    assert mixing.mixing_plan(frame(spark, [])).collect() == []
    (row,) = mixing.mixing_plan(frame(spark, [(1, None, None)])).collect()
    assert (row["size"], row.source_size, row.target, row.taken) == (0, 0, 0.0, 0)


def test_query_and_its_sql(spark):
    df = queries.op13_repetition_rates(spark, SF)
    got = sorted_rows(df.columns, df.collect())
    cursor = connect(SF).execute(queries.ORACLES["op13_repetition_rates"])
    assert got == sorted_rows([c[0] for c in cursor.description], cursor.fetchall())
