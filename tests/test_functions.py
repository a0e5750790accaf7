"""Scalar rules on hand-made rows, the expected values worked out by hand."""

import datetime as dt
import itertools
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cartwright.functions import money, serialize, text, time

from conftest import AS_OF


def column(spark, values, type_, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r.r for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def test_email(spark):
    raw = [None, "", "no-at", "a@b@c", " \tAnn@Shop.COM\n "]
    clean = column(spark, raw, "string", text.email_clean)
    assert clean == [None, "", "no-at", "a@b@c", "ann@shop.com"]
    domain = column(spark, raw, "string", lambda c: text.email_domain(text.email_clean(c)))
    assert domain == ["", "", "", "c", "shop.com"]


def test_full_name_skips_a_missing_part(spark):
    df = spark.createDataFrame([(" Ann ", " Lee\t"), (None, "Lee"), ("Ann", None)], "f string, l string")
    names = [r[0] for r in df.select(text.full_name(F.col("f"), F.col("l"))).collect()]
    assert names == ["Ann Lee", "Lee", "Ann"]


def test_or_unknown(spark):
    assert column(spark, [" a", "a ", " ", "\t", "", None], "string", text.or_unknown) == [
        "a", "a", "Unknown", "Unknown", "Unknown", "Unknown",
    ]


def test_truthy(spark):
    got = column(spark, ["1", " True ", "YES", "on", "0", "off", "", None], "string", text.truthy)
    assert got == [True] * 4 + [False] * 4


def test_record_key_refuses_null(spark):
    assert column(spark, [7], "int", lambda c: text.record_key("order", c)) == ["order#7"]
    with pytest.raises(Exception, match="null key for a order record"):
        column(spark, [None], "int", lambda c: text.record_key("order", c))


def test_parse_ts(spark):
    fallback = dt.datetime(1999, 1, 1)
    cases = {
        "2024-03-01T10:20:30": dt.datetime(2024, 3, 1, 10, 20, 30),
        "2024-03-01T10:20:30Z": dt.datetime(2024, 3, 1, 10, 20, 30),
        "2024-03-01T10:20:30+02:00": dt.datetime(2024, 3, 1, 8, 20, 30),
        "2024-03-01 10:20:30.5": dt.datetime(2024, 3, 1, 10, 20, 30, 500000),
        "2024-03-01": dt.datetime(2024, 3, 1),
        "2024-02-30": fallback,
        "nope": fallback,
        "": fallback,
        "10:20:30": fallback,
        "T10:20": fallback,
        None: fallback,
    }
    assert column(spark, list(cases), "string", lambda c: time.parse_ts(c, AS_OF)) == list(
        cases.values()
    )
    dates = column(spark, ["2024-03-01T10:00:00Z", "x", None], "string", time.coerce_date)
    assert dates == [dt.date(2024, 3, 1), None, None]


def test_tenure(spark):
    days = [dt.date(1998, 12, 31), dt.date(1999, 1, 1), dt.date(2000, 1, 1), None]
    assert column(spark, days, "date", lambda c: time.tenure_days(c, AS_OF)) == [1, 0, 0, 0]


def test_iso_text_and_zone(spark):
    stamps = [dt.datetime(2024, 3, 1, 10), dt.datetime(2024, 3, 1, 10, 0, 0, 1500)]
    assert column(spark, stamps, "timestamp", time.iso_text) == [
        "2024-03-01T10:00:00", "2024-03-01T10:00:00.001500",
    ]
    assert column(
        spark, stamps[:1], "timestamp", lambda c: time.to_utc(c, "America/New_York")
    ) == [dt.datetime(2024, 3, 1, 15)]


def test_rounding_is_half_up_on_decimal_text(spark):
    values = [1.005, 2.675, -1.005, 0.125, None]
    assert column(spark, values, "double", money.round_money) == [
        D("1.01"), D("2.68"), D("-1.01"), D("0.13"), None,
    ]
    assert column(spark, [0.00005, 0.12345], "double", money.round_ratio) == [
        D("0.0001"), D("0.1235"),
    ]


def test_discount_ratio(spark):
    df = spark.createDataFrame(
        [(D("0.01"), D("0.00")), (D("1.00"), D("3.00")), (D("0.45"), D("1000.00"))],
        "d decimal(14,2), g decimal(14,2)",
    )
    got = [r[0] for r in df.select(money.discount_ratio(F.col("d"), F.col("g"))).collect()]
    assert got == [D("0.0000"), D("0.3333"), D("0.0005")]


def test_ltv_matches_plain_python(spark):
    spent = ["499999.99", "500000.00", "500000.01", "0.00", "-12.34", "1234.56"]
    cases = itertools.product(map(D, spent), [0, 14, 15, 16], [0, 729, 730, 731])
    df = spark.createDataFrame(list(cases), "s decimal(14,2), n int, d int")
    rows = df.select("*", money.ltv(F.col("s"), F.col("n"), F.col("d")).alias("score")).collect()
    assert len(rows) == 96
    for r in rows:
        assert r.score == money.ltv_score(r.s, r.n, r.d), r


def test_ltv_of_nulls_is_zero(spark):
    df = spark.createDataFrame([(None, None, None)], "s decimal(14,2), n int, d int")
    assert df.select(money.ltv(F.col("s"), F.col("n"), F.col("d"))).first()[0] == 0


def test_average_rounds_half_up(spark):
    df = spark.createDataFrame(
        [(D("0.05"), 2), (D("-0.05"), 2), (D("10.00"), 3), (D("1.00"), 0)], "s decimal(14,2), n int"
    )
    got = [r[0] for r in df.select(money.avg_order_value(F.col("s"), F.col("n"))).collect()]
    assert got == [D("0.03"), D("-0.03"), D("3.33"), D("0.00")]


def test_segment_borders(spark):
    scores = [D("29.99"), D("30.00"), D("59.99"), D("60.00")]
    want = ["Low", "Medium", "Medium", "High"]
    assert column(spark, scores, "decimal(8,2)", money.segment) == want
    assert [money.customer_segment(s) for s in scores] == want


def test_documents_values(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), D("12.30"), dt.date(2024, 1, 2), None)],
        "id int, x double, m decimal(14,2), d date, n string",
    )
    doc = df.select(serialize.to_doc(df)).first()[0]
    assert doc == '{"id":1,"m":12.3,"d":"2024-01-02T00:00:00"}'
    kept = df.select(serialize.to_doc(df, keep_nulls=True)).first()[0]
    assert '"x":null' in kept and '"n":null' in kept


def test_kv_values_inside_nested_shapes(spark):
    df = spark.sql(
        "SELECT array(DATE '2024-01-02') AS a, map('k', TIMESTAMP '2024-01-02 03:04:05') AS m, "
        "named_struct('d', DATE '2024-01-02', 'x', 0.1D) AS s, cast(NULL AS struct<d: date>) AS z"
    )
    safe = df.select(
        *[serialize.kv_safe(F.col(f.name), f.dataType).alias(f.name) for f in df.schema]
    )
    row = safe.first()
    assert row.a == ["2024-01-02"]
    assert row.m == {"k": "2024-01-02T03:04:05"}
    assert (row.s.d, row.s.x, row.z) == ("2024-01-02", 0.1, None)


def test_labels(spark):
    df = spark.sql(
        "SELECT 'Ann Lee' AS full_name, 'High' AS customer_segment, 12.50BD AS total_spent, "
        "'abcdefghij' AS order_id, 3.00BD AS final_amount, 'PayPal' AS payment_method"
    )
    row = df.select(serialize.customer_label(), serialize.order_label()).first()
    assert tuple(row) == ("Ann Lee | High | $12.50", "Order abcdefgh… | $3.00 | PayPal")
