from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from aeromart import functions as fn
from aeromart.functions.numbers import clean_numeric, number_in


def values(spark, rows, schema, *columns):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*columns).collect()]


def one(spark, texts, make):
    return [r[0] for r in values(spark, [(t,) for t in texts], "c string", make(F.col("c")))]


def test_resolve_num(both_modes):
    texts = ["-", "55", "12.5", "", None]
    assert one(both_modes, texts, fn.resolve_num) == [None, 55.0, 12.5, None, None]


def test_resolve_choice_of_every_shape(both_modes):
    schema = (
        "data struct<both:struct<double:double,int:int>, whole:struct<int:int>, "
        "frac:struct<double:double>, plain:string, other:struct<text:string>>"
    )
    rows = [
        (((1.5, None), (3,), (2.5,), "7", ("x",)),),
        (((None, 4), (None,), (None,), "no", ("x",)),),
        (((1.5, 9), None, None, None, None),),
    ]
    df = both_modes.createDataFrame(rows, schema)
    names = ("both", "whole", "frac", "plain", "other", "absent")
    got = df.select(*[fn.resolve_choice(f"data.{n}", df.schema).alias(n) for n in names])
    assert [tuple(r) for r in got.collect()] == [
        (1.5, 3.0, 2.5, 7.0, None, None),
        (4.0, None, None, None, None, None),
        (1.5, None, None, None, None, None),
    ]
    assert fn.field_type(df.schema, "data.plain.deeper") is None


def test_clean_numeric_of_text_and_struct(both_modes):
    df = both_modes.createDataFrame(
        [("3.5", (2.5, "x")), ("-", (None, "4"))], "a string, b struct<double:double,string:string>"
    )
    got = df.select(fn.clean_numeric("a", df.schema), fn.clean_numeric("b", df.schema)).collect()
    assert [tuple(r) for r in got] == [(3.5, 2.5), (None, None)]


def test_clean_string_matches_exactly(spark):
    texts = ["-", "", "#NAME?", "N/A", " -", "pm25", None]
    assert one(spark, texts, fn.clean_string) == [None] * 4 + [" -", "pm25", None]


def test_clean_pollutant(spark):
    texts = ["-", "", "#NAME?", "N/A", "aqi", "pm10", None]
    assert one(spark, texts, fn.clean_pollutant) == [None] * 5 + ["pm10", None]


def test_strip_thousands(both_modes):
    texts = ["1,012", "1,234,567.5", "-", None]
    assert one(both_modes, texts, fn.strip_thousands) == [1012.0, 1234567.5, None, None]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("21.0, 105.8", (21.0, 105.8)),
        ("21.0", (21.0, None)),
        ("", (None, None)),
        ("x,105", (None, 105.0)),
        (None, (None, None)),
    ],
)
def test_split_location(both_modes, text, expected):
    lat, lon = fn.split_location(F.col("c"))
    assert values(both_modes, [(text,)], "c string", lat, lon) == [expected]


def test_parse_iso(both_modes):
    texts = ["2026-04-12T08:00:00+07:00", "2026-04-12T08:00:00Z", "soon", None]
    got = one(both_modes, texts, lambda c: fn.parse_iso(c).cast("string"))
    assert got == ["2026-04-12 01:00:00", "2026-04-12 08:00:00", None, None]


def test_parse_ts_tz(both_modes):
    rows = [
        ("2021-01-21 22:00:00", "+07:00"),
        ("2021-01-21 22:00:00", None),
        (None, "+07:00"),
        ("2021-13-21 22:00:00", "+07:00"),
    ]
    parsed = fn.parse_ts_tz(F.col("d"), F.col("z")).cast("string")
    got = [r[0] for r in values(both_modes, rows, "d string, z string", parsed)]
    assert got == ["2021-01-21 15:00:00", None, None, None]


def test_classify_by_keyword(spark):
    names = ["Hồ Chí Minh station", "Hanoi US", "nowhere", "cao bằng", "Gia Lai, Da Nang", None]
    assert one(spark, names, fn.classify_by_keyword) == [
        "ho-chi-minh-city",
        "ha-noi",
        None,
        None,
        "da-nang",
        None,
    ]


def test_aqi_band_edges(spark):
    edges = [-1.0, 0.0, 50.0, 50.5, 100.0, 150.0, 200.0, 300.0, 300.01, None]
    got = values(spark, [(e,) for e in edges], "c double", fn.aqi_band(F.col("c")))
    assert [r[0] for r in got] == [
        "Good",
        "Good",
        "Good",
        "Moderate",
        "Moderate",
        "Unhealthy for Sensitive Groups",
        "Unhealthy",
        "Very Unhealthy",
        "Hazardous",
        "Hazardous",
    ]


def test_dates_and_partition_texts(spark):
    rows = [(datetime(2024, 3, 9, 20, 0),)]
    year, month = fn.year_month(F.col("c"))
    local = fn.to_date(F.col("c"), "Asia/Ho_Chi_Minh")
    got = values(spark, rows, "c timestamp", fn.to_date(F.col("c")), local, year, month)
    assert got == [(date(2024, 3, 9), date(2024, 3, 10), "2024", "03")]


def test_parse_slug_list(spark):
    texts = ["ha-noi,", " Da-Nang ", ",,", None]
    assert one(spark, texts, fn.parse_slug_list) == [["ha-noi"], ["da-nang"], [], None]


def test_bronze_key(spark):
    rows = [("ha-noi", datetime(2026, 4, 11, 17, 0, 5))]
    got = values(
        spark,
        rows,
        "c string, t timestamp",
        fn.bronze_key(F.col("c"), F.col("t")),
        fn.ingestion_id(F.col("t")),
    )
    assert got == [
        (
            "api_raw/queried_city=ha-noi/year=2026/month=04/day=11/"
            "ha-noi_2026-04-11T17-00-05Z.json",
            "20260411_170005",
        )
    ]


def test_aggregates(spark):
    rows = [("a", 1.0), ("b", 2.005), ("a", None), (None, 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = df.agg(
        fn.mean2("v"),
        fn.distinct_text("k", ("a", "b", "c")),
        fn.distinct_count("k"),
        fn.count_where(F.col("v") > 1),
        fn.pct(fn.count_where(F.col("v").isNull()), F.count("*")),
    ).first()
    assert tuple(got) == (2.34, "a,b", 2, 2, 25.0)
    empty = df.filter("false").agg(fn.count_where(F.col("v") > 1), fn.pct(F.count("v"), F.count("*")))
    assert tuple(empty.first()) == (0, 0.0)


def test_mean2_rounds_half_up_whatever_the_order(spark):
    values_ = [0.01, 0.02, 0.1, 0.37]
    for rows in (values_, values_[::-1]):
        df = spark.createDataFrame([(v,) for v in rows], "v double")
        assert df.agg(fn.mean2("v")).first()[0] == 0.13


def test_number_in_text_is_what_the_cast_says(both_modes):
    texts = ["1", " 2.5 ", "-", "", "N/A", "#NAME?", "NaN", "inf", "-Infinity", "+.5", ".", "1e3", "1d", "0x1p3", "1,5", "nano", "info", "é", None]
    df = both_modes.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(number_in(F.col("t")).cast("string").alias("new"), F.col("t").try_cast("double").cast("string").alias("old")).collect()
    assert [r["new"] for r in rows] == [r["old"] for r in rows]
    plan = df.select(clean_numeric("t", df.schema))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan  # a placeholder never reaches the cast that throws
