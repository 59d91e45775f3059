from datetime import datetime

import pytest
from pyspark.sql import functions as F

import aeromart as am
from aeromart.fixed import CITIES
from aeromart.workload.adapters import REGIONS
from aeromart.workload.queries import QUERIES

AS_OF = datetime(2024, 1, 10)
FACT = (
    "aqi double, measured_at timestamp, dominant_pollutant string, queried_city string, "
    "source string, ingested_at string"
)


def fact(spark, copies=3, **changes):
    rows = []
    for city in CITIES:
        for _ in range(copies):
            row = {
                "aqi": 50.0,
                "measured_at": datetime(2024, 1, 9),
                "dominant_pollutant": "pm25",
                "queried_city": city,
                "source": "api",
                "ingested_at": "2024-01-09T10:00:00.123456+00:00",
            }
            rows.append(tuple({**row, **changes}.values()))
    return spark.createDataFrame(rows, FACT)


def dim(spark, cities=CITIES):
    return spark.createDataFrame([(c,) for c in cities], "queried_city string")


def failed(report):
    return sorted(r["check"] for r in report.filter(~F.col("passed")).collect())


def test_a_healthy_run_has_eleven_rows(spark):
    report = am.dq_check(fact(spark), dim(spark), AS_OF)
    assert report.count() == 11
    assert failed(report) == []
    assert tuple(am.dq_summary(report).first()) == (True, 11, 11)
    by_check = {r["check"]: r for r in report.collect()}
    assert by_check["row_count"]["message"] == "fact_aqi row count: 15 (min: 10)"
    assert by_check["city_coverage"]["message"] == "All 5 cities present"


@pytest.mark.parametrize(
    "changes, checks",
    [
        ({"aqi": None}, ["null_pct"]),
        ({"aqi": 500.0}, []),
        ({"aqi": 500.5}, ["aqi_range"]),
        ({"aqi": -0.5}, ["aqi_range"]),
        ({"source": None}, []),
        ({"source": "bad"}, ["source_validity"]),
        ({"queried_city": "ha-noi"}, ["city_coverage"]),
        ({"queried_city": None}, ["city_coverage", "null_pct"]),
        ({"ingested_at": "2024-01-08T00:00:00"}, []),
        ({"ingested_at": "2024-01-07T23:59:59"}, ["freshness"]),
        ({"dominant_pollutant": None, "measured_at": None}, ["null_pct", "null_pct"]),
    ],
)
def test_single_faults(spark, changes, checks):
    assert failed(am.dq_check(fact(spark, **changes), dim(spark), AS_OF)) == checks


def test_messages_of_faults(spark):
    bad = fact(spark, source="b").unionByName(fact(spark, source="a"))
    bad = bad.filter(~F.col("queried_city").isin("gia-lai", "da-nang"))
    report = am.dq_check(bad, dim(spark, ["ha-noi"]), AS_OF)
    said = {r["check"]: r["message"] for r in report.collect()}
    assert said["source_validity"] == "Invalid sources: 2"
    assert said["city_coverage"] == "Missing cities: ['da-nang', 'gia-lai']"
    assert said["dim_station_city_coverage"] == (
        "Stations missing for cities: ['cao-bang', 'da-nang', 'gia-lai', 'ho-chi-minh-city']"
    )


def test_empty_tables(spark):
    report = am.dq_check(fact(spark).filter("false"), dim(spark, []), AS_OF)
    assert report.count() == 11
    rows = {(r["check"], r["column"]): r for r in report.collect()}
    assert not rows["row_count", None]["passed"]
    assert rows["null_pct", "aqi"]["passed"] and rows["null_pct", "aqi"]["value"] == 0.0
    assert not rows["dim_station_row_count", None]["passed"]
    assert tuple(am.dq_summary(report).first()) == (False, 6, 11)


def test_tables_that_could_not_be_read(spark):
    assert failed(am.dq_check(None, dim(spark), AS_OF)) == ["fact_aqi_query", "freshness"]
    assert failed(am.dq_check(fact(spark), None, AS_OF)) == ["dim_station_query"]
    with pytest.raises(ValueError):
        am.dq_check(None, None, AS_OF)


def test_sources_are_counted_exactly(spark):
    city = F.col("queried_city")
    odd = fact(spark).withColumn(
        "source",
        F.when(city == CITIES[0], "")
        .when(city == CITIES[1], "null")
        .when(city == CITIES[2], "a,b")
        .otherwise("api"),
    )
    report = {r["check"]: r for r in am.dq_check(odd, dim(spark), AS_OF).collect()}
    found = report["source_validity"]
    assert (found["value"], found["passed"], found["message"]) == (3.0, False, "Invalid sources: 3")
    values = am.unexpected_values(odd, "source", ("kaggle", "api")).collect()
    assert sorted(r["source"] for r in values) == ["", "a,b", "null"]


def test_own_thresholds(spark):
    report = am.dq_check(
        fact(spark), dim(spark), AS_OF, cities=("ha-noi",), sources=("x",), min_rows=16, hi=40
    )
    assert failed(report) == ["aqi_range", "row_count", "source_validity"]


def test_missing_values(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert [r["c"] for r in am.missing_values(df, "c", ("a", "z")).collect()] == ["z"]
    assert am.missing_values(df, "c", ("a", "b")).count() == 0


def test_only_the_size_of_the_sampled_report_comes_from_the_sample(spark, tmp_path):
    """One reading of 5,000 is out of range, and one has no kind: no sample of 500 rows may decide about them."""
    number = F.col("id")
    spark.range(1, 5001, numPartitions=1).select(
        number.alias("event_id"),
        F.lit(datetime(2024, 1, 30, 12)).cast("timestamp_ntz").alias("ts"),
        (number % 5).alias("user_id"),
        F.when(number != 4999, "view").alias("event_type"),
        F.when(number == 4998, 900.0).otherwise(20.0).alias("value"),
        F.lit('{"k": 3}').alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    places = spark.range(5)
    customer = places.select(F.col("id").alias("c_custkey"), F.lit("c").alias("c_name"), F.col("id").cast("int").alias("c_nationkey"))
    customer.write.parquet(f"{tmp_path}/customer.parquet")
    nation = customer.select(F.col("c_nationkey").alias("n_nationkey"), F.lit("n").alias("n_name"), F.col("c_nationkey").alias("n_regionkey"))
    nation.write.parquet(f"{tmp_path}/nation.parquet")
    names = [(k, name) for k, name in enumerate(REGIONS)]
    spark.createDataFrame(names, "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    found = {(r["check"], r["column"]): r for r in QUERIES["dq_report_sampled"](spark, str(tmp_path)).collect()}
    assert found["row_count", None]["value"] == 500
    assert (found["aqi_range", "aqi"]["value"], found["aqi_range", "aqi"]["passed"]) == (1, False)
    assert found["null_pct", "dominant_pollutant"]["value"] == 0.02
    assert len(found) == 8
