import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import aeromart as am
from aeromart.fixed import FACT_SCHEMA

AS_OF = datetime(2026, 4, 12, 12, 0, 0, 500, tzinfo=timezone.utc)


def document(idx=1, aqi=55, pollutant="pm25", iso="2026-04-12T08:00:00+07:00", geo=(21.0, 105.8)):
    return {
        "status": "ok",
        "data": {
            "idx": idx,
            "aqi": aqi,
            "dominentpol": pollutant,
            "city": {"name": f"Station {idx}", "url": f"u/{idx}", "geo": list(geo)},
            "time": {"iso": iso},
            "iaqi": {"pm25": {"v": 55}, "pm10": {"v": 20.5}, "t": {"v": "warm"}},
        },
    }


def write_documents(folder, documents, city="ha-noi", day="12", start=0):
    target = folder / f"queried_city={city}/year=2026/month=04/day={day}"
    target.mkdir(parents=True, exist_ok=True)
    for i, doc in enumerate(documents, start):
        text = json.dumps(doc, ensure_ascii=False, indent=2)
        (target / f"{city}_{i}.json").write_text(text, encoding="utf-8")


@pytest.fixture
def raw(spark, tmp_path):
    write_documents(
        tmp_path,
        [
            document(1),
            document(2, aqi="-"),
            document(3, geo=(10.5,)),
            {"status": "error", "data": "Unknown station"},
        ],
    )
    return am.read_api_bronze(spark, str(tmp_path))


def test_read_api_bronze_keeps_partition_text(raw):
    assert raw.count() == 4
    assert {tuple(r) for r in raw.select("queried_city", "year", "month", "day").collect()} == {
        ("ha-noi", "2026", "04", "12")
    }


def test_flatten_api(raw):
    rows = {r["waqi_idx"]: r for r in am.flatten_api(raw, "now").collect()}
    assert set(rows) == {1, 2, 3, None}
    one = rows[1]
    assert one["measured_at"] == datetime(2026, 4, 12, 1, 0)
    assert (one["aqi"], one["pm25"], one["pm10"], one["co"], one["temperature"]) == (
        55.0,
        55.0,
        20.5,
        None,
        None,
    )
    assert rows[2]["aqi"] is None
    assert (rows[3]["lat"], rows[3]["lon"]) == (10.5, None)
    assert (one["source"], one["ingested_at"]) == ("api", "now")


def test_flatten_api_of_choice_structs(spark):
    schema = (
        "queried_city string, data struct<idx:int, aqi:struct<int:int,string:string>, "
        "city:struct<name:string, url:string, geo:array<double>>, time:struct<iso:string>, "
        "iaqi:struct<pm25:struct<v:struct<double:double,int:int>>, pm10:struct<v:int>>>"
    )
    rows = [
        ("x", (1, (7, None), ("n", "u", [1.0, 2.0]), ("2026-04-12T08:00:00Z",), (((None, 3),), (4,)))),
        ("x", (2, (None, "-"), ("n", "u", []), ("bad",), (((2.5, None),), (None,)))),
    ]
    flat = am.flatten_api(spark.createDataFrame(rows, schema), "now").orderBy("waqi_idx")
    got = flat.select("aqi", "pm25", "pm10", "lat", "dominant_pollutant").collect()
    assert [tuple(r) for r in got] == [(7.0, 3.0, 4.0, 1.0, None), (None, 2.5, None, None, None)]


def test_ok_responses(raw):
    assert am.ok_responses(raw).count() == 3


def test_api_to_silver(raw):
    fact, dim = am.api_to_silver(raw, AS_OF)
    assert fact.columns == FACT_SCHEMA.fieldNames()
    assert sorted(r["waqi_idx"] for r in fact.collect()) == [1, 3]
    assert {(r["year"], r["month"]) for r in fact.collect()} == {("2026", "04")}
    assert sorted(r["waqi_idx"] for r in dim.collect()) == [1, 3]


def test_drop_stale_keeps_the_threshold(spark):
    limit = datetime(2026, 4, 10, 12, 0, 0)
    rows = [(limit,), (limit - timedelta(seconds=1),), (None,)]
    kept = am.drop_stale(spark.createDataFrame(rows, "measured_at timestamp"), AS_OF, 48)
    assert [r[0] for r in kept.collect()] == [limit]


def test_dedup_latest_is_a_total_order(spark):
    rows = [
        (1, "t", "2024-01-01", 5.0),
        (1, "t", "2024-01-02", 9.0),
        (1, "t", "2024-01-02", 7.0),
        (1, "t", "2024-01-02", None),
        (None, "t", "2024-01-01", 1.0),
        (None, "t", "2024-01-01", 2.0),
    ]
    schema = "waqi_idx int, measured_at string, ingested_at string, aqi double"
    for order in (rows, rows[::-1]):
        got = am.dedup_latest(spark.createDataFrame(order, schema)).collect()
        assert {(r["waqi_idx"], r["aqi"]) for r in got} == {(1, None), (None, 1.0)}


def test_dedup_of_one_hot_key_is_cut_before_the_shuffle(spark):
    copies = spark.range(0, 50_000, 1, 8).select(
        F.floor(F.col("id") / 50_000).alias("waqi_idx"),
        F.floor(F.col("id") / 50_000).alias("measured_at"),
        F.format_string("%08d", F.col("id")).alias("ingested_at"),
    )
    kept = am.dedup_latest(copies)
    assert [r["ingested_at"] for r in kept.collect()] == ["00049999"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("Exchange") :]


def test_new_only_and_union(spark):
    new = spark.createDataFrame([(1, "n"), (2, "n"), (None, "n")], "waqi_idx int, s string")
    old = spark.createDataFrame([(2, "o"), (3, "o"), (3, "o")], "waqi_idx int, s string")
    fresh = am.new_only(new, old)
    assert sorted(map(str, (r["waqi_idx"] for r in fresh.collect()))) == ["1", "None"]
    assert am.union_rows(old, fresh).count() == 5
    with_null = old.unionByName(spark.createDataFrame([(None, "o")], "waqi_idx int, s string"))
    assert [r["waqi_idx"] for r in am.new_only(new, with_null).collect()] == [1]


HEADER = (
    "Station ID,AQI index,Location,Station Name,Url,Dominent pollutant,Co,Dew,Humidity,No2,O3,"
    "Pressure,Pm10,PM2.5,So2,Temperature,Wind,Data Time S,Data Time Tz,Status,Alert_level"
)


def csv_line(
    station="1",
    aqi="60",
    location='"21.0, 105.8"',
    name="Hanoi US Consulate",
    pollutant="pm25",
    pressure='"1,012"',
    pm25="55.5",
    at="2021-01-21 22:00:00",
    zone="+07:00",
):
    return (
        f"{station},{aqi},{location},{name},u/{station},{pollutant},-,1,70,N/A,#NAME?,{pressure},"
        f"20,{pm25},,30,1.5,{at},{zone},ok,none"
    )


@pytest.fixture
def history(tmp_path):
    def write(*lines, file="part.csv"):
        (tmp_path / "csv").mkdir(exist_ok=True)
        (tmp_path / "csv" / file).write_text("\n".join([HEADER, *lines]), encoding="utf-8")
        return str(tmp_path / "csv")

    return write


def test_csv_to_silver(spark, history):
    path = history(
        csv_line(),
        csv_line(station="2", name="Hồ Chí Minh", pollutant="aqi"),
        csv_line(station="3", name="cao bằng"),
        csv_line(station="4", name="Da Nang", aqi="-"),
        csv_line(station="5", name="Gia Lai", zone="", location="21.0"),
        csv_line(station="", name="Gia Lai"),
    )
    raw = am.read_csv_bronze(spark, path)
    assert "station id" in raw.columns and "pm2.5" in raw.columns
    fact, dim = am.csv_to_silver(raw, "now")
    assert fact.columns == FACT_SCHEMA.fieldNames()
    row = fact.collect()
    assert len(row) == 1
    row = row[0]
    assert row["measured_at"] == datetime(2021, 1, 21, 15, 0)
    assert (row["aqi"], row["pm25"], row["pressure"], row["co"], row["o3"]) == (
        60.0,
        55.5,
        1012.0,
        None,
        None,
    )
    assert (row["queried_city"], row["year"], row["month"]) == ("ha-noi", "2021", "01")
    stations = {r["waqi_idx"]: r for r in dim.collect()}
    assert set(stations) == {1, 2, 4, 5}
    assert (stations[5]["lat"], stations[5]["lon"]) == (21.0, None)
    assert stations[2]["queried_city"] == "ho-chi-minh-city"


def test_an_invalid_duplicate_does_not_shadow_a_valid_reading(spark, history):
    path = history(csv_line(aqi="-"), csv_line(aqi="60"), csv_line(pollutant="-"))
    fact, _ = am.csv_to_silver(am.read_csv_bronze(spark, path), "now")
    assert [r["aqi"] for r in fact.collect()] == [60.0]


def test_csv_pressure_as_choice_struct(spark, history):
    raw = am.read_csv_bronze(spark, history(csv_line(), csv_line(at="2021-02-01 00:00:00")))
    double = F.when(F.col("data time s") < "2021-02", F.lit(1012.0))
    text = F.when(F.col("data time s") >= "2021-02", F.lit("1,013"))
    choice = raw.withColumn("pressure", F.struct(double.alias("double"), text.alias("string")))
    fact, _ = am.csv_to_silver(choice, "now")
    assert sorted(r["pressure"] for r in fact.collect()) == [1012.0, 1013.0]


def test_csv_files_with_another_column_order_are_refused(spark, history):
    path = history(csv_line())
    names = HEADER.split(",")
    swapped = ",".join([names[1], names[0], *names[2:]])
    Path(path, "z.csv").write_text("\n".join([swapped, csv_line(station="9")]))
    with pytest.raises(Exception, match="(?i)header"):
        am.read_csv_bronze(spark, path).agg(F.max("station id"), F.max("aqi index")).collect()


def test_read_dim_of_a_missing_table(spark, tmp_path):
    path = str(tmp_path / "none")
    assert am.read_dim(spark, path, missing_ok=True).count() == 0
    with pytest.raises(AnalysisException):
        am.read_dim(spark, path)
