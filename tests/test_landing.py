import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import aeromart as am
from aeromart.workload import adapters as ad

AT = datetime(2026, 4, 11, 17, 0, 5)


def body(**data):
    return json.dumps({"status": "ok", "data": data}, indent=2, ensure_ascii=False)


BODIES = {
    "ha-noi": body(idx=1, aqi=55, time={"iso": "2026-04-11T23:00:00+07:00"}, note="a\nb"),
    "da-nang": body(idx=2, aqi="-", time={}),
    "gia-lai": body(idx=3),
    "cao-bang": json.dumps({"status": "ok"}),
    "hue": json.dumps({"status": "ok", "data": {"time": "now"}}),
    "vinh": json.dumps({"status": "error", "data": "Unknown station"}),
    "can-tho": json.dumps({"data": {"time": {}}}),
    "da-lat": "<html>",
    "vung-tau": "[1, 2]",
    "phu-quoc": None,
    "nha-trang": json.dumps({"status": "ok", "data": {"time": {"iso": None}, "aqi": None}}),
}


@pytest.fixture
def responses(spark):
    rows = [(f" {city.upper()} ,", text, AT) for city, text in BODIES.items()]
    return spark.createDataFrame(rows, "city string, body string, ingested_at timestamp")


def test_outcomes(responses):
    got = {r["city"]: r for r in am.ingest_outcomes(responses).collect()}
    assert {c: r["outcome"] for c, r in got.items()} == {
        "ha-noi": "success",
        "da-nang": "success",
        "gia-lai": "unknown",
        "cao-bang": "unknown",
        "hue": "unknown",
        "vinh": "api_status",
        "can-tho": "api_status",
        "da-lat": "api_status",
        "vung-tau": "unknown",
        "phu-quoc": "network",
        "nha-trang": "success",
    }

    def told(city):
        return tuple(got[city][c] for c in ("idx", "aqi", "measured_at"))

    assert told("ha-noi") == ("1", "55", "2026-04-11T23:00:00+07:00")
    assert told("da-nang") == ("2", "-", "N/A")
    assert told("nha-trang") == ("N/A", None, None)
    assert told("vinh") == (None, None, None)
    assert got["vinh"]["error"] == "status: error"
    assert got["ha-noi"]["s3_key"].endswith("/day=11/ha-noi_2026-04-11T17-00-05Z.json")


def test_summary(responses):
    assert [tuple(r) for r in am.ingest_summary(responses).collect()] == [
        ("20260411_170005", 11, 3, 8, 1, 3, 4)
    ]


def test_other_column_names(responses):
    renamed = responses.withColumnsRenamed({"city": "c", "body": "b", "ingested_at": "t"})
    names = {"city": "c", "body": "b", "at": "t"}
    assert am.ingest_summary(renamed, **names).collect() == am.ingest_summary(responses).collect()


def test_land_and_read_back(spark, responses, tmp_path):
    path = str(tmp_path / "api_raw")
    assert am.land_bronze(responses, path) == 3
    folders = {str(p.parent.relative_to(path)) for p in Path(path).rglob("*.txt")}
    assert folders == {
        f"queried_city={c}/year=2026/month=04/day=11" for c in ("ha-noi", "da-nang", "nha-trang")
    }
    flat = am.flatten_api(am.read_api_bronze(spark, path, multi_line=False), "now")
    assert {(r["queried_city"], r["waqi_idx"], r["aqi"]) for r in flat.collect()} == {
        ("ha-noi", 1, 55.0),
        ("da-nang", 2, None),
        ("nha-trang", None, None),
    }
    lines = [p.read_text() for p in Path(path).rglob("*.txt") if "ha-noi" in str(p)]
    assert [json.loads(t) for t in lines] == [json.loads(BODIES["ha-noi"])]
    kept = spark.read.parquet(path + "_metadata").select("source", "ingested_at").distinct()
    assert [tuple(r) for r in kept.collect()] == [("waqi_city_endpoint", AT)]


def test_a_large_landing_stays_readable_line_by_line(spark, tmp_path):
    many = spark.range(500).select(
        F.lit("ha-noi").alias("city"),
        F.concat(F.lit('{\n "status": "ok",\r\n "data": {"idx": '), "id", F.lit(', "time": {}}\n}'))
        .alias("body"),
        F.lit(AT).alias("ingested_at"),
    )
    path = str(tmp_path / "raw")
    am.land_bronze(many, path)
    back = am.read_api_bronze(spark, path, multi_line=False)
    assert back.agg(F.count("data.idx"), F.countDistinct("data.idx")).first() == (500, 500)


def test_events_are_spread_before_they_become_documents(spark):
    responses = ad.responses_from_events(spark, "/root/testdata/sf0.001")
    assert "REPARTITION_BY_NUM" in responses._jdf.queryExecution().executedPlan().toString()
