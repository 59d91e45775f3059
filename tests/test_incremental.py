from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

import aeromart as am
from test_silver import csv_line, document, history, write_documents  # noqa: F401

AS_OF = datetime(2026, 4, 12, 12, tzinfo=timezone.utc)
CITIES = ("ha-noi", "da-nang")


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.src = root / "bronze"
        self.fact, self.dim = str(root / "fact"), str(root / "dim")

    def load(self, as_of=AS_OF, checkpoint="checkpoint", **options):
        run = am.run_incremental(
            self.spark,
            str(self.src),
            str(self.root / checkpoint),
            self.fact,
            self.dim,
            as_of,
            **options,
        ).first()
        return tuple(
            run[c] for c in ("status", "raw_rows", "fresh_rows", "new_stations", "new_rows")
        )

    def rows(self):
        return am.read_fact(self.spark, self.fact)


@pytest.fixture
def lake(spark, tmp_path):
    (tmp_path / "bronze").mkdir()
    return Lake(spark, tmp_path)


def test_each_file_is_loaded_once_and_each_reading_kept_once(lake):
    assert lake.load() == ("SKIPPED", 0, 0, 0, 0)
    write_documents(lake.src, [document(1), document(1), document(2), document(3, aqi="-")])
    assert lake.load() == ("LOADED", 4, 3, 2, 2)
    assert lake.load() == ("SKIPPED", 0, 0, 0, 0)
    # The same reading again, in a new file and under another city.
    write_documents(lake.src, [document(1), document(4)], city="da-nang", start=10)
    assert lake.load() == ("LOADED", 2, 2, 1, 1)
    # Everything again, from a lost checkpoint.
    assert lake.load(checkpoint="second") == ("LOADED", 6, 5, 0, 0)
    assert sorted(r["waqi_idx"] for r in lake.rows().collect()) == [1, 2, 4]


def test_stale_readings_skip_the_run(lake):
    write_documents(lake.src, [document(1, iso="2026-04-01T08:00:00+07:00")])
    assert lake.load() == ("SKIPPED", 1, 0, 0, 0)


def test_a_known_station_keeps_its_row(lake):
    write_documents(lake.src, [document(1, geo=(1.0, 2.0))])
    lake.load()
    write_documents(
        lake.src, [document(1, geo=(8.0, 9.0), iso="2026-04-12T09:00:00+07:00")], start=5
    )
    assert lake.load() == ("LOADED", 1, 1, 0, 1)
    assert [(r["lat"], r["lon"]) for r in am.read_dim(lake.spark, lake.dim).collect()] == [(1.0, 2.0)]


@pytest.mark.parametrize("order", [(90, 80, 70), (70, 90, 80), (80, 70, 90)])
def test_the_order_of_the_files_does_not_matter(lake, order):
    write_documents(lake.src, [document(1, aqi=aqi) for aqi in order])
    assert lake.load() == ("LOADED", 3, 3, 1, 1)
    assert [r["aqi"] for r in lake.rows().collect()] == [70]


def test_readings_without_a_station_are_dropped_and_counted(lake):
    write_documents(lake.src, [document(1), document(None), document(2)])
    run = am.run_incremental(
        lake.spark, str(lake.src), str(lake.root / "c"), lake.fact, lake.dim, AS_OF
    ).first()
    assert (run["raw_rows"], run["fresh_rows"], run["dropped_rows"]) == (3, 2, 1)
    assert sorted(r["waqi_idx"] for r in lake.rows().collect()) == [1, 2]


def test_csv_ids_that_are_no_numbers_are_not_one_station(spark, history, tmp_path):
    src = history(*[csv_line(station=s) for s in ("7", "A7", "12.0", "3000000000")])
    run = am.load_csv_once(
        spark, src, str(tmp_path / "c"), str(tmp_path / "fact"), str(tmp_path / "dim")
    ).first()
    assert (run["raw_rows"], run["new_stations"], run["new_rows"], run["dropped_rows"]) == (1, 1, 1, 3)


def test_csv_is_loaded_once(spark, history, tmp_path):
    src = history(csv_line(), csv_line(), csv_line(station="2", name="Da Nang", aqi="-"))

    def load(checkpoint="checkpoint"):
        run = am.load_csv_once(
            spark, src, str(tmp_path / checkpoint), str(tmp_path / "fact"), str(tmp_path / "dim")
        ).first()
        return tuple(run[c] for c in ("status", "raw_rows", "fresh_rows", "new_stations", "new_rows"))

    assert load() == ("LOADED", 3, 2, 2, 1)
    assert load() == ("SKIPPED", 0, 0, 0, 0)
    history(csv_line(station="3", at="2021-09-21 22:00:00"), file="later.csv")
    assert load() == ("LOADED", 1, 1, 1, 1)
    assert load("second") == ("LOADED", 4, 3, 0, 0)
    fact = am.read_fact(spark, str(tmp_path / "fact"))
    assert {r["month"] for r in fact.collect()} == {"01", "09"}
    ranking = am.city_ranking(am.daily_summary(fact), fact)
    assert [r["dominant_pollutant"] for r in ranking.collect()] == ["pm25", "pm25"]


def test_insert_looks_into_the_months_of_the_batch_only(spark, tmp_path):
    from aeromart.sources.writers import in_span, span

    rows = spark.createDataFrame(
        [(1, "x", "2024", "01"), (2, "x", "2024", "02"), (3, "y", "2024", "02")],
        "id int, queried_city string, year string, month string",
    )
    path = str(tmp_path / "t")
    rows.write.partitionBy("queried_city", "year", "month").parquet(path)
    table = spark.read.schema(rows.schema).parquet(path)
    months = span(rows.filter("id > 1"), ("year", "month"))
    assert months == ("2024/02", "2024/02")
    kept = in_span(table, ("year", "month"), months)
    assert sorted(r["id"] for r in kept.collect()) == [2, 3]
    scan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(concat_ws" in scan
    assert in_span(table, ("year", "month"), span(rows.filter("false"), ("year", "month"))).count() == 0


def test_tables_in_the_catalog(spark, tmp_path):
    write_documents(tmp_path / "bronze", [document(1)])
    fact, dim = am.api_to_silver(am.read_api_bronze(spark, str(tmp_path / "bronze")), AS_OF)
    try:
        am.write_dim(dim, str(tmp_path / "dim"), table="dim_station")
        am.write_fact(fact, str(tmp_path / "fact"), table="fact_aqi")
        am.write_fact(fact, str(tmp_path / "fact"), table="fact_aqi")
        assert spark.table("fact_aqi").select("waqi_idx", "month").collect() == [(1, "04")]
        assert spark.table("dim_station").count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS fact_aqi")
        spark.sql("DROP TABLE IF EXISTS dim_station")


def test_replacing_the_dimension(spark, tmp_path):
    write_documents(tmp_path / "bronze", [document(1), document(2)])
    _, dim = am.api_to_silver(am.read_api_bronze(spark, str(tmp_path / "bronze")), AS_OF)
    path = str(tmp_path / "dim")
    assert am.write_dim(dim, path) == 2
    assert am.write_dim(dim.filter("waqi_idx = 2"), path, replace=True) == 1
    assert [r["waqi_idx"] for r in am.read_dim(spark, path).collect()] == [2]


def test_gate(spark, tmp_path):
    src = tmp_path / "bronze"
    docs = [document(i, iso=f"2026-04-12T0{i % 9}:00:00+07:00") for i in range(8)]
    write_documents(src, docs)

    def run():
        return am.run_pipeline(
            spark,
            str(src),
            str(tmp_path / "checkpoint"),
            str(tmp_path / "silver"),
            str(tmp_path / "gold"),
            AS_OF,
            cities=CITIES,
        ).first()

    first = run()
    assert not first["quality_passed"]  # too few rows, one city missing in both tables
    assert (first["checks_passed"], first["checks_total"]) == (8, 11)
    assert first["outcome"] == "stopped: checks failed"
    assert not (tmp_path / "gold").exists()
    write_documents(src, [document(i + 20) for i in range(4)], city="da-nang")
    second = run()
    assert second["quality_passed"] and second["outcome"] == "gold refreshed"
    assert [second[c] for c in ("daily_rows", "ranking_rows", "station_rows")] == [3, 2, 12]
    gold = str(tmp_path / "gold")
    daily = am.read_daily(spark, f"{gold}/gold_aqi_daily_summary")
    assert daily.agg(F.sum("record_count")).first()[0] == 12
    assert am.read_ranking(spark, f"{gold}/gold_aqi_city_ranking").count() == 2
    assert am.read_station_summary(spark, f"{gold}/gold_station_summary").count() == 12
    third = run()  # nothing new: the load is skipped, the checks still decide
    assert (third["load_status"], third["outcome"]) == ("SKIPPED", "gold refreshed")


def test_gate_without_any_table(spark, tmp_path):
    (tmp_path / "bronze").mkdir()
    row = am.run_pipeline(
        spark,
        str(tmp_path / "bronze"),
        str(tmp_path / "c"),
        str(tmp_path / "s"),
        str(tmp_path / "g"),
        AS_OF,
    ).first()
    assert (row["load_status"], row["quality_passed"]) == ("SKIPPED", False)
