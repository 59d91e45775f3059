"""Broken documents, bucketed tables, seeded samples, sketches, and a gated run on merged results."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

import aeromart as am
from aeromart.sources.writers import unseen_in_bucketed
from test_partials import fact_rows
from test_silver import document, write_documents

AS_OF = datetime(2026, 4, 12, 12, tzinfo=timezone.utc)


def test_broken_files_are_kept_and_good_rows_unchanged(spark, tmp_path):
    """Whole files of the feed: one cut short, one web page, one empty object, one with an odd type in one field."""
    src, root = tmp_path / "bronze", str(tmp_path)
    write_documents(src, [document(1), document(2), document(3)])
    folder = next(p.parent for p in src.rglob("*.json"))
    broken = ['{"status": "ok", "data": {"idx": 7, ', "<html>busy</html>\nagain"]
    for k, text in enumerate(broken):
        (folder / f"broken{k}.json").write_text(text)
    (folder / "empty.json").write_text("{}")
    (folder / "odd.json").write_text('{"status": "ok", "data": {"idx": "A12", "aqi": 5}}')
    for checkpoint, new in (("first", 3), ("lost", 0)):
        run = am.run_incremental(
            spark, str(src), f"{root}/{checkpoint}", f"{root}/fact", f"{root}/dim", AS_OF,
            quarantine=f"{root}/quarantine",
        ).first()
        assert (run["raw_rows"], run["fresh_rows"], run["new_rows"]) == (7, 3, new)
        assert (run["dropped_rows"], run["unreadable_rows"]) == (2, 2)
    kept = am.read_quarantine(spark, f"{root}/quarantine").collect()
    assert sorted(r["document"].strip() for r in kept) == sorted(text.strip() for text in broken)
    assert all(r["copies"] == 1 and "/broken" in r["file"] for r in kept)
    assert sorted(r["waqi_idx"] for r in am.read_fact(spark, f"{root}/fact").collect()) == [1, 2, 3]
    plain = am.flatten_api(am.read_api_bronze(spark, str(src)), "now").collect()
    checked = am.flatten_api(am.read_api_bronze_checked(spark, str(src)), "now").collect()
    assert sorted(map(str, plain)) == sorted(map(str, checked))


def test_only_the_batch_is_shuffled_to_a_bucketed_table(spark, tmp_path):
    keys, path = ("waqi_idx", "measured_at"), str(tmp_path / "fact")
    days = [(m, d, h) for m in (1, 2) for d in (1, 2, 3) for h in (0, 5)]
    first, more = fact_rows(spark, days), fact_rows(spark, days + [(3, 1, 0)], stations=(1, 2, 3))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert am.insert_bucketed(first, "am_bucketed", path, keys, 4, ("queried_city",)) == 24
        plan = unseen_in_bucketed(more, "am_bucketed", keys)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        table_side = plan[plan.index("Bucketed: true") - 600 : plan.index("Bucketed: true")]
        assert "Exchange" not in table_side.rpartition("SortMergeJoin")[2].rpartition("Scan parquet")[2]
        assert am.insert_bucketed(more, "am_bucketed", path, keys, 4, ("queried_city",)) == 15
        assert am.insert_bucketed(more, "am_bucketed", path, keys, 4, ("queried_city",)) == 0
        assert spark.table("am_bucketed").count() == 39
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS am_bucketed")


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    keys, path = ("waqi_idx", "measured_at"), tmp_path / "fact"
    rows = fact_rows(spark, [(1, d, h) for d in range(1, 29) for h in range(24)], stations=range(1, 11)).repartition(8)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "4096")
    try:
        assert am.insert_bucketed(rows.filter("waqi_idx > 5"), "am_parts", str(path), keys, 2) == 3360
        assert len(list(path.glob("*.parquet"))) > 2
        assert am.insert_bucketed(rows, "am_parts", str(path), keys, 2) == 3360
        assert am.insert_bucketed(rows, "am_parts", str(path), keys, 2) == 0
        assert spark.table("am_parts").distinct().count() == spark.table("am_parts").count() == 6720
    finally:
        spark.conf.set(size, before)
        spark.sql("DROP TABLE IF EXISTS am_parts")


def test_a_seeded_sample_is_the_same_however_the_rows_lie(spark):
    rows = spark.range(20_000).select("id", (F.col("id") % 5000).alias("k"))
    one = am.sample_by_key(rows, 0.2, 3, ["k"])
    other = am.sample_by_key(rows.repartition(13), 0.2, 3, ["k"])
    assert sorted(r["id"] for r in one.collect()) == sorted(r["id"] for r in other.collect())
    keys = {r["k"] for r in one.collect()}
    assert one.count() == 4 * len(keys) and 0.17 < len(keys) / 5000 < 0.23  # rows of a key go together
    assert keys != {r["k"] for r in am.sample_by_key(rows, 0.2, 4, ["k"]).collect()}
    assert am.sample_by_key(rows, 0, 3, ["k"]).count() == 0 and am.sample_by_key(rows, 1, 3, ["k"]).count() == 20_000


def test_sketches_of_days_merge_within_the_stated_error(spark):
    fact = spark.range(60_000).select(
        F.lit("x").alias("queried_city"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 30 * 86_400).alias("measured_at"),
        (F.col("id") % 20_011).cast("int").alias("waqi_idx"),
    )
    keys = ["queried_city", "year", "month"]
    for lg_k in (10, 12):
        (row,) = am.approx_stations(am.station_sketches(fact, lg_k=lg_k), keys).collect()
        assert abs(row["station_count"] / 20_011 - 1) <= 4 * am.sketch_error(lg_k)
    assert am.daily_metrics(fact.withColumns({m: F.lit(1.0) for m in ("aqi", "pm25", "pm10", "humidity", "temperature")})).agg(F.min("station_count")).first()[0] == 2000


@pytest.mark.parametrize("value, wanted", [("12", 12.0), ('"12.5"', 12.5), ('"-"', None), ('{"int": 3, "string": "x"}', 3.0), ('{"double": 1.5, "int": 2}', 1.5), ("null", None), ("[1]", None), ("true", None)])
def test_numbers_of_any_json_type(spark, value, wanted):
    doc = F.parse_json(F.lit('{"a": {"b": ' + value + "}}"))
    got = spark.range(1).select(am.resolve_variant(doc, "$.a.b").alias("b"), am.resolve_variant(doc, "$.a.c").alias("c")).first()
    assert tuple(got) == (wanted if value != "true" else got["b"], None)


def test_a_gated_run_on_merged_results_equals_a_plain_one(spark, tmp_path):
    found = []
    for merged in (False, True):
        root = tmp_path / str(merged)
        for k, documents in enumerate(([document(1), document(2)], [document(2, iso="2026-04-12T09:00:00+07:00"), document(3, aqi="-")])):
            write_documents(root / "bronze", documents, start=10 * k)
            run = am.run_pipeline(
                spark, str(root / "bronze"), str(root / "checkpoint"), str(root / "silver"), str(root / "gold"), AS_OF,
                cities=("ha-noi",), min_rows=1, merged=merged, stamped_at=AS_OF,
            ).first()
        daily = am.read_daily(spark, str(root / "gold/gold_aqi_daily_summary")).drop("_aggregated_at")
        stations = am.read_station_summary(spark, str(root / "gold/gold_station_summary")).drop("_aggregated_at")
        found.append((run.asDict(), sorted(map(str, daily.collect())), sorted(map(str, stations.collect()))))
    assert found[0] == found[1] and found[0][0]["quality_passed"] and found[0][1]
    # Stamps of the run, not of today, decide about freshness.
    assert found[0][0]["checks_passed"] == found[0][0]["checks_total"]
