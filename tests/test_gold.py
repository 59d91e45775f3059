from collections import Counter, defaultdict
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

import aeromart as am
from aeromart.fixed import DAILY_SCHEMA, RANKING_SCHEMA, STATION_SCHEMA

SCHEMA = (
    "waqi_idx int, measured_at timestamp, aqi double, dominant_pollutant string, pm25 double, "
    "pm10 double, humidity double, temperature double, queried_city string"
)
DIM = "waqi_idx int, station_name string, lat double, lon double"


def readings(spark, rows):
    """Rows of station, day, hour, aqi, pollutant, pm25, city."""
    full = [
        (s, datetime(2024, 1, d, h), a, p, pm, None, None, None, c) for s, d, h, a, p, pm, c in rows
    ]
    return am.with_year_month(spark.createDataFrame(full, SCHEMA))


ROWS = [
    (1, 1, 0, 40.0, "pm10", 1.0, "x"),
    (1, 1, 1, 60.0, "pm25", 2.0, "x"),
    (2, 1, 2, 50.0, "pm25", None, "x"),
    (2, 1, 3, 51.0, "pm10", 3.0, "x"),
    (1, 2, 0, 320.0, None, 4.0, "x"),
    (3, 1, 0, 10.0, "o3", None, "y"),
    (3, 1, 5, 12.0, None, None, "y"),
    (3, 1, 6, 12.0, None, None, "y"),
    (4, 1, 6, 99.0, "o3", None, None),
]


def test_daily_summary(spark):
    daily = am.daily_summary(readings(spark, ROWS))
    assert set(daily.columns) == set(DAILY_SCHEMA.fieldNames())
    assert daily.columns[-3:] == ["year", "month", "_aggregated_at"]
    rows = {(r["queried_city"], r["date"].day): r for r in daily.collect()}
    first = rows["x", 1]
    assert first["date"] == date(2024, 1, 1)
    assert (first["avg_aqi"], first["max_aqi"], first["min_aqi"]) == (50.25, 60.0, 40.0)
    assert (first["avg_pm25"], first["avg_pm10"]) == (2.0, None)
    assert (first["station_count"], first["record_count"]) == (2, 4)
    assert first["dominant_pollutant"] == "pm10"  # a tie: the smallest
    assert first["pollution_level"] == "Moderate"
    assert rows["x", 2]["pollution_level"] == "Hazardous"
    assert rows["y", 1]["dominant_pollutant"] is None  # NULL is the most frequent
    assert rows[None, 1]["dominant_pollutant"] is None  # no mode for a NULL key
    assert rows[None, 1]["station_count"] == 1


def test_daily_summary_agrees_with_the_plain_aggregate(spark):
    fact = readings(spark, ROWS)
    plain = (
        am.with_date(fact)
        .groupBy("queried_city", "date")
        .agg(
            am.mean2("aqi").alias("avg_aqi"),
            am.mean2("pm25").alias("avg_pm25"),
            F.max("aqi").alias("max_aqi"),
            F.min("aqi").alias("min_aqi"),
            am.distinct_count("waqi_idx").alias("station_count"),
            F.count("*").alias("record_count"),
        )
    )
    expected = sorted(map(str, plain.collect()))
    for daily in (am.daily_summary(fact), am.daily_metrics(fact)):
        assert sorted(map(str, daily.select(*plain.columns).collect())) == expected


def test_month_counts_every_day_once(spark):
    many = [(1, 1, h, 100.0, "a", None, "x") for h in range(20)]
    fact = readings(spark, many + [(1, 2, 0, 10.0, "b", None, "x")])
    ranking = am.city_ranking(am.daily_summary(fact), fact).first()
    assert ranking["avg_aqi"] == 55.0
    assert ranking["record_count"] == 21
    assert (ranking["days_good"], ranking["days_moderate"]) == (1, 1)
    assert ranking["dominant_pollutant"] == "a"
    assert ranking["pollution_level"] == "Moderate"


def test_city_ranks_are_dense_and_null_is_last(spark):
    rows = [
        (1, 1, 0, 80.0, "a", None, "w"),
        (2, 1, 0, 80.0, "a", 5.0, "x"),
        (3, 1, 0, 70.0, "a", 9.0, "y"),
        (4, 1, 0, 60.0, "a", None, "z"),
    ]
    fact = readings(spark, rows)
    ranking = am.city_ranking(am.daily_summary(fact), fact)
    assert ranking.columns == RANKING_SCHEMA.fieldNames()
    got = {r["queried_city"]: (r["aqi_rank"], r["pm25_rank"]) for r in ranking.collect()}
    assert got == {"w": (1, 3), "x": (1, 2), "y": (2, 1), "z": (3, 3)}


def test_station_summary(spark):
    rows = [
        (1, 1, 0, 10.0, "a", None, "x"),
        (1, 1, 1, 20.0, "b", None, "y"),
        (1, 2, 2, 30.0, "b", None, "y"),
        (2, 1, 0, 10.0, "c", 1.0, "x"),
        (3, 1, 0, 5.0, None, 1.0, "x"),
    ]
    dim = spark.createDataFrame(
        [(1, "one", 1.0, 2.0), (1, "uno", 1.0, 2.0), (2, "two", None, None)], DIM
    )
    stations = am.station_summary(readings(spark, rows), dim)
    assert stations.columns == STATION_SCHEMA.fieldNames()
    got = {(r["waqi_idx"], r["queried_city"]): r for r in stations.collect()}
    assert len(got) == 4  # the double dimension row multiplies nothing
    assert got[1, "x"]["dominant_pollutant"] == "b"  # of the station in any city
    assert (got[1, "x"]["station_name"], got[1, "x"]["avg_aqi"]) == ("one", 10.0)
    assert got[3, "x"]["station_name"] is None and got[3, "x"]["dominant_pollutant"] is None
    ranks = {k: r["rank_in_city"] for k, r in got.items()}
    assert ranks == {(1, "x"): 1, (2, "x"): 1, (3, "x"): 2, (1, "y"): 1}


def test_rank_in_city_against_brute_force(spark):
    rows = spark.range(3000).select(
        F.col("id").cast("int").alias("waqi_idx"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias(
            "queried_city"
        ),
        F.lit("2024").alias("year"),
        F.lpad((F.col("id") % 2 + 1).cast("string"), 2, "0").alias("month"),
        F.when(F.col("id") % 11 > 0, F.round(F.abs(F.hash("id")) % 500 / 10, 1)).alias("avg_aqi"),
    )
    got = am.rank_in_city(rows).collect()
    groups = defaultdict(set)
    for r in got:
        groups[r["queried_city"], r["month"]].add(r["avg_aqi"])
    for r in got:
        known = sorted((v for v in groups[r["queried_city"], r["month"]] if v is not None))[::-1]
        rank = known.index(r["avg_aqi"]) + 1 if r["avg_aqi"] is not None else len(known) + 1
        assert r["rank_in_city"] == rank
    assert len(got) == 3000


@pytest.mark.parametrize("keys", [["g"], ["g", "h"]])
def test_mode_per_group_against_brute_force(spark, keys):
    rows = spark.range(2000).select(
        (F.col("id") % 13).alias("g"),
        F.when(F.col("id") % 5 > 0, F.abs(F.hash("id")) % 3).alias("h"),
        F.when(F.col("id") % 4 > 0, (F.abs(F.hash("id", F.lit(1))) % 4).cast("string")).alias("v"),
    )
    counts = defaultdict(Counter)
    for r in rows.collect():
        counts[tuple(r[k] for k in keys)][r["v"]] += 1
    expected = {
        key: min(c, key=lambda v: (-c[v], v is not None, v or "")) for key, c in counts.items()
    }
    got = am.mode_per_group(rows, keys, "v").collect()
    assert {tuple(r[k] for k in keys): r["v"] for r in got} == expected


def test_invariants_on_a_whole_table(spark):
    from aeromart.workload import adapters as ad

    fact = ad.fact_from_lineitem(spark, "/root/testdata/sf0.001").cache()
    daily = am.daily_summary(fact).cache()
    monthly = am.city_ranking(daily, fact)
    assert daily.filter("min_aqi > avg_aqi OR avg_aqi > max_aqi").count() == 0
    assert daily.agg(F.sum("record_count")).first()[0] == fact.count()
    days = daily.groupBy("queried_city", "year", "month").agg(F.count("*").alias("days"))
    total = sum(
        F.col(c)
        for c in (
            "days_good",
            "days_moderate",
            "days_sensitive",
            "days_unhealthy",
            "days_very_unhealthy",
            "days_hazardous",
        )
    )
    joined = monthly.join(days, ["queried_city", "year", "month"])
    assert joined.filter(total != F.col("days")).count() == 0
    lowest = monthly.groupBy("year", "month").agg(F.min("aqi_rank").alias("low"))
    assert lowest.filter("low <> 1").count() == 0
    fact.unpersist()
    daily.unpersist()


def _broken(*_args, **_options):
    raise RuntimeError("lost")


def test_local_days_in_any_session(spark):
    """Two readings of two local days, and one whose local month is the next."""
    rows = [(1, datetime(2024, 1, 31, h, tzinfo=timezone.utc), 5.0, "a", 1.0, 1.0, 1.0, 1.0, "x") for h in (10, 20)]
    fact = am.with_year_month(spark.createDataFrame(rows, SCHEMA))
    zone, found = "Asia/Ho_Chi_Minh", []
    before = spark.conf.get("spark.sql.session.timeZone")
    for session in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", session)
        try:
            daily = am.daily_summary(fact, zone)
            found.append(sorted(str(r["date"]) for r in daily.select("date").collect()))
            ranking = am.city_ranking(daily, fact, tz=zone).collect()
            assert sorted((r["month"], r["dominant_pollutant"]) for r in ranking) == [("01", "a"), ("02", "a")]
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [["2024-01-31", "2024-02-01"]] * 2


def test_refresh_of_changed_months_equals_a_full_one(spark, tmp_path):
    fact_path, dim_path = str(tmp_path / "fact"), str(tmp_path / "dim")
    first = datetime(2024, 3, 1, tzinfo=timezone.utc)
    second = datetime(2024, 3, 2, tzinfo=timezone.utc)

    def rows(days, at):
        made = [
            (s, datetime(2024, m, d, 1), 10.0 * s * m + d, "ab"[d % 2], 1.0 * d, None, None, None, "x")
            for s in (1, 2)
            for m, d in days
        ]
        df = spark.createDataFrame(made, SCHEMA)
        for name in ("co", "no2", "o3", "so2", "pressure", "wind"):
            df = df.withColumn(name, F.lit(None).cast("double"))
        return am.select_fact(
            df.withColumns({"source": F.lit("api"), "ingested_at": F.lit(at.isoformat())})
        )

    dim = spark.createDataFrame(
        [(1, "one", "x", 1.0, 2.0, "u", "api"), (2, "two", "x", 1.0, 2.0, "u", "api")],
        "waqi_idx int, station_name string, queried_city string, lat double, lon double, "
        "url string, source string",
    )
    assert am.write_dim(dim, dim_path) == 2
    assert am.write_fact(rows([(1, 1), (1, 2), (2, 1)], first), fact_path) == 6
    gold, full = str(tmp_path / "gold"), str(tmp_path / "full")
    done = am.refresh_gold(spark, fact_path, dim_path, gold, first, full=False)
    assert tuple(done) == (None, 3, 2, 4)
    am.write_fact(rows([(2, 2), (2, 3)], second), fact_path)
    done = am.refresh_gold(spark, fact_path, dim_path, gold, second, full=False)
    assert tuple(done) == (1, 3, 2, 2)
    again = am.refresh_gold(spark, fact_path, dim_path, gold, second, full=False)
    assert tuple(again) == (0, 0, 0, 0)
    # A load with an older instant than the last refresh is seen like any other.
    am.write_fact(rows([(1, 3)], datetime(2023, 1, 1, tzinfo=timezone.utc)), fact_path)
    assert am.refresh_gold(spark, fact_path, dim_path, gold, second).months == 1
    # A refresh that broke off before it was noted is made good by the next one.
    am.write_fact(rows([(2, 4)], second), fact_path)
    with pytest.raises(RuntimeError):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr("aeromart.plans.gold.write_ranking", _broken)
            am.refresh_gold(spark, fact_path, dim_path, gold, second)
    assert am.refresh_gold(spark, fact_path, dim_path, gold, second).months == 1
    am.refresh_gold(spark, fact_path, dim_path, full, second, full=True)

    def tables(root):
        return [
            sorted(map(str, read(spark, f"{root}/{name}").drop("_aggregated_at").collect()))
            for read, name in (
                (am.read_daily, "gold_aqi_daily_summary"),
                (am.read_ranking, "gold_aqi_city_ranking"),
                (am.read_station_summary, "gold_station_summary"),
            )
        ]

    assert tables(gold) == tables(full)
    stamps = am.read_daily(spark, f"{gold}/gold_aqi_daily_summary").select("month", "_aggregated_at")
    assert {(r[0], r[1].day) for r in stamps.collect()} == {("01", 2), ("02", 2)}
