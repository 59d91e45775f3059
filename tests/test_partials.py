"""Refreshes that break off, and results merged from the partials that loads keep."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

import aeromart as am
from aeromart.fixed import FACT_SCHEMA
from aeromart.sources import writers
from aeromart import session
from aeromart.plans import gold as gold_module
from aeromart.sources import partials as parts_module

AT = datetime(2024, 3, 1, tzinfo=timezone.utc)
GOLD = {
    "gold_aqi_daily_summary": am.read_daily,
    "gold_aqi_city_ranking": am.read_ranking,
    "gold_station_summary": am.read_station_summary,
}


def fact_rows(spark, days, stations=(1, 2), stamp="2024-03-01T00:30:00", city="x"):
    """One reading for each station and (month, day, hour), with every third AQI missing from the range."""
    made = [
        (s, datetime(2024, m, d, h), 10.0 * s * m + d, "abc"[(d + h) % 3], 1.5 * d, stamp, city)
        for s in stations
        for m, d, h in days
    ]
    df = spark.createDataFrame(
        made,
        "waqi_idx int, measured_at timestamp, aqi double, dominant_pollutant string, pm25 double, "
        "ingested_at string, queried_city string",
    )
    for name in ("pm10", "co", "no2", "o3", "so2", "humidity", "temperature", "pressure", "wind"):
        df = df.withColumn(name, F.lit(None).cast("double"))
    return am.select_fact(df.withColumn("source", F.lit("api")))


@pytest.fixture
def lake(spark, tmp_path):
    dim = spark.createDataFrame(
        [(s, f"name {s}", "x", 1.0, 2.0, "u", "api") for s in (1, 2, 3)],
        "waqi_idx int, station_name string, queried_city string, lat double, lon double, "
        "url string, source string",
    )
    am.write_dim(dim, str(tmp_path / "dim"))
    return str(tmp_path / "fact"), str(tmp_path / "dim"), str(tmp_path)


def tables(spark, root):
    return [sorted(map(str, read(spark, f"{root}/{name}").drop("_aggregated_at").collect())) for name, read in GOLD.items()]


def rebuilt(spark, lake, tz=None):
    fact, dim, root = lake
    am.refresh_gold(spark, fact, dim, f"{root}/rebuilt", AT, full=True, tz=tz)
    return tables(spark, f"{root}/rebuilt")


@pytest.mark.parametrize(
    "write, full",
    [("write_station_summary", True), ("write_daily", False), ("write_daily", True), ("write_ranking", False)],
)
def test_a_refresh_broken_at_any_write_is_made_good(spark, lake, monkeypatch, write, full):
    fact, dim, root = lake
    gold = f"{root}/gold"
    am.write_fact(fact_rows(spark, [(1, 1, 0), (1, 2, 0), (2, 1, 0)]), fact)
    am.refresh_gold(spark, fact, dim, gold, AT)
    am.write_fact(fact_rows(spark, [(2, 2, 0), (2, 3, 5)]), fact)

    def broken(df, path, *args, dynamic=False, **options):
        # What an overwrite removes before it writes: the touched months, or everything.
        session.remove(df.sparkSession, f"{path}/year=2024/month=02" if dynamic else path)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(gold_module, write, broken)
        am.refresh_gold(spark, fact, dim, gold, AT, full=full)
    done = am.refresh_gold(spark, fact, dim, gold, AT)
    assert done.months == (None if full else 1)
    assert tables(spark, gold) == rebuilt(spark, lake)
    assert am.refresh_gold(spark, fact, dim, gold, AT) == (0, 0, 0, 0)


def test_broken_refreshes_are_counted_from_the_last_finished_one(spark, tmp_path):
    from aeromart.sources.readers import broken_refresh
    from aeromart.sources.writers import note_refresh, note_start

    gold = str(tmp_path)
    assert broken_refresh(spark, gold) is None
    first = note_start(spark, gold, full=True)
    assert broken_refresh(spark, gold) == "full"
    second = note_start(spark, gold, full=False)
    assert (first, second, broken_refresh(spark, gold)) == (1, 2, "full")
    note_refresh(spark, gold, 5, second)
    assert broken_refresh(spark, gold) is None
    note_start(spark, gold, full=False)
    assert broken_refresh(spark, gold) == "months"


def test_registered_tables_keep_their_other_months(spark, lake):
    """A refresh of some months into catalog tables leaves the rows of the other months."""
    fact, dim, root = lake
    names = {k: f"am_partials_{k}" for k in ("daily", "ranking", "station")}
    am.write_fact(fact_rows(spark, [(1, 1, 0), (2, 1, 0)]), fact)
    am.refresh_gold(spark, fact, dim, f"{root}/gold", AT, tables=names)
    am.write_fact(fact_rows(spark, [(2, 2, 0)]), fact)
    am.refresh_gold(spark, fact, dim, f"{root}/gold", AT, tables=names)
    try:
        found = [sorted(map(str, spark.table(names[k]).drop("_aggregated_at").collect())) for k in ("daily", "ranking", "station")]
        assert [len(t) for t in found] == [3, 2, 4]
        assert tables(spark, f"{root}/gold") == rebuilt(spark, lake)
    finally:
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("tz", [None, "Asia/Ho_Chi_Minh"])
def test_gold_from_states_equals_the_rebuild_and_reads_no_old_rows(spark, lake, monkeypatch, tz):
    fact, dim, root = lake
    kept = (am.station_day_partials(tz),)
    am.write_fact(fact_rows(spark, [(1, 1, 0), (1, 31, 20), (2, 1, 0)]), fact, partials=kept)
    am.refresh_gold(spark, fact, dim, f"{root}/gold", AT, tz=tz, states=True)
    # Late readings of a known month, one of them there already, and readings in another city.
    am.write_fact(fact_rows(spark, [(1, 1, 0), (1, 1, 3), (2, 1, 0)], stations=(1, 3)), fact, partials=kept)
    am.write_fact(fact_rows(spark, [(1, 31, 22)], stations=(2,), city="y"), fact, partials=kept)
    with monkeypatch.context() as patch:
        patch.setattr(parts_module, "read_fact", None)  # no load needs a rebuild
        states = am.read_partials(spark, fact, kept[0])
        am.refresh_gold(spark, fact, dim, f"{root}/gold", AT, tz=tz, states=True)
    assert tables(spark, f"{root}/gold") == rebuilt(spark, lake, tz)
    files = gold_module._States(states, tz).daily(states).inputFiles()
    assert files and not any(f"{fact}/" in f for f in files)


def test_parts_of_broken_and_unnoted_loads(spark, lake, monkeypatch):
    fact, dim, _ = lake
    kind = am.check_partials()

    def total():
        return am.read_partials(spark, fact, kind).agg(F.sum("rows"), F.sum("null_aqi")).first()

    am.write_fact(fact_rows(spark, [(1, 1, 0), (2, 1, 0)]), fact)  # kept nothing
    assert tuple(total()) == (4, 0)
    am.write_fact(fact_rows(spark, [(2, 2, 0)]), fact, partials=(kind,))
    assert tuple(total()) == (6, 0)

    def broken(*args, **options):
        raise RuntimeError("lost")

    # The rows are in the table, their counts are not; then the batch is replayed.
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr("aeromart.sources.writers.note_part", broken)
        am.write_fact(fact_rows(spark, [(2, 3, 0)]), fact, partials=(kind,))
    am.write_fact(fact_rows(spark, [(2, 3, 0)]), fact, partials=(kind,))
    assert tuple(total()) == (8, 0)
    # A part whose months were never noted does not count.
    rows = kind.of(fact_rows(spark, [(2, 9, 0)])).withColumn("part_id", F.lit("stray"))
    rows.write.mode("append").partitionBy("year", "month").parquet(f"{fact}_{kind.name}")
    assert tuple(total()) == (8, 0)


@pytest.mark.parametrize("hour", ["00:00:00", "00:29:59", "00:30:00", "00:30:01", "01:00:00"])
def test_merged_report_equals_the_scan_at_any_cutoff(spark, lake, hour):
    fact, dim, _ = lake
    kind = am.check_partials()
    for days, stamp in (([(1, 1, 0)], "2024-03-01T00:30:00+00:00"), ([(1, 2, 0), (2, 1, 0)], "2024-03-01T00:30:01"), ([(2, 2, 0)], "2024-02-28T23:00:00")):
        am.write_fact(fact_rows(spark, days, stamp=stamp), fact, partials=(kind,))
    h, m, s = map(int, hour.split(":"))
    as_of = datetime(2024, 3, 1, h, m, s)
    settings = {"freshness_hours": 0, "cities": ("x", "z")}
    dims = am.read_dim(spark, dim)
    whole = am.dq_check(am.read_fact(spark, fact), dims, as_of, **settings)
    merged = am.dq_check_merged(spark, fact, dims, as_of, **settings)
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))


def test_stamps_of_gold_in_both_modes(spark):
    """`_aggregated_at` is the given instant, or the time of the run."""
    fact = fact_rows(spark, [(1, 1, 0)])
    assert {r[0] for r in am.daily_summary(fact, aggregated_at=AT).select(F.unix_timestamp("_aggregated_at")).collect()} == {int(AT.timestamp())}
    before = datetime.now(timezone.utc).timestamp()
    daily = am.daily_summary(fact)
    dim = spark.createDataFrame([(1, "n", 1.0, 2.0)], "waqi_idx int, station_name string, lat double, lon double")
    for table in (daily, am.city_ranking(daily, fact), am.station_summary(fact, dim)):
        stamps = {r[0] for r in table.select(F.unix_micros("_aggregated_at")).collect()}
        assert len(stamps) == 1 and before - 1 <= stamps.pop() / 1e6 <= datetime.now(timezone.utc).timestamp() + 1


def test_a_load_takes_its_months_from_the_ledger(spark, tmp_path, monkeypatch):
    """The batch may be costly to compute: its span of months is not taken from it again."""
    asked, span, path = [], writers.span, str(tmp_path / "fact")
    monkeypatch.setattr(writers, "span", lambda df, cols: asked.append(df.columns) or span(df, cols))
    assert am.write_fact(fact_rows(spark, [(1, 1, 0), (2, 1, 0)]), path) == 4
    assert am.write_fact(fact_rows(spark, [(2, 1, 0), (2, 2, 0)]), path, partials=(am.check_partials(),)) == 2
    assert asked and all("load_id" in columns for columns in asked)


def test_states_of_a_load_are_shuffled_once(spark):
    fact = spark.createDataFrame([], FACT_SCHEMA)
    plan = am.station_day_partials().of(fact)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [year" in plan
    physical = am.station_day_partials().of(spark.range(10).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in FACT_SCHEMA]))
    text = physical._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and am.station_day_partials().laid_out
