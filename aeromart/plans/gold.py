"""Silver to gold: the daily, ranking and station tables."""

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import DAILY_SCHEMA, MONTH_PARTITIONS, RANKING_SCHEMA, STATION_SCHEMA
from ..functions import aqi_band
from ..functions.times import as_utc
from ..operators.cleaning import with_date, with_year_month
from ..operators.summaries import (
    MONTHLY_KEYS,
    attach_mode,
    daily_of_states,
    daily_with_mode,
    mode_per_group,
    monthly_from_daily,
    rank_cities,
    rank_in_city,
    station_monthly,
    station_monthly_of_states,
)
from ..session import pin_utc, stage, staging
from ..sources.partials import read_partials
from ..sources.readers import (
    broken_refresh,
    read_daily,
    read_dim,
    read_fact,
    read_loads,
    read_refreshes,
)
from ..sources.writers import (
    in_span,
    note_refresh,
    note_start,
    span,
    write_daily,
    write_ranking,
    write_station_summary,
)

from .merged import station_day_partials


def _stamp(at: datetime | None) -> Column:
    return (F.current_timestamp() if at is None else F.lit(as_utc(at))).alias("_aggregated_at")


def daily_summary(
    fact: DataFrame, tz: str | None = None, aggregated_at: datetime | None = None
) -> DataFrame:
    """City and day, with the level of the day's worst reading."""
    return _daily_table(daily_with_mode(fact, tz), aggregated_at)


def _daily_table(daily: DataFrame, aggregated_at: datetime | None) -> DataFrame:
    daily = (
        daily.withColumn("pollution_level", aqi_band(F.col("max_aqi")))
        .withColumn("_aggregated_at", _stamp(aggregated_at))
    )
    return with_year_month(daily, "date").select(
        *[c for c in DAILY_SCHEMA.fieldNames() if c != "_aggregated_at"], "_aggregated_at"
    )


def _local(fact: DataFrame, tz: str | None) -> DataFrame:
    """Readings with the year and month of their local day."""
    return with_year_month(with_date(fact, tz=tz), "date") if tz else fact


def city_ranking(
    daily: DataFrame,
    fact: DataFrame,
    aggregated_at: datetime | None = None,
    tz: str | None = None,
) -> DataFrame:
    """City and month from the daily table, with two dense ranks within the month.

    Only the most frequent pollutant needs the fact table, and of that one text column. `tz` must
    be that of the daily table, so that both count a reading in the same month.
    """
    return _ranking_table(daily, mode_per_group(_local(fact, tz), MONTHLY_KEYS), aggregated_at)


def _ranking_table(daily: DataFrame, modes: DataFrame, aggregated_at: datetime | None) -> DataFrame:
    monthly = attach_mode(monthly_from_daily(daily), modes, MONTHLY_KEYS)
    return (
        rank_cities(monthly.withColumn("pollution_level", aqi_band(F.col("avg_aqi"))))
        .withColumn("_aggregated_at", _stamp(aggregated_at))
        .select(*RANKING_SCHEMA.fieldNames())
    )


def station_summary(
    fact: DataFrame, dim: DataFrame, aggregated_at: datetime | None = None
) -> DataFrame:
    """Station and month, ranked within the city.

    Runs the aggregation when called: the ranking stages its result and reads it twice.
    """
    return _station_table(station_monthly(fact, dim), aggregated_at)


def _station_table(monthly: DataFrame, aggregated_at: datetime | None) -> DataFrame:
    monthly = monthly.withColumn("pollution_level", aqi_band(F.col("avg_aqi")))
    return (
        rank_in_city(monthly)
        .withColumn("_aggregated_at", _stamp(aggregated_at))
        .select(*STATION_SCHEMA.fieldNames())
    )


class Refresh(NamedTuple):
    """Months rebuilt (None for all) and rows written per gold table."""

    months: int | None
    daily_rows: int
    ranking_rows: int
    station_rows: int


def months_to_refresh(
    spark: SparkSession, fact_path: str, gold: str
) -> tuple[int | None, DataFrame | None]:
    """The newest load, and the months of the loads that no finished refresh covers; None for all.

    Both come from small ledgers, not from stamps: a load with an older instant than the last
    refresh counts like any other. A fact table without a ledger is refreshed in full.
    """
    loads = read_loads(spark, fact_path)
    newest = loads.agg(F.max("load_id")).first()[0]
    covered = read_refreshes(spark, gold).agg(F.max("load_id")).first()[0]
    if newest is None or covered is None:
        return newest, None
    return newest, loads.filter(F.col("load_id") > covered).select(*MONTH_PARTITIONS).distinct()


def _in_months(df: DataFrame, months: DataFrame | None) -> DataFrame:
    """Rows of the months: their span prunes folders, a semi-join decides."""
    if months is None:
        return df
    near = in_span(df, MONTH_PARTITIONS, span(months, MONTH_PARTITIONS))
    return near.join(months, list(MONTH_PARTITIONS), "left_semi").select(*df.columns)


def _shifted(text: str | None, by: int) -> str | None:
    """`year/month` some months earlier or later."""
    if text is None:
        return None
    number = int(text[:-3]) * 12 + int(text[-2:]) - 1 + by
    return f"{number // 12:04d}/{number % 12 + 1:02d}"


class _Readings:
    """What gold is computed from: the readings of the fact table."""

    def __init__(self, fact: DataFrame, tz: str | None):
        self.rows, self.tz = fact, tz

    def local(self, rows: DataFrame) -> DataFrame:
        return _local(rows, self.tz)

    def daily(self, rows: DataFrame) -> DataFrame:
        return daily_with_mode(rows, self.tz)

    def modes(self, rows: DataFrame) -> DataFrame:
        return mode_per_group(self.local(rows), MONTHLY_KEYS)

    def stations(self, rows: DataFrame, dim: DataFrame) -> DataFrame:
        return station_monthly(rows, dim)


class _States(_Readings):
    """The same out of the partial states of station and day that the loads have kept; no reading is read."""

    def local(self, rows: DataFrame) -> DataFrame:
        return with_year_month(rows, "date") if self.tz else rows

    def daily(self, rows: DataFrame) -> DataFrame:
        return daily_of_states(rows)

    def modes(self, rows: DataFrame) -> DataFrame:
        return mode_per_group(self.local(rows), MONTHLY_KEYS, count=F.sum("_n"))

    def stations(self, rows: DataFrame, dim: DataFrame) -> DataFrame:
        return station_monthly_of_states(rows, dim)


def _local_part(source: _Readings, months: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows of the local months that the changed months reach into, and those months.

    A local month lies within one month of the stored one on either side.
    """
    reached = source.local(_in_months(source.rows, months)).select(*MONTH_PARTITIONS).distinct()
    local = stage(reached, "months")
    low, high = span(local, MONTH_PARTITIONS)
    near = in_span(source.rows, MONTH_PARTITIONS, (_shifted(low, -1), _shifted(high, 1)))
    stored = {f"_{c}": F.col(c) for c in MONTH_PARTITIONS}
    part = source.local(near.withColumns(stored)).join(local, list(MONTH_PARTITIONS), "left_semi")
    part = part.drop(*MONTH_PARTITIONS).withColumnsRenamed({"_year": "year", "_month": "month"})
    return part.select(*source.rows.columns), local


def refresh_gold(
    spark: SparkSession,
    fact_path: str,
    dim_path: str,
    gold: str,
    as_of: datetime | None = None,
    full: bool = False,
    tz: str | None = None,
    tables: dict[str, str] | None = None,
    states: bool = False,
) -> Refresh:
    """Write the three gold tables under `gold`.

    All gold rows belong to one month. Only the months that were added to since the last finished
    refresh are computed and replaced, unless `full` is set or there was none. The days are those of
    `tz`, which must not change between refreshes. `tables` registers the results in the catalog:
    names for `daily`, `ranking`, `station`.

    A refresh is noted before its first write and after its last one, so one that broke off is made
    good by the next, wherever it broke. Of the partitioned tables a refresh of some months can only
    damage these months, which are still uncovered; the ranking, which is replaced as a whole, is then
    computed anew from the daily table. After a full refresh that broke off everything is computed anew.

    With `states` everything comes from the partial states that loads with `station_day_partials(tz)` have kept, so a late
    reading costs its month's states instead of its month's readings.
    """
    pin_utc(spark)
    names = tables or {}
    daily_path, ranking_path = f"{gold}/gold_aqi_daily_summary", f"{gold}/gold_aqi_city_ranking"
    with staging(spark):
        fact, dim = read_fact(spark, fact_path), read_dim(spark, dim_path)
        broken = broken_refresh(spark, gold)
        newest, months = months_to_refresh(spark, fact_path, gold)
        months = None if full or broken == "full" or months is None else stage(months, "months")
        changed = months is not None
        if changed and not broken and months.isEmpty():
            return Refresh(0, 0, 0, 0)
        number = note_start(spark, gold, full=not changed)
        if states:
            source = _States(read_partials(spark, fact_path, station_day_partials(tz)), tz)
        else:
            source = _Readings(fact, tz)
        part = _in_months(source.rows, months)
        station_rows = write_station_summary(
            _station_table(source.stations(part, dim), as_of),
            f"{gold}/gold_station_summary",
            dynamic=changed,
            table=names.get("station"),
        )
        days = months
        if changed and tz:
            part, days = _local_part(source, months)
        daily = _daily_table(source.daily(part), as_of)
        daily_rows = write_daily(daily, daily_path, dynamic=changed, table=names.get("daily"))
        if changed and broken:
            days, part = None, source.rows
        daily = _in_months(read_daily(spark, daily_path), days)
        ranking = _ranking_table(daily, source.modes(part), as_of)
        ranking_rows = write_ranking(ranking, ranking_path, days, table=names.get("ranking"))
        rebuilt = months.count() if changed else None
        note_refresh(spark, gold, newest, number)
    return Refresh(rebuilt, daily_rows, ranking_rows, station_rows)
