"""Aggregates over the fact table.

The raw rows are touched by partial hash aggregation only. The most frequent value is found from
per-value counts (those few rows are sorted, the raw ones are not); a city, station or day that
holds much of the data shrinks before it is shuffled.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import DAY_COUNTS
from ..functions import count_where, distinct_sketch, mean2, merge_sketches, most_frequent
from ..functions.aggregates import LG_K, round2
from ..session import stage
from .cleaning import distinct_by, with_date, with_year_month

DAILY_KEYS = ("queried_city", "date")
MONTHLY_KEYS = ("queried_city", "year", "month")
STATION_KEYS = ("waqi_idx", "queried_city", "year", "month")
MEASURES = ("aqi", "pm25", "pm10", "humidity", "temperature")


def _where_known(keys, col: Column) -> Column:
    """The most frequent value is attached by equality on the keys: a NULL key has none."""
    return F.when(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]), col)


def _same_key(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    """Join on keys that may be NULL, keeping the left side's key columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def _metrics() -> list[Column]:
    """Rounded means, extremes and row count of a group of readings."""
    return [
        mean2("aqi").alias("avg_aqi"),
        F.max("aqi").alias("max_aqi"),
        F.min("aqi").alias("min_aqi"),
        *[mean2(m).alias(f"avg_{m}") for m in MEASURES if m != "aqi"],
        F.count("*").alias("record_count"),
    ]


def _partials(df: DataFrame, keys) -> DataFrame:
    """Mergeable sums and counts per group."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.max("aqi").alias("_max"),
        F.min("aqi").alias("_min"),
        *[F.sum(m).alias(f"_sum_{m}") for m in MEASURES],
        *[F.count(m).alias(f"_cnt_{m}") for m in MEASURES],
    )


def _merged() -> list[Column]:
    """The same metrics over `_partials`."""

    def mean(m):
        return round2(F.try_divide(F.sum(f"_sum_{m}"), F.sum(f"_cnt_{m}"))).alias(f"avg_{m}")

    return [
        mean("aqi"),
        F.max("_max").alias("max_aqi"),
        F.min("_min").alias("min_aqi"),
        *[mean(m) for m in MEASURES if m != "aqi"],
        F.sum("_n").alias("record_count"),
    ]


def station_days(fact: DataFrame, tz: str | None = None, also=()) -> DataFrame:
    """Mergeable sums, counts, extremes and pollutant counts by station, city, day and pollutant.

    Every gold table follows from these rows. A station reports some times a day, so there are far fewer of them than
    readings. Rows of several loads with the same key stand side by side and are merged when read. `also` names further
    keys by which the readings are laid out.
    """
    keys = ["waqi_idx", "queried_city", "date", "dominant_pollutant", *MONTHLY_KEYS[1:], *also]
    return _partials(with_date(fact, tz=tz), keys)


def _remerged(states: DataFrame, keys) -> DataFrame:
    """`_partials` of coarser groups, out of finer ones."""
    return states.groupBy(*keys).agg(
        F.sum("_n").alias("_n"),
        F.max("_max").alias("_max"),
        F.min("_min").alias("_min"),
        *[F.sum(f"_{kind}_{m}").alias(f"_{kind}_{m}") for kind in ("sum", "cnt") for m in MEASURES],
    )


def metrics_by(df: DataFrame, keys, col: str = "dominant_pollutant") -> DataFrame:
    """Means, extremes, row count and most frequent `col` per group, in one scan."""
    return _merged_by(_partials(df, [*keys, col]), keys, col)


def _merged_by(partials: DataFrame, keys, col: str) -> DataFrame:
    return (
        partials.groupBy(*keys)
        .agg(
            *_merged(),
            most_frequent(col, F.col("_n")).alias("_mode"),
        )
        .withColumn(col, _where_known(keys, F.col("_mode")))
        .drop("_mode")
    )


def station_counts(df: DataFrame, keys) -> DataFrame:
    """Distinct stations per group. Only the keys are shuffled, not the measures."""
    return (
        df.select(*keys, "waqi_idx")
        .distinct()
        .groupBy(*keys)
        .agg(F.count("waqi_idx").alias("station_count"))
    )


def _with_stations(metrics: DataFrame, dated: DataFrame) -> DataFrame:
    return _same_key(metrics, station_counts(dated, DAILY_KEYS), DAILY_KEYS, "left")


def station_sketches(fact: DataFrame, tz: str | None = None, lg_k: int = LG_K) -> DataFrame:
    """A sketch of the stations of every city and day: a few KB a group, whatever it holds.

    Sketches of days merge to those of months or of several cities, which exact counts do not.
    """
    dated = with_year_month(with_date(fact, tz=tz), "date")
    return dated.groupBy(*DAILY_KEYS, "year", "month").agg(distinct_sketch("waqi_idx", lg_k).alias("stations"))


def approx_stations(sketches: DataFrame, keys) -> DataFrame:
    """Estimated distinct stations by coarser keys, out of `station_sketches`; the error is `sketch_error`."""
    return sketches.groupBy(*keys).agg(merge_sketches("stations").alias("station_count"))


def daily_metrics(fact: DataFrame, tz: str | None = None) -> DataFrame:
    """City and day: rounded means, extremes, distinct stations, rows."""
    dated = with_date(fact, tz=tz)
    return _with_stations(dated.groupBy(*DAILY_KEYS).agg(*_metrics()), dated)


def daily_with_mode(fact: DataFrame, tz: str | None = None) -> DataFrame:
    """`daily_metrics` and the most frequent pollutant of each city and day."""
    dated = with_date(fact, tz=tz)
    return _with_stations(metrics_by(dated, DAILY_KEYS), dated)


def daily_of_states(states: DataFrame, col: str = "dominant_pollutant") -> DataFrame:
    """`daily_with_mode` out of `station_days`."""
    return _with_stations(_merged_by(_remerged(states, [*DAILY_KEYS, col]), DAILY_KEYS, col), states)


def station_monthly_of_states(
    states: DataFrame, dim: DataFrame, col: str = "dominant_pollutant"
) -> DataFrame:
    """`station_monthly` out of `station_days`."""
    month_keys = ["waqi_idx", "year", "month"]
    monthly = states.groupBy(*STATION_KEYS).agg(*_merged())
    modes = mode_per_group(states, month_keys, col, F.sum("_n"))
    return enrich_with_dim(attach_mode(monthly, modes, month_keys), dim)


def mode_per_group(
    df: DataFrame, keys, col: str = "dominant_pollutant", count: Column | None = None
) -> DataFrame:
    """Most frequent value of `col` per group; NULL counts as a value, the smallest wins a tie.

    `count` is an aggregate that says how often a value occurs, if `df` holds counts and not rows.
    """
    counted = df.groupBy(*keys, col).agg((F.count("*") if count is None else count).alias("_n"))
    return counted.groupBy(*keys).agg(most_frequent(col, F.col("_n")).alias(col))


def attach_mode(df: DataFrame, mode: DataFrame, keys) -> DataFrame:
    """Left join of a `mode_per_group` result; a group with a NULL key gets no mode."""
    return df.join(mode, list(keys), "left")


def monthly_from_daily(daily: DataFrame) -> DataFrame:
    """City and month over the daily table, so that every day counts once."""
    return daily.groupBy(*MONTHLY_KEYS).agg(
        mean2("avg_aqi").alias("avg_aqi"),
        F.max("max_aqi").alias("max_aqi"),
        F.min("min_aqi").alias("min_aqi"),
        mean2("avg_pm25").alias("avg_pm25"),
        mean2("avg_pm10").alias("avg_pm10"),
        F.sum("record_count").alias("record_count"),
        *[count_where(F.col("pollution_level") == level).alias(c) for level, c in DAY_COUNTS],
    )


def enrich_with_dim(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Station name and coordinates by `waqi_idx`; an unknown station keeps its rows, with NULLs.

    A dimension that holds a station twice does not multiply rows.
    """
    stations = distinct_by(dim.select("waqi_idx", "station_name", "lat", "lon"), ["waqi_idx"])
    return df.join(stations, "waqi_idx", "left")


def station_monthly(
    fact: DataFrame, dim: DataFrame, col: str = "dominant_pollutant"
) -> DataFrame:
    """Station, city and month over raw readings, so that every reading counts once.

    The most frequent pollutant is that of the station's month in any city. The dimension is
    joined to the small result: the name and the coordinates depend on the station alone.
    """
    month_keys = ["waqi_idx", "year", "month"]
    monthly = fact.groupBy(*STATION_KEYS).agg(*_metrics())
    with_mode = attach_mode(monthly, mode_per_group(fact, month_keys, col), month_keys)
    return enrich_with_dim(with_mode, dim)


def rank_cities(df: DataFrame) -> DataFrame:
    """Dense ranks of the cities within a month, most polluted first, NULLs last.

    The input has one row per city and month, so a window holds no more rows than cities.
    """
    month = Window.partitionBy("year", "month")
    return df.withColumns(
        {
            "aqi_rank": F.dense_rank().over(month.orderBy(F.col("avg_aqi").desc_nulls_last())),
            "pm25_rank": F.dense_rank().over(month.orderBy(F.col("avg_pm25").desc_nulls_last())),
        }
    )


def rank_in_city(df: DataFrame) -> DataFrame:
    """Dense rank of the stations within a city and month, most polluted first, NULLs last.

    A city may hold very many stations, but a dense rank depends on the distinct values only.
    Those are ranked, and the ranks joined back on the value, which spreads a large city over
    all tasks. The input is staged when this is called, and read twice: all of it, and four columns.
    """
    df = stage(df, "ranked")
    keys = list(MONTHLY_KEYS)
    worst = Window.partitionBy(*keys).orderBy(F.col("avg_aqi").desc_nulls_last())
    ranks = (
        df.select(*keys, "avg_aqi")
        .distinct()
        .withColumn("rank_in_city", F.dense_rank().over(worst))
    )
    return _same_key(df, ranks, [*keys, "avg_aqi"], "left")
