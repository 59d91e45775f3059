"""Bronze to silver."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import CITY_KEYWORDS, STALE_HOURS
from ..functions import (
    classify_by_keyword,
    clean_numeric,
    clean_pollutant,
    parse_ts_tz,
    split_location,
    strip_thousands,
)
from ..functions.numbers import resolve_choice
from ..functions.times import as_utc
from ..operators.cleaning import (
    dedup_latest,
    drop_stale,
    flatten_api,
    identified,
    latest_dim,
    rename_headers,
    require_not_null,
    select_fact,
)


def iso_stamp(as_of: datetime) -> str:
    """ISO text in UTC, so that stamps sort as text."""
    return as_utc(as_of).isoformat()


def clean_csv(
    df: DataFrame, ingested_at: str, mapping=CITY_KEYWORDS, source: str = "kaggle"
) -> DataFrame:
    """Typed rows of the historical CSV, for the stations of the known cities that have a usable id."""
    return identified(typed_csv(df, ingested_at, mapping, source))


def typed_csv(
    df: DataFrame, ingested_at: str, mapping=CITY_KEYWORDS, source: str = "kaggle"
) -> DataFrame:
    """The same with the rows whose id is not a whole number in range: their `waqi_idx` is NULL."""
    raw = rename_headers(df)
    city = classify_by_keyword(F.col("station_name"), mapping)
    known = (
        require_not_null(raw, ("station_id", "station_name"))
        .withColumn("queried_city", city)
        .filter(F.col("queried_city").isNotNull())
    )
    lat, lon = split_location(F.col("location"))

    def number(name):
        return clean_numeric(name, raw.schema)

    text_or_struct = raw.schema["pressure"].dataType
    if hasattr(text_or_struct, "fieldNames"):
        # Either branch may hold the value; only the text one can carry a comma.
        pressure = F.coalesce(
            strip_thousands(F.col("pressure.string")),
            resolve_choice("pressure", raw.schema, ("double", "int")),
        )
    else:
        pressure = strip_thousands(F.col("pressure"))
    return known.select(
        F.col("station_id").try_cast("int").alias("waqi_idx"),
        "queried_city",
        "station_name",
        "url",
        lat.alias("lat"),
        lon.alias("lon"),
        parse_ts_tz(F.col("data_time_s"), F.col("data_time_tz")).alias("measured_at"),
        number("aqi_index").alias("aqi"),
        clean_pollutant(F.col("dominant_pollutant")).alias("dominant_pollutant"),
        *[
            number(n).alias(n)
            for n in ("pm25", "pm10", "co", "no2", "o3", "so2", "humidity", "temperature")
        ],
        pressure.alias("pressure"),
        number("wind").alias("wind"),
        F.lit(source).alias("source"),
        F.lit(ingested_at).alias("ingested_at"),
    )


def csv_to_silver(
    df: DataFrame, ingested_at: str, mapping=CITY_KEYWORDS
) -> tuple[DataFrame, DataFrame]:
    """Fact and dimension from the historical CSV.

    A station counts even if none of its readings is valid. Invalid readings are dropped
    before duplicates are, so that one cannot push out a valid reading of the same instant.
    """
    clean = clean_csv(df, ingested_at, mapping)
    return select_fact(dedup_latest(require_not_null(clean))), latest_dim(clean)


def fresh_readings(flat: DataFrame, as_of: datetime, hours: float = STALE_HOURS) -> DataFrame:
    """Complete readings of identified stations that are not stale."""
    return drop_stale(require_not_null(identified(flat)), as_of, hours)


def api_to_silver(
    df: DataFrame, as_of: datetime, hours: float = STALE_HOURS
) -> tuple[DataFrame, DataFrame]:
    """Fact and dimension from raw API documents."""
    flat = flatten_api(df, iso_stamp(as_of))
    readings = dedup_latest(fresh_readings(flat, as_of, hours))
    return select_fact(readings), latest_dim(readings)
