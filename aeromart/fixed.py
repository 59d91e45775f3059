"""Fixed values and table schemas.

Everything here must match the published data model exactly, so it is stated
as plain text. All operators take these as default arguments.
"""

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------

CITIES = ("ha-noi", "ho-chi-minh-city", "da-nang", "gia-lai", "cao-bang")

SOURCES = ("kaggle", "api")

CITY_KEYWORDS = {
    "ho-chi-minh-city": ("Ho Chi Minh", "Hồ Chí Minh"),
    "ha-noi": ("Hanoi", "Hà Nội"),
    "da-nang": ("Da Nang", "Đà Nẵng"),
    "gia-lai": ("Gia Lai",),
    "cao-bang": ("Cao Bằng",),
}

NULL_TOKENS = ("-", "", "#NAME?", "N/A")
POLLUTANT_NULL_TOKENS = ("aqi", "")

# Inclusive upper bound and level; anything else, NULL included, is TOP_LEVEL.
AQI_BANDS = (
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
)
TOP_LEVEL = "Hazardous"

# Pollution level and the monthly column that counts its days.
DAY_COUNTS = (
    ("Good", "days_good"),
    ("Moderate", "days_moderate"),
    ("Unhealthy for Sensitive Groups", "days_sensitive"),
    ("Unhealthy", "days_unhealthy"),
    ("Very Unhealthy", "days_very_unhealthy"),
    ("Hazardous", "days_hazardous"),
)

# Lower-cased CSV header and clean name. `dew`, `status` and `alert_level` are not kept.
CSV_HEADERS = {
    "station id": "station_id",
    "aqi index": "aqi_index",
    "station name": "station_name",
    "dominent pollutant": "dominant_pollutant",
    "pm2.5": "pm25",
    "data time s": "data_time_s",
    "data time tz": "data_time_tz",
}

# Reading in the raw API document and its column in the fact table.
API_READINGS = {
    "pm25": "pm25",
    "pm10": "pm10",
    "co": "co",
    "no2": "no2",
    "o3": "o3",
    "so2": "so2",
    "h": "humidity",
    "t": "temperature",
    "p": "pressure",
    "w": "wind",
}

CSV_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss xxx"
KEY_TIME_FORMAT = "yyyy-MM-dd'T'HH-mm-ss'Z'"
INGESTION_ID_FORMAT = "yyyyMMdd_HHmmss"
LANDED_SOURCE = "waqi_city_endpoint"

STALE_HOURS = 48
FRESHNESS_HOURS = 48
MIN_ROWS = 10
MAX_NULL_PCT = 5.0
AQI_MIN, AQI_MAX = 0, 500

# --- Schemas ----------------------------------------------------------------

FACT_PARTITIONS = ("queried_city", "year", "month")
MONTH_PARTITIONS = ("year", "month")
BRONZE_PARTITIONS = ("queried_city", "year", "month", "day")

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _columns(text: str) -> list[T.StructField]:
    """Fields of a `name type, name type` list; needs no running session."""
    pairs = (entry.split() for entry in text.split(","))
    return [T.StructField(name, _TYPES[kind]) for name, kind in pairs]


FACT_SCHEMA = T.StructType(
    _columns(
        "waqi_idx int, measured_at timestamp, aqi double, dominant_pollutant string, "
        "pm25 double, pm10 double, co double, no2 double, o3 double, so2 double, "
        "humidity double, temperature double, pressure double, wind double, "
        "source string, ingested_at string, queried_city string, year string, month string"
    )
)

DIM_SCHEMA = T.StructType(
    _columns(
        "waqi_idx int, station_name string, queried_city string, lat double, lon double, "
        "url string, source string"
    )
)

DAILY_SCHEMA = T.StructType(
    _columns(
        "queried_city string, date date, avg_aqi double, max_aqi double, min_aqi double, "
        "avg_pm25 double, avg_pm10 double, avg_humidity double, avg_temperature double, "
        "station_count bigint, record_count bigint, dominant_pollutant string, "
        "pollution_level string, _aggregated_at timestamp, year string, month string"
    )
)

RANKING_SCHEMA = T.StructType(
    _columns(
        "queried_city string, year string, month string, avg_aqi double, max_aqi double, "
        "min_aqi double, avg_pm25 double, avg_pm10 double, record_count bigint, days_good bigint, "
        "days_moderate bigint, days_sensitive bigint, days_unhealthy bigint, "
        "days_very_unhealthy bigint, days_hazardous bigint, dominant_pollutant string, "
        "pollution_level string, aqi_rank int, pm25_rank int, _aggregated_at timestamp"
    )
)

STATION_SCHEMA = T.StructType(
    _columns(
        "waqi_idx int, station_name string, queried_city string, lat double, lon double, "
        "avg_aqi double, max_aqi double, min_aqi double, avg_pm25 double, avg_pm10 double, "
        "avg_humidity double, avg_temperature double, record_count bigint, "
        "dominant_pollutant string, pollution_level string, rank_in_city int, "
        "_aggregated_at timestamp, year string, month string"
    )
)

# Dirty numerics are read as text, so that a value of any JSON type survives to try_cast.
API_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField(
            "data",
            T.StructType(
                [
                    *_columns("idx int, aqi string, dominentpol string"),
                    T.StructField(
                        "city",
                        T.StructType(
                            [
                                *_columns("name string, url string"),
                                T.StructField("geo", T.ArrayType(T.DoubleType())),
                            ]
                        ),
                    ),
                    T.StructField("time", T.StructType(_columns("iso string"))),
                    T.StructField(
                        "iaqi",
                        T.StructType(
                            [
                                T.StructField(name, T.StructType(_columns("v string")))
                                for name in API_READINGS
                            ]
                        ),
                    ),
                ]
            ),
        ),
    ]
)

API_FILE_SCHEMA = T.StructType(
    API_SCHEMA.fields + [T.StructField(name, T.StringType()) for name in BRONZE_PARTITIONS]
)

REPORT_SCHEMA = T.StructType(
    _columns(
        "check string, table string, column string, value double, threshold double, "
        "passed boolean, message string"
    )
)

QUARANTINE_SCHEMA = T.StructType(
    _columns("file string, document string, copies bigint, noted_at string")
)
LOADS_SCHEMA = T.StructType(_columns("load_id bigint, year string, month string"))
REFRESHES_SCHEMA = T.StructType(_columns("load_id bigint, finished_at timestamp, number bigint"))
CHECKS_SCHEMA = T.StructType(
    _columns(
        "queried_city string, source string, ingested_hour string, rows bigint, null_aqi bigint, "
        "null_measured_at bigint, null_dominant_pollutant bigint, outside bigint, year string, month string"
    )
)
STATION_DAYS_SCHEMA = T.StructType(
    _columns(
        "waqi_idx int, queried_city string, date date, dominant_pollutant string, _n bigint, "
        "_max double, _min double, _sum_aqi double, _sum_pm25 double, _sum_pm10 double, "
        "_sum_humidity double, _sum_temperature double, _cnt_aqi bigint, _cnt_pm25 bigint, "
        "_cnt_pm10 bigint, _cnt_humidity bigint, _cnt_temperature bigint, year string, month string"
    )
)
PARTS_SCHEMA = T.StructType(
    _columns("part_id string, load_id bigint, base boolean, year string, month string")
)
STARTS_SCHEMA = T.StructType(_columns("number bigint, full boolean, started_at timestamp"))
RUN_SCHEMA = T.StructType(
    _columns(
        "status string, reason string, raw_rows bigint, fresh_rows bigint, "
        "new_stations bigint, new_rows bigint, dropped_rows bigint, unreadable_rows bigint, "
        "ingested_at string"
    )
)
