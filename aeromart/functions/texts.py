"""Text cleaning, classification and keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import (
    AQI_BANDS,
    CITY_KEYWORDS,
    INGESTION_ID_FORMAT,
    KEY_TIME_FORMAT,
    NULL_TOKENS,
    POLLUTANT_NULL_TOKENS,
    TOP_LEVEL,
)
from .numbers import number_in


def clean_string(col: Column, tokens=NULL_TOKENS) -> Column:
    """NULL for the exact placeholder texts; nothing is trimmed."""
    text = col.cast("string")
    return F.when(~text.isin(*tokens), text)


def clean_pollutant(col: Column, tokens=NULL_TOKENS) -> Column:
    return clean_string(clean_string(col, tokens), POLLUTANT_NULL_TOKENS)


def split_location(col: Column) -> tuple[Column, Column]:
    """`"lat,lon"` to two doubles; a part that is missing or not a number is NULL."""
    parts = F.split(col, ",")
    return tuple(number_in(F.get(parts, F.lit(i))) for i in (0, 1))


def classify_by_keyword(col: Column, mapping=CITY_KEYWORDS) -> Column:
    """First class, in mapping order, with a keyword in the text; NULL if none has.

    Case and accents count: the text must be in composed (NFC) form.
    """
    labels = [F.when(col.rlike("|".join(words)), F.lit(label)) for label, words in mapping.items()]
    return F.coalesce(*labels)


def aqi_band(col: Column, bands=AQI_BANDS, top=TOP_LEVEL) -> Column:
    """Level of the first band whose inclusive upper bound holds; NULL falls to `top`."""
    level = None
    for bound, name in bands:
        inside = col <= bound
        level = F.when(inside, name) if level is None else level.when(inside, name)
    return level.otherwise(top)


def parse_slug_list(col: Column) -> Column:
    """Array of the trimmed, lower-cased, non-empty entries of a comma list."""
    entries = F.transform(F.split(col, ","), lambda entry: F.lower(F.trim(entry)))
    return F.filter(entries, lambda entry: entry != "")


def bronze_key(city: Column, ts: Column, prefix: str = "api_raw") -> Column:
    """Storage key of one raw response, with Hive-style folders and no colons."""
    return F.concat(
        F.lit(f"{prefix}/queried_city="),
        city,
        F.date_format(ts, "'/year='yyyy'/month='MM'/day='dd'/'"),
        city,
        F.lit("_"),
        F.date_format(ts, KEY_TIME_FORMAT),
        F.lit(".json"),
    )


def ingestion_id(ts: Column) -> Column:
    return F.date_format(ts, INGESTION_ID_FORMAT)
