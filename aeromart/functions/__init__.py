"""Column functions: every one takes and returns Columns and stays inside the JVM."""

from .aggregates import (
    count_where,
    distinct_count,
    distinct_sketch,
    distinct_text,
    mean2,
    merge_sketches,
    most_frequent,
    pct,
    sketch_error,
)
from .numbers import (
    clean_numeric,
    field_type,
    resolve_choice,
    resolve_num,
    resolve_variant,
    strip_thousands,
)
from .texts import (
    aqi_band,
    bronze_key,
    classify_by_keyword,
    clean_pollutant,
    clean_string,
    ingestion_id,
    parse_slug_list,
    split_location,
)
from .times import parse_iso, parse_ts_tz, to_date, year_month

__all__ = [
    "aqi_band",
    "bronze_key",
    "classify_by_keyword",
    "clean_numeric",
    "clean_pollutant",
    "clean_string",
    "count_where",
    "distinct_count",
    "distinct_sketch",
    "distinct_text",
    "field_type",
    "ingestion_id",
    "mean2",
    "merge_sketches",
    "most_frequent",
    "parse_iso",
    "parse_slug_list",
    "parse_ts_tz",
    "pct",
    "resolve_choice",
    "resolve_num",
    "resolve_variant",
    "sketch_error",
    "split_location",
    "strip_thousands",
    "to_date",
    "year_month",
]
