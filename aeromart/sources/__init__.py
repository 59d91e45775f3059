"""Readers and writers."""

from .partials import Partials, read_partials
from .readers import (
    read_api_bronze,
    read_api_bronze_checked,
    read_csv_bronze,
    read_daily,
    read_dim,
    read_fact,
    read_quarantine,
    read_ranking,
    read_station_summary,
    stream_api_bronze,
    stream_api_bronze_checked,
    stream_csv_bronze,
)
from .writers import (
    insert_bucketed,
    insert_new,
    land_bronze,
    write_daily,
    write_dim,
    write_fact,
    write_quarantine,
    write_ranking,
    write_station_summary,
)

__all__ = [
    "Partials",
    "insert_bucketed",
    "insert_new",
    "land_bronze",
    "read_api_bronze",
    "read_api_bronze_checked",
    "read_csv_bronze",
    "read_daily",
    "read_dim",
    "read_fact",
    "read_partials",
    "read_quarantine",
    "read_ranking",
    "read_station_summary",
    "stream_api_bronze",
    "stream_api_bronze_checked",
    "stream_csv_bronze",
    "write_daily",
    "write_dim",
    "write_fact",
    "write_quarantine",
    "write_ranking",
    "write_station_summary",
]
