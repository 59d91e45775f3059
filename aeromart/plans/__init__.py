"""Composite jobs, built from the operators."""

from .gold import city_ranking, daily_summary, refresh_gold, station_summary
from .merged import check_partials, dq_check_merged, station_day_partials
from .silver import api_to_silver, csv_to_silver

__all__ = [
    "api_to_silver",
    "check_partials",
    "city_ranking",
    "csv_to_silver",
    "daily_summary",
    "dq_check_merged",
    "refresh_gold",
    "station_day_partials",
    "station_summary",
]
