"""DataFrame operators: every one takes and returns DataFrames and runs nothing by itself,
except where its docstring says so."""

from .cleaning import (
    distinct_by,
    drop_stale,
    dedup_latest,
    flatten_api,
    flatten_variant,
    latest_dim,
    new_only,
    ok_responses,
    rename_headers,
    require_not_null,
    select_dim,
    select_fact,
    union_rows,
    with_date,
    with_year_month,
)
from .landing import ingest_outcomes, ingest_summary, landable, normalise_slugs
from .quality import (
    dq_check,
    dq_summary,
    missing_values,
    sample_by_key,
    sample_rows,
    unexpected_values,
)
from .summaries import (
    approx_stations,
    attach_mode,
    daily_metrics,
    enrich_with_dim,
    metrics_by,
    mode_per_group,
    monthly_from_daily,
    rank_cities,
    rank_in_city,
    station_days,
    station_monthly,
    station_sketches,
)

__all__ = [
    "approx_stations",
    "attach_mode",
    "daily_metrics",
    "dedup_latest",
    "distinct_by",
    "dq_check",
    "dq_summary",
    "drop_stale",
    "enrich_with_dim",
    "flatten_api",
    "flatten_variant",
    "ingest_outcomes",
    "ingest_summary",
    "landable",
    "latest_dim",
    "metrics_by",
    "missing_values",
    "mode_per_group",
    "monthly_from_daily",
    "new_only",
    "normalise_slugs",
    "ok_responses",
    "rank_cities",
    "rank_in_city",
    "rename_headers",
    "require_not_null",
    "sample_by_key",
    "sample_rows",
    "unexpected_values",
    "select_dim",
    "select_fact",
    "station_days",
    "station_monthly",
    "station_sketches",
    "union_rows",
    "with_date",
    "with_year_month",
]
