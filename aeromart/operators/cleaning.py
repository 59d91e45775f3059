"""From raw rows to fact and dimension rows."""

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import API_READINGS, CSV_HEADERS, DIM_SCHEMA, FACT_SCHEMA, STALE_HOURS
from ..functions import parse_iso, resolve_choice, resolve_variant, to_date, year_month
from ..functions.numbers import field_type
from ..functions.times import as_utc


def ok_responses(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == "ok")


def flatten_api(df: DataFrame, ingested_at: str, source: str = "api", more=()) -> DataFrame:
    """Nested API documents to flat columns, whatever types the readings came in.

    `data.aqi` counts only where it is a whole-number branch or plain number; the text that an
    offline station sends instead becomes NULL. A `geo` array that is too short gives NULLs. Columns named in `more`
    are kept.
    """

    def plain(path):
        known = field_type(df.schema, path) is not None
        return F.col(path) if known else F.lit(None).cast("string")

    geo = F.col("data.city.geo")
    return df.select(
        F.col("data.idx").try_cast("int").alias("waqi_idx"),
        plain("data.city.name").alias("station_name"),
        plain("data.city.url").alias("url"),
        F.get(geo, F.lit(0)).try_cast("double").alias("lat"),
        F.get(geo, F.lit(1)).try_cast("double").alias("lon"),
        F.col("queried_city"),
        parse_iso(F.col("data.time.iso")).alias("measured_at"),
        resolve_choice("data.aqi", df.schema, branches=("int",)).alias("aqi"),
        plain("data.dominentpol").alias("dominant_pollutant"),
        *[
            resolve_choice(f"data.iaqi.{raw}.v", df.schema).alias(clean)
            for raw, clean in API_READINGS.items()
        ],
        F.lit(source).alias("source"),
        F.lit(ingested_at).alias("ingested_at"),
        *more,
    )


def flatten_variant(
    df: DataFrame, ingested_at: str, body: str = "body", city: str = "city", source: str = "api"
) -> DataFrame:
    """`flatten_api` of documents that are still text, parsed to VARIANT: no schema is needed for fields of mixed types."""
    # Through a generator a body is parsed once, and not once for each field.
    parsed = df.select(
        F.explode(F.array(F.try_parse_json(body))).alias("_doc"), F.col(city).alias("queried_city")
    )
    doc = F.col("_doc")

    def text(path):
        return F.try_variant_get(doc, path, "string")

    return parsed.select(
        F.try_variant_get(doc, "$.data.idx", "int").alias("waqi_idx"),
        text("$.data.city.name").alias("station_name"),
        text("$.data.city.url").alias("url"),
        F.try_variant_get(doc, "$.data.city.geo[0]", "double").alias("lat"),
        F.try_variant_get(doc, "$.data.city.geo[1]", "double").alias("lon"),
        "queried_city",
        parse_iso(text("$.data.time.iso")).alias("measured_at"),
        resolve_variant(doc, "$.data.aqi", branches=("int",)).alias("aqi"),
        text("$.data.dominentpol").alias("dominant_pollutant"),
        *[
            resolve_variant(doc, f"$.data.iaqi.{raw}.v").alias(clean)
            for raw, clean in API_READINGS.items()
        ],
        F.lit(source).alias("source"),
        F.lit(ingested_at).alias("ingested_at"),
    )


def rename_headers(df: DataFrame, mapping=CSV_HEADERS) -> DataFrame:
    """Trim and lower-case every header, then give the dirty ones their clean names."""
    tidy = df.toDF(*[name.strip().lower() for name in df.columns])
    return tidy.withColumnsRenamed(mapping)


def identified(df: DataFrame) -> DataFrame:
    """Rows with a station id. Rows without one are of unknown stations, which must not become one."""
    return df.filter(F.col("waqi_idx").isNotNull())


REQUIRED = ("measured_at", "aqi", "dominant_pollutant")


def require_not_null(df: DataFrame, cols=REQUIRED) -> DataFrame:
    return df.dropna(subset=list(cols))


def complete(cols=REQUIRED) -> Column:
    """The condition of `require_not_null`."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def stale_threshold(as_of: datetime, hours: float = STALE_HOURS) -> datetime:
    """Whole-second instant `hours` before `as_of`; a time without a zone is UTC."""
    return (as_utc(as_of) - timedelta(hours=hours)).replace(microsecond=0)


def drop_stale(
    df: DataFrame, as_of: datetime, hours: float = STALE_HOURS, col: str = "measured_at"
) -> DataFrame:
    """Keep readings no older than `hours` at `as_of`; one exactly that old is kept."""
    return df.filter(recent(as_of, hours, col))


def recent(as_of: datetime, hours: float = STALE_HOURS, col: str = "measured_at") -> Column:
    """The condition of `drop_stale`."""
    return F.col(col) >= F.lit(stale_threshold(as_of, hours))


def _first_per_key(df: DataFrame, keys, order) -> DataFrame:
    # Catalyst turns this into a group limit that also runs before the shuffle, so a key
    # with very many copies leaves each map task as a single row.
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).filter("_rn = 1").drop("_rn")


def dedup_latest(
    df: DataFrame, keys=("waqi_idx", "measured_at"), order: str = "ingested_at"
) -> DataFrame:
    """One row per key: the newest by `order`, ties settled by all the other columns in turn."""
    rest = [c for c in df.columns if c not in (*keys, order)]
    return _first_per_key(
        df,
        keys,
        [F.col(order).desc_nulls_last(), *[F.col(f"`{c}`").asc_nulls_first() for c in rest]],
    )


def distinct_by(df: DataFrame, keys, order: str | None = None) -> DataFrame:
    """One row per key, the same one on every run: newest by `order` if given, then smallest."""
    rest = [c for c in df.columns if c not in (*keys, order)]
    newest = [F.col(order).desc_nulls_last()] if order else []
    return _first_per_key(df, keys, newest + [F.col(f"`{c}`").asc_nulls_first() for c in rest])


def new_only(new: DataFrame, existing: DataFrame, keys=("waqi_idx",)) -> DataFrame:
    """Rows of `new` whose key is not in `existing`; a NULL key matches a NULL key.

    `existing` is first cut down to the keys that occur in `new`: when `new` is small that is
    a broadcast of its keys, and the large table is scanned without being shuffled.
    """
    wanted = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    held = existing.select(*[F.col(k).alias(f"_old_{k}") for k in keys])
    both = reduce(
        lambda a, b: a & b, [F.col(f"_old_{k}").eqNullSafe(F.col(f"_new_{k}")) for k in keys]
    )
    hits = held.join(wanted, both, "left_semi")
    seen = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in keys])
    return new.join(hits, seen, "left_anti")


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both, matched by column name."""
    return a.unionByName(b)


def with_date(df: DataFrame, col: str = "measured_at", tz: str | None = None) -> DataFrame:
    return df.withColumn("date", to_date(F.col(col), tz))


def with_year_month(df: DataFrame, col: str = "measured_at") -> DataFrame:
    year, month = year_month(F.col(col))
    return df.withColumns({"year": year, "month": month})


def select_fact(df: DataFrame) -> DataFrame:
    """Fact columns in table order, with the partition columns."""
    return with_year_month(df).select(*FACT_SCHEMA.fieldNames())


def select_dim(df: DataFrame) -> DataFrame:
    return df.select(*DIM_SCHEMA.fieldNames())


def sightings(df: DataFrame) -> DataFrame:
    """Distinct station attributes, with the latest instant and the rows they came with.

    Stations are few and their attributes rarely change, so grouping by all of them collapses
    the input before anything is shuffled or sorted.
    """
    return _seen(
        df, F.count("*").alias("rows"), F.count_if(complete()).alias("complete_rows")
    )


def _seen(df: DataFrame, *counts) -> DataFrame:
    return df.groupBy(*DIM_SCHEMA.fieldNames()).agg(F.max("measured_at").alias("seen"), *counts)


def latest_dim(df: DataFrame) -> DataFrame:
    """One dimension row per station, from its latest reading."""
    return latest_of(_seen(df))


def latest_of(seen: DataFrame) -> DataFrame:
    """The dimension out of `sightings`."""
    attributes = seen.select(*DIM_SCHEMA.fieldNames(), "seen")
    return select_dim(distinct_by(attributes, ["waqi_idx"], order="seen"))
