"""Results merged from the partials that each load has kept beside the fact table."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import (
    AQI_MAX,
    AQI_MIN,
    CHECKS_SCHEMA,
    FRESHNESS_HOURS,
    MONTH_PARTITIONS,
    STATION_DAYS_SCHEMA,
)
from ..operators.quality import check_groups, freshness_cutoff, report_of_groups
from ..operators.summaries import MEASURES, station_days
from ..sources.partials import Partials, in_months, read_partials
from ..sources.readers import read_fact

#: Leading characters of a stamp that name its hour: `yyyy-mm-ddThh`.
HOUR_CHARS = 13
#: Into so many parts a month's stations are spread: the tasks that may write one month, and its files by load.
STATION_PARTS = 32


def check_partials(lo=AQI_MIN, hi=AQI_MAX) -> Partials:
    """Counts of the fact checks by month, city, source and hour of the stamp; a load has one stamp as a rule."""
    hour = F.substring("ingested_at", 1, HOUR_CHARS)
    keys = ("queried_city", "source", "ingested_hour", *MONTH_PARTITIONS)

    def of(fact: DataFrame) -> DataFrame:
        groups = check_groups(fact.withColumn("ingested_hour", hour), keys, lo, hi)
        return groups.select(*CHECKS_SCHEMA.fieldNames())

    return Partials(f"checks_{lo}_{hi}", CHECKS_SCHEMA, of)


def station_day_partials(tz: str | None = None) -> Partials:
    """`station_days` by the days of `tz`.

    There are nearly as many of them as readings. The readings are spread by month and part of the stations, which serves
    the grouping and the layout of the files, so that the wider states are not shuffled.
    """
    name = "station_days" + ("_" + tz.replace("/", "-") if tz else "")
    fields = STATION_DAYS_SCHEMA.fieldNames()

    def of(fact: DataFrame) -> DataFrame:
        read = ["waqi_idx", "queried_city", "measured_at", "dominant_pollutant", *MEASURES, *MONTH_PARTITIONS]
        part = F.pmod(F.hash("waqi_idx"), F.lit(STATION_PARTS)).alias("_part")
        spread = fact.select(*read, part).repartition(*MONTH_PARTITIONS, "_part")
        return station_days(spread, tz, also=("_part",)).select(*fields)

    return Partials(name, STATION_DAYS_SCHEMA, of, laid_out=True)


def dq_check_merged(
    spark: SparkSession,
    fact_path: str,
    dim: DataFrame | None,
    as_of: datetime,
    lo=AQI_MIN,
    hi=AQI_MAX,
    freshness_hours=FRESHNESS_HOURS,
    **settings,
) -> DataFrame:
    """The report of `dq_check` on the fact table at a path, merged from the counts that its loads have kept.

    The answer is exact for any instant: whole hours of stamps are merged, and only the rows stamped in the hour in
    which freshness begins are counted in the table, in the months that have such rows. `settings` are those of
    `dq_check`. Partials of months without sound ones are rebuilt first, when this is called.
    """
    groups = read_partials(spark, fact_path, check_partials(lo, hi))
    cutoff = freshness_cutoff(as_of, freshness_hours)
    edge, hour = cutoff[:HOUR_CHARS], F.col("ingested_hour")
    groups_fresh = groups.withColumn("fresh", F.when(hour > edge, F.col("rows")).otherwise(F.lit(0)))
    months = groups.filter(hour == edge).select(*MONTH_PARTITIONS).distinct().collect()  # one row a month
    if months:
        wanted = spark.createDataFrame(months, "year string, month string")
        stamp = F.col("ingested_at")
        late = in_months(read_fact(spark, fact_path), wanted).filter(stamp.startswith(edge) & (stamp >= cutoff))
        counted = late.agg(F.count("*").alias("fresh"))
        groups_fresh = groups_fresh.unionByName(counted, allowMissingColumns=True)
    return report_of_groups(
        spark, groups_fresh, dim, cutoff, lo=lo, hi=hi, freshness_hours=freshness_hours, **settings
    )
