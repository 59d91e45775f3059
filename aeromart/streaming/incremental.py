"""Loads that process every bronze file once.

The checkpoint remembers which files were read. A batch that is interrupted is run again, and
since both tables are written insert-only by key, running it again adds nothing twice.
"""

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import CITY_KEYWORDS, RUN_SCHEMA, STALE_HOURS
from ..operators.cleaning import (
    complete,
    dedup_latest,
    flatten_api,
    identified,
    latest_dim,
    recent,
    require_not_null,
    select_fact,
)
from ..plans.silver import iso_stamp, typed_csv
from ..session import pin_utc, stage, stage_counted, staging
from ..sources.partials import Partials
from ..sources.readers import FILE, UNREADABLE, stream_api_bronze_checked, stream_csv_bronze
from ..sources.writers import write_dim, write_fact, write_quarantine


class _Totals:
    """Counts over the micro-batches of one run."""

    def __init__(self):
        self.raw = self.fresh = self.stations = self.rows = self.dropped = self.unreadable = 0

    def add(self, counts) -> None:
        self.raw += counts["raw"]
        self.fresh += counts["fresh"]
        self.dropped += counts["dropped"]
        self.unreadable += counts.get("unreadable", 0)

    def as_frame(self, spark: SparkSession, ingested_at: str, empty: str, stale: str) -> DataFrame:
        reason = empty if not self.raw else stale if not self.fresh else None
        status = "SKIPPED" if reason else "LOADED"
        counts = (self.raw, self.fresh, self.stations, self.rows, self.dropped, self.unreadable)
        return spark.createDataFrame([(status, reason, *counts, ingested_at)], RUN_SCHEMA)


def _run(stream: DataFrame, checkpoint: str, batch_job) -> None:
    query = (
        stream.writeStream.foreachBatch(batch_job)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_incremental(
    spark: SparkSession,
    src: str,
    checkpoint: str,
    fact_path: str,
    dim_path: str,
    as_of: datetime | None = None,
    hours: float = STALE_HOURS,
    multi_line: bool = True,
    stamped_at: datetime | None = None,
    tables: dict[str, str] | None = None,
    quarantine: str | None = None,
    partials: Sequence[Partials] = (),
) -> DataFrame:
    """Load the API files that no earlier run has read, as one batch; returns one row about the run.

    The status is SKIPPED when there was nothing new or nothing fresh, else LOADED. `as_of` decides
    what is stale; the readings are stamped with the time of writing, or with `stamped_at`. Rows
    without a station id are dropped and counted. Documents that are not JSON are counted apart, and kept in the
    table at `quarantine` if that is given. `tables` may name the catalog tables `fact` and `dim`. `partials` are kept
    as `write_fact` says. All counts are taken while the batch is staged.
    """
    pin_utc(spark)
    as_of = as_of or datetime.now(timezone.utc)
    stamp = iso_stamp(stamped_at or datetime.now(timezone.utc))
    totals, names = _Totals(), tables or {}

    def load(batch: DataFrame, _batch_id: int) -> None:
        with staging(batch.sparkSession):
            known, readable = F.col("waqi_idx").isNotNull(), F.col(UNREADABLE).isNull()
            fresh = known & complete() & recent(as_of, hours)
            flat, counts = stage_counted(
                flatten_api(batch, stamp, more=(UNREADABLE, FILE)),
                "flat",
                raw=F.count("*"),
                fresh=F.count_if(fresh),
                dropped=F.count_if(~known & readable),
                unreadable=F.count_if(~readable),
            )
            totals.add(counts)
            if quarantine and counts["unreadable"]:
                write_quarantine(flat, quarantine, stamp)
            if counts["fresh"]:
                kept = flat.filter(fresh).drop(UNREADABLE, FILE)
                readings = stage(dedup_latest(kept), "readings")
                totals.stations += write_dim(latest_dim(readings), dim_path, table=names.get("dim"))
                rows = select_fact(readings)
                totals.rows += write_fact(rows, fact_path, names.get("fact"), partials)

    _run(stream_api_bronze_checked(spark, src, multi_line), checkpoint, load)
    return totals.as_frame(
        spark, stamp, "no new records", f"all records are incomplete or older than {hours}h"
    )


def load_csv_once(
    spark: SparkSession,
    src: str,
    checkpoint: str,
    fact_path: str,
    dim_path: str,
    as_of: datetime | None = None,
    mapping=CITY_KEYWORDS,
    tables: dict[str, str] | None = None,
    partials: Sequence[Partials] = (),
) -> DataFrame:
    """Load the historical CSV files; a file that was loaded before is never read again.

    The files are parsed once, into a staging table; counts, stations and readings come from it.
    `as_of` is the stamp of the readings. `tables` may name the catalog tables `fact` and `dim`. `partials` are kept
    as `write_fact` says.
    """
    pin_utc(spark)
    stamp = iso_stamp(as_of or datetime.now(timezone.utc))
    totals, names = _Totals(), tables or {}

    def load(batch: DataFrame, _batch_id: int) -> None:
        with staging(batch.sparkSession):
            known = F.col("waqi_idx").isNotNull()
            typed, counts = stage_counted(
                typed_csv(batch, stamp, mapping),
                "typed",
                raw=F.count_if(known),
                fresh=F.count_if(known & complete()),
                dropped=F.count_if(~known),
            )
            totals.add(counts)
            clean = identified(typed)
            totals.stations += write_dim(latest_dim(clean), dim_path, table=names.get("dim"))
            if counts["fresh"]:
                # The insert reads its batch several times: for the months and for the keys.
                readings = stage(select_fact(dedup_latest(require_not_null(clean))), "readings")
                totals.rows += write_fact(readings, fact_path, names.get("fact"), partials)

    _run(stream_csv_bronze(spark, src), checkpoint, load)
    return totals.as_frame(spark, stamp, "already loaded", "no valid records")
