"""Bronze to gold, with the data-quality gate in between."""

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import STALE_HOURS
from ..operators.quality import dq_check, dq_summary
from ..plans.gold import refresh_gold
from ..plans.merged import check_partials, dq_check_merged, station_day_partials
from ..sources.readers import read_dim, read_fact
from .incremental import run_incremental


def _or_none(read, spark, path):
    try:
        return read(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def run_pipeline(
    spark: SparkSession,
    src: str,
    checkpoint: str,
    silver: str,
    gold: str,
    as_of: datetime,
    hours: float = STALE_HOURS,
    multi_line: bool = True,
    full: bool = False,
    tz: str | None = None,
    tables: dict[str, str] | None = None,
    stamped_at: datetime | None = None,
    quarantine: str | None = None,
    merged: bool = False,
    **checks,
) -> DataFrame:
    """Load new API files, check the silver tables and, only if all checks pass, refresh gold.

    Returns one row: the load's summary, the check counts and the outcome. A skipped load does
    not stop the run: the checks decide. `checks` are passed on to `dq_check`; `full` and `tz` to
    `refresh_gold`. New readings are stamped with the time of writing, or with `stamped_at`: with an `as_of` in the
    past, the freshness check means something only if the stamp lies there too. `tables` registers what is written in the catalog: names for `fact`, `dim`,
    `daily`, `ranking` and `station`. Documents that are not JSON are kept at `quarantine`.

    With `merged` every load keeps its check counts and its sums by station and day; the report and gold are then
    merged from these, and neither reads the fact table.
    """
    fact_path, dim_path = f"{silver}/fact_aqi", f"{silver}/dim_station"
    bounds = {k: checks[k] for k in ("lo", "hi") if k in checks}
    kept = (check_partials(**bounds), station_day_partials(tz)) if merged else ()
    load = run_incremental(
        spark,
        src,
        checkpoint,
        fact_path,
        dim_path,
        as_of,
        hours,
        multi_line,
        stamped_at=stamped_at,
        tables=tables,
        quarantine=quarantine,
        partials=kept,
    )
    fact, dim = _or_none(read_fact, spark, fact_path), _or_none(read_dim, spark, dim_path)
    if fact is None and dim is None:
        verdict = spark.sql(
            "SELECT false AS quality_passed, 0L AS checks_passed, 3L AS checks_total"
        ).first()
    else:
        if merged and fact is not None:
            report = dq_check_merged(spark, fact_path, dim, as_of, **checks)
        else:
            report = dq_check(fact, dim, as_of, **checks)
        verdict = dq_summary(report).first()
    passed = verdict["quality_passed"]
    done = None
    if passed:
        done = refresh_gold(spark, fact_path, dim_path, gold, as_of, full, tz, tables, merged)
    return load.withColumnsRenamed({"status": "load_status", "reason": "load_reason"}).select(
        "*",
        F.lit(passed).alias("quality_passed"),
        *[F.lit(verdict[c]).cast("bigint").alias(c) for c in ("checks_passed", "checks_total")],
        F.lit("gold refreshed" if passed else "stopped: checks failed").alias("outcome"),
        *[
            F.lit(getattr(done, name) if done else 0).cast("bigint").alias(name)
            for name in ("daily_rows", "ranking_rows", "station_rows")
        ],
    )
