"""Writers.

Rows are laid out by the table's partition columns before a write, with a rebalance that AQE
splits where one partition is large and merges where many are small: neither one task per hot
partition nor thousands of small files.
"""

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..fixed import (
    BRONZE_PARTITIONS,
    DIM_SCHEMA,
    FACT_PARTITIONS,
    FACT_SCHEMA,
    LANDED_SOURCE,
    LOADS_SCHEMA,
    MONTH_PARTITIONS,
    QUARANTINE_SCHEMA,
    RANKING_SCHEMA,
    REFRESHES_SCHEMA,
    STARTS_SCHEMA,
)
from ..functions import bronze_key
from ..operators.cleaning import new_only
from ..operators.landing import landable
from ..session import stage, staging
from .partials import Partials, note_part
from .readers import (
    FILE,
    UNREADABLE,
    loads_path,
    read_loads,
    read_ranking,
    read_starts,
    read_table,
    refreshes_path,
    starts_path,
)


def _laid_out(df: DataFrame, partition_cols) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in partition_cols])


def _observed_rows(counted: Observation) -> int:
    """Rows seen during a finished write; 0 if AQE found it empty and left the counting out."""
    return counted.get.get("rows", 0)


def _save(
    df: DataFrame, path: str, mode: str, partition_cols=(), table=None, dynamic=False
) -> int:
    """Snappy Parquet; returns the rows written.

    They are counted in the last stage of the write, where a task that runs again after a lost
    executor is not counted twice. With `table` the result is also registered in the catalog.
    """
    counted = Observation()
    rows = _laid_out(df, partition_cols).observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode(mode).option("compression", "snappy")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if table:
        writer.option("path", path).format("parquet").saveAsTable(table)
    else:
        writer.parquet(path)
    return _observed_rows(counted)


def span(df: DataFrame, cols) -> tuple[str | None, str | None]:
    """Smallest and largest joined partition text of `df`; two Nones if it is empty."""
    joined = F.concat_ws("/", *cols)
    return tuple(df.agg(F.min(joined), F.max(joined)).first())


def in_span(df: DataFrame, cols, ends) -> DataFrame:
    """Rows whose joined partition text lies within the span: a filter that prunes folders."""
    low, high = ends
    if low is None:
        return df.filter(F.lit(False))
    return df.filter(F.concat_ws("/", *cols).between(low, high))


def insert_new(
    batch: DataFrame,
    path: str,
    keys,
    partition_cols=(),
    prune_cols=(),
    schema=None,
    table: str | None = None,
) -> int:
    """Append the rows of `batch` whose key the table at `path` does not hold; returns how many.

    Running it again with the same rows adds nothing, so a batch may be replayed. `prune_cols`
    are partition columns that follow from the key: only their span in the batch is looked into.
    The keys of `batch` must be unique; `batch` is read more than once.
    """
    fresh = _unseen(batch, path, keys, prune_cols, schema)
    return _save(fresh, path, "append", partition_cols, table)


def _unseen(batch: DataFrame, path: str, keys, prune_cols=(), schema=None, values: DataFrame | None = None) -> DataFrame:
    """`values` are the values of `prune_cols` in the batch, where they are known already."""
    target = read_table(batch.sparkSession, path, schema or batch.schema, missing_ok=True)
    if prune_cols:
        target = in_span(target, prune_cols, span(batch if values is None else values, prune_cols))
    return new_only(batch, target, keys)


def write_fact(
    df: DataFrame, path: str, table: str | None = None, partials: Sequence[Partials] = ()
) -> int:
    """Append readings that are not in the fact table yet, by station and instant.

    Year and month follow from the instant, the city does not follow from the station, so
    only the span of months of the batch is looked into, in every city. The months are noted in the
    ledger first: a load that breaks off may cost a refresh, but is never overlooked by one.

    `partials` are summaries to be kept of what is inserted, for `read_partials`. The rows to insert are then
    staged: the table and all summaries are written from the same rows. The months are read back from the ledger, so
    `df` is computed twice, for them and for the rows.
    """
    load_id = note_load(df, path)
    months = read_loads(df.sparkSession, path).filter(F.col("load_id") == load_id)
    fresh = _unseen(df, path, ("waqi_idx", "measured_at"), MONTH_PARTITIONS, FACT_SCHEMA, months)
    if not partials:
        return _save(fresh, path, "append", FACT_PARTITIONS, table)
    with staging(df.sparkSession):
        fresh = stage(fresh, "fresh")
        rows = _save(fresh, path, "append", FACT_PARTITIONS, table)
        for kind in partials:
            note_part(fresh, months, path, kind, load_id)
    return rows


def note_load(df: DataFrame, fact_path: str) -> int:
    """Append the months of a batch to the ledger of the fact table, under the next load id; returns the id."""
    last = read_loads(df.sparkSession, fact_path).agg(F.max("load_id")).first()[0]
    load_id = (last or 0) + 1
    months = df.select(*MONTH_PARTITIONS).distinct()
    noted = months.select(F.lit(load_id).cast("bigint").alias("load_id"), *MONTH_PARTITIONS)
    noted.select(*LOADS_SCHEMA.fieldNames()).coalesce(1).write.mode("append").parquet(loads_path(fact_path))
    return load_id


def _note(spark: SparkSession, path: str, row: tuple, schema) -> None:
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)


def note_start(spark: SparkSession, gold: str, full: bool) -> int:
    """Note that a refresh is about to write; returns its number.

    A start without a finish tells the next refresh that tables may lack rows: of all months after
    a full one, whose overwrite removes everything first, else of the ranking table alone.
    """
    number = (read_starts(spark, gold).agg(F.max("number")).first()[0] or 0) + 1
    _note(spark, starts_path(gold), (number, full, datetime.now(timezone.utc)), STARTS_SCHEMA)
    return number


def note_refresh(spark: SparkSession, gold: str, load_id: int | None, number: int) -> None:
    """Note that refresh `number` finished, and that gold covers all loads up to `load_id`."""
    row = (load_id or 0, datetime.now(timezone.utc), number)
    _note(spark, refreshes_path(gold), row, REFRESHES_SCHEMA)


def write_dim(df: DataFrame, path: str, replace: bool = False, table: str | None = None) -> int:
    """Append stations that are not in the dimension yet; a known station keeps its row.

    `replace` overwrites the dimension instead, and must not read from it.
    """
    if replace:
        return _save(df, path, "overwrite", table=table)
    return insert_new(df, path, ("waqi_idx",), schema=DIM_SCHEMA, table=table)


def write_quarantine(df: DataFrame, path: str, noted_at: str) -> int:
    """Keep the documents of `df` (columns of `read_api_bronze_checked`) that could not be read.

    One row for each file and text, with the number of copies; a replayed batch adds nothing.
    """
    broken = df.filter(F.col(UNREADABLE).isNotNull())
    rows = broken.groupBy(F.col(FILE).alias("file"), F.col(UNREADABLE).alias("document")).agg(
        F.count("*").alias("copies"), F.lit(noted_at).alias("noted_at")
    )
    return insert_new(rows, path, ("file", "document"), schema=QUARANTINE_SCHEMA)


def insert_bucketed(
    batch: DataFrame, table: str, path: str, keys, buckets: int, partition_cols=()
) -> int:
    """`insert_new` into a catalog table at `path` whose files are bucketed and sorted by the keys.

    The table's side of the anti-join is already laid out by its keys, so only the batch's keys are shuffled to it, however
    large it is. Keys are spread over the buckets as a whole: a station with very many readings is in all of
    them. Rows travel in parts of bounded size: a large bucket is written by several tasks, in a file each. Keys must not
    be NULL. The number of buckets is fixed when the table is made; `batch` is read twice.
    """
    spark = batch.sparkSession
    fresh = batch
    if spark.catalog.tableExists(table):
        new = unseen_in_bucketed(batch.select(*keys), table, keys).toDF(*[f"_new_{k}" for k in keys])
        same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_new_{k}`")) for k in keys]
        fresh = batch.join(new, same, "left_semi")
    counted = Observation()
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    rows = _laid_out(fresh.withColumn("_bucket", bucket), ["_bucket"]).drop("_bucket")
    rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("append").format("parquet").option("path", path).option("compression", "snappy")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return _observed_rows(counted)


def unseen_in_bucketed(batch: DataFrame, table: str, keys) -> DataFrame:
    """Rows of `batch` whose keys the bucketed table does not hold, by a merge join on the table's own layout."""
    held = batch.sparkSession.table(table).select(*keys)
    return batch.join(held.hint("merge"), list(keys), "left_anti")


def write_daily(
    df: DataFrame, path: str, dynamic: bool = False, table: str | None = None
) -> int:
    """Replace the daily table; with `dynamic`, only the months that `df` holds."""
    return _save(df, path, "overwrite", MONTH_PARTITIONS, table, dynamic)


def write_station_summary(
    df: DataFrame, path: str, dynamic: bool = False, table: str | None = None
) -> int:
    """Replace the station table; with `dynamic`, only the months that `df` holds."""
    return _save(df, path, "overwrite", MONTH_PARTITIONS, table, dynamic)


def write_ranking(df: DataFrame, path: str, months=None, table: str | None = None) -> int:
    """Replace the unpartitioned ranking table.

    With `months` (a table of years and months), `df` holds those months only: the rows of the other
    months are kept. They are staged first, since they come from the files being replaced.
    """
    if months is None:
        return _save(df, path, "overwrite", table=table)
    with staging(df.sparkSession):
        held = read_ranking(df.sparkSession, path, missing_ok=True)
        kept = held.join(months, list(MONTH_PARTITIONS), "left_anti").select(*RANKING_SCHEMA.fieldNames())
        merged = stage(kept.unionByName(df.select(*RANKING_SCHEMA.fieldNames())), "ranking")
        return _save(merged, path, "overwrite", table=table)


def land_bronze(
    responses: DataFrame, path: str, meta_path: str | None = None, **columns: str
) -> int:
    """Keep the successful raw responses under `queried_city=/year=/month=/day=` folders.

    A body is stored as it is, except that line breaks between its tokens become blanks: Spark
    puts many documents in one file, one per line. When it came and from where is kept beside
    it, in a Parquet table at `meta_path`, not in the document. Returns how many were kept.
    `columns` name the columns of `responses`, as in `ingest_outcomes`. The rows are parsed once,
    into a staging table; documents and metadata both come from it.
    """
    with staging(responses.sparkSession):
        kept = stage(_landed(responses, columns), "landing")
        documents = kept.select("body", *BRONZE_PARTITIONS)
        _laid_out(documents, BRONZE_PARTITIONS).write.mode("append").partitionBy(
            *BRONZE_PARTITIONS
        ).text(path)
        beside = meta_path or path.rstrip("/") + "_metadata"
        return _save(kept.drop("body"), beside, "append", MONTH_PARTITIONS)


def _landed(responses: DataFrame, columns) -> DataFrame:
    at = F.col("ingested_at")
    return landable(responses, **columns).select(
        F.regexp_replace("body", r"[\r\n]+\s*", " ").alias("body"),
        F.col("city").alias("queried_city"),
        F.date_format(at, "yyyy").alias("year"),
        F.date_format(at, "MM").alias("month"),
        F.date_format(at, "dd").alias("day"),
        at,
        "ingestion_id",
        # The key of `landable` is there on success alone, so it would judge the document once more.
        bronze_key(F.col("city"), at).alias("s3_key"),
        F.lit(LANDED_SOURCE).alias("source"),
    )
