"""Mergeable partial results, kept beside the fact table load by load.

What a load adds is summarised once, from the rows it inserted, and appended to a table of partials; a
result over all loads is a merge of these few rows, which never reads the fact table. Every append is
a part with an id of its own, and counts only once its months are noted in a ledger of parts: what a broken load leaves
behind is not seen. A month is sound if every load that the fact table's ledger names for it has a part. The others
(after a broken load, or of a fact table that kept no partials so far) are rebuilt from
their raw rows, month by month, as base parts that replace all earlier ones of the month.
"""

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import MONTH_PARTITIONS, PARTS_SCHEMA
from .readers import read_fact, read_loads, read_table

MONTH = list(MONTH_PARTITIONS)


class Partials(NamedTuple):
    """A kind of partial result: the name of its table, its columns, and how they come from fact rows.

    `of` returns the columns of `schema`, which end with year and month; `laid_out` says that its tasks hold few months each.
    """

    name: str
    schema: T.StructType
    of: Callable[[DataFrame], DataFrame]
    laid_out: bool = False


def _rows_path(fact_path: str, kind: Partials) -> str:
    return f"{fact_path.rstrip('/')}_{kind.name}"


def _parts_path(fact_path: str, kind: Partials) -> str:
    return _rows_path(fact_path, kind) + "_parts"


def _at() -> Column:
    """Year and month as one text that is never NULL, so that readings without an instant have a month too."""
    return F.concat_ws("/", *MONTH_PARTITIONS)


def in_months(df: DataFrame, months: DataFrame) -> DataFrame:
    """Rows of the months: their span prunes folders, a semi-join decides."""
    wanted = months.select(_at().alias("_wanted")).distinct()
    low, high = wanted.agg(F.min("_wanted"), F.max("_wanted")).first()
    near = df.filter(_at().between(low, high) if low is not None else F.lit(False))
    return near.join(wanted, _at() == F.col("_wanted"), "left_semi")


def note_part(
    fresh: DataFrame, months: DataFrame, fact_path: str, kind: Partials, load_id: int, base: bool = False
) -> None:
    """Append the partials of the rows `fresh` and then, in the ledger of parts, the months they stand for.

    `months` may name months in which the load inserted nothing.
    """
    part_id = uuid.uuid4().hex
    rows = kind.of(fresh).withColumn("part_id", F.lit(part_id))
    laid_out = rows if kind.laid_out else rows.hint("rebalance", *[F.col(c) for c in MONTH])
    laid_out.write.mode("append").partitionBy(*MONTH).parquet(_rows_path(fact_path, kind))
    noted = months.select(
        F.lit(part_id).alias("part_id"),
        F.lit(load_id).cast("bigint").alias("load_id"),
        F.lit(base).alias("base"),
        *MONTH,
    )
    noted.distinct().coalesce(1).write.mode("append").parquet(_parts_path(fact_path, kind))


def _parts(spark: SparkSession, fact_path: str, kind: Partials) -> tuple[DataFrame, DataFrame]:
    """The parts that count, by `part_id` and month, and the months that are not sound. Ledgers are small: some rows a load."""
    parts = read_table(spark, _parts_path(fact_path, kind), PARTS_SCHEMA, missing_ok=True).withColumn("at", _at())
    loads = read_loads(spark, fact_path)
    if loads.isEmpty():
        loads = read_fact(spark, fact_path).select(F.lit(0).cast("bigint").alias("load_id"), *MONTH).distinct()
    newest = F.max(F.struct("load_id", "part_id"))
    bases = parts.filter("base").groupBy("at").agg(newest.alias("_base"))
    since = F.coalesce(F.col("_base.load_id"), F.lit(-1))

    def after_base(df):
        return df.join(bases, "at", "left").filter(F.col("load_id") > since)

    own = after_base(parts.filter("NOT base"))
    missing = after_base(loads.withColumn("at", _at())).join(own, ["load_id", "at"], "left_anti")
    counted = bases.select("_base.part_id", "at").unionByName(own.select("part_id", "at"))
    return counted.join(missing, "at", "left_anti"), missing.select(*MONTH).distinct()


def read_partials(
    spark: SparkSession, fact_path: str, kind: Partials, months: DataFrame | None = None
) -> DataFrame:
    """The partials of all loads, or of the given months, to be merged by key.

    Months that are not sound are rebuilt first, when this is called; only their raw rows are read. Partials
    that a base has replaced stay on disk, but are not returned.
    """
    parts, missing = _parts(spark, fact_path, kind)
    stale = missing.collect()  # one row a month
    if stale:
        months_to_do = spark.createDataFrame(stale, missing.schema)
        load_id = read_loads(spark, fact_path).agg(F.max("load_id")).first()[0] or 0
        raw = in_months(read_fact(spark, fact_path), months_to_do)
        note_part(raw, months_to_do, fact_path, kind, load_id, base=True)
        parts, _ = _parts(spark, fact_path, kind)
    schema = T.StructType([*kind.schema.fields, T.StructField("part_id", T.StringType())])
    rows = read_table(spark, _rows_path(fact_path, kind), schema, missing_ok=True)
    if months is not None:
        rows = in_months(rows, months)
    counted = parts.withColumnsRenamed({"part_id": "_part_id", "at": "_at"})
    same = (F.col("part_id") == F.col("_part_id")) & (_at() == F.col("_at"))
    return rows.join(counted, same, "left_semi").select(*kind.schema.fieldNames())
