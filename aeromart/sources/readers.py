"""Readers. Every table has an explicit schema, so partition values stay text (`month=04`)."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import (
    API_FILE_SCHEMA,
    DAILY_SCHEMA,
    DIM_SCHEMA,
    FACT_SCHEMA,
    LOADS_SCHEMA,
    QUARANTINE_SCHEMA,
    RANKING_SCHEMA,
    REFRESHES_SCHEMA,
    STARTS_SCHEMA,
    STATION_SCHEMA,
)


def read_api_bronze(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Raw API documents under Hive folders.

    `multi_line` for files of one indented document each; off for the one-document-per-line
    files that `land_bronze` writes, which Spark can also split.
    """
    return spark.read.schema(API_FILE_SCHEMA).option("multiLine", multi_line).json(path)


#: Columns that `with_unreadable` adds.
UNREADABLE, FILE = "_unreadable", "_file"


def _with_unreadable(reader, multi_line: bool, path: str) -> DataFrame:
    schema = T.StructType([*API_FILE_SCHEMA.fields, T.StructField("_text", T.StringType())])
    raw = (
        reader.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_text")
        .json(path)
    )
    # A document of which some field alone has an odd type keeps its other fields: it is readable.
    nothing = F.col("status").isNull() & F.col("data").isNull()
    kept = {UNREADABLE: F.when(nothing, F.col("_text")), FILE: F.col("_metadata.file_path")}
    return raw.withColumns(kept).drop("_text")


def read_api_bronze_checked(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """`read_api_bronze` with two more columns: the text of a document that is not JSON (NULL for others), and its file.

    The good rows are the same. Such a row has no other values.
    """
    return _with_unreadable(spark.read, multi_line, path)


def stream_api_bronze_checked(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The same as a file stream."""
    return _with_unreadable(spark.readStream, multi_line, path)


def stream_api_bronze(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The same as a file stream."""
    return spark.readStream.schema(API_FILE_SCHEMA).option("multiLine", multi_line).json(path)


def _csv(reader):
    # Headers are checked per file: a file with its columns in another order fails, where
    # binding by position would silently mix them up.
    return reader.option("header", True).option("enforceSchema", False)


def read_csv_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Historical CSV with every column as text and the headers trimmed and lower-cased."""
    raw = _csv(spark.read).csv(path)
    return raw.toDF(*[name.strip().lower() for name in raw.columns])


def stream_csv_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The same as a file stream; the column names come from one read of a header."""
    names = _csv(spark.read).csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    reader = _csv(spark.readStream).schema(schema)
    return reader.csv(path).toDF(*[name.strip().lower() for name in names])


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool = False
) -> DataFrame:
    """Parquet table; with `missing_ok` a path that does not exist is an empty table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_fact(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    return read_table(spark, path, FACT_SCHEMA, missing_ok)


def read_quarantine(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """Documents that could not be read."""
    return read_table(spark, path, QUARANTINE_SCHEMA, missing_ok)


def read_loads(spark: SparkSession, fact_path: str) -> DataFrame:
    """The ledger beside a fact table: which months each load may have added to."""
    return read_table(spark, loads_path(fact_path), LOADS_SCHEMA, missing_ok=True)


def loads_path(fact_path: str) -> str:
    return fact_path.rstrip("/") + "_loads"


def read_refreshes(spark: SparkSession, gold: str) -> DataFrame:
    """The last load that each finished refresh of `gold` covers."""
    return read_table(spark, refreshes_path(gold), REFRESHES_SCHEMA, missing_ok=True)


def refreshes_path(gold: str) -> str:
    return f"{gold}/refreshes"


def read_starts(spark: SparkSession, gold: str) -> DataFrame:
    """Every refresh of `gold` that began to write, finished or not."""
    return read_table(spark, starts_path(gold), STARTS_SCHEMA, missing_ok=True)


def starts_path(gold: str) -> str:
    return f"{gold}/refresh_starts"


def broken_refresh(spark: SparkSession, gold: str) -> str | None:
    """`full` or `months` if refreshes of that kind began after the last one that finished, else None.

    Refreshes are numbered in the order in which they began, and one that finishes makes good
    all that broke off before it.
    """
    finished = read_refreshes(spark, gold).agg(F.max("number")).first()[0]
    later = read_starts(spark, gold).filter(F.col("number") > F.lit(finished or 0))
    full = later.agg(F.bool_or("full")).first()[0]
    return None if full is None else "full" if full else "months"


def read_dim(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    return read_table(spark, path, DIM_SCHEMA, missing_ok)


def read_daily(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    return read_table(spark, path, DAILY_SCHEMA, missing_ok)


def read_ranking(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    return read_table(spark, path, RANKING_SCHEMA, missing_ok)


def read_station_summary(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    return read_table(spark, path, STATION_SCHEMA, missing_ok)
