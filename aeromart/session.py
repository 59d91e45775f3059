"""Session settings and the shared folder for intermediate data."""

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def pin_utc(spark: SparkSession) -> SparkSession:
    """Calendar days are those of UTC on every machine."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach; a temporary one only on a local master."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="aeromart-")


def shared_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage", partition_cols=()) -> DataFrame:
    """Compute `df` once, into Parquet in the shared folder, and read it back.

    The files survive lost executors, and later reads are pruned by column. Inside `staging` they
    are removed at its end; elsewhere they stay, since the caller may read them at any time.
    """
    path = shared_folder(df.sparkSession, name)
    writer = df.write
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    if (paths := _staged.get()) is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """`stage`, and aggregates over the rows that are taken while they are written: no second scan."""
    seen = Observation()
    staged = stage(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), name)
    # Of an empty table AQE may leave the counting out.
    return staged, dict.fromkeys(counts, 0) | {k: v for k, v in seen.get.items() if v is not None}


@contextmanager
def staging(spark: SparkSession):
    """What is staged inside belongs to one job and is removed when the job ends."""
    token = _staged.set([])
    try:
        yield
    finally:
        paths = _staged.get()
        _staged.reset(token)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark keeps it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
