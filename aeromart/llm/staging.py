"""Intermediate tables in the folder that all executors share."""

from pyspark.sql import DataFrame

from aeromart.session import remove, shared_folder, stage


def staged(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Writes df as Parquet under spark.checkpoint.dir and reads it back: computed once, survives lost executors.

    Inside `aeromart.session.staging` the table goes at the end, unless it is to be kept.
    """
    if not keep:
        return stage(df, f"llm-{name}")
    path = shared_folder(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes the files of staged tables that nothing reads any more."""
    for table in tables:
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            remove(table.sparkSession, folder)
