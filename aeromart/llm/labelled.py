"""Bounded samples of labelled documents, and small helpers that the classifiers share."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many labelled documents are used to fit a classifier.
LABELLED_ROWS = 20_000


def remainder(modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; NULL for a NULL id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def held_out(modulus: int, value: int) -> Column:
    """True for the ids that a classifier may not learn from; a NULL id is never learnt from nor held out."""
    return F.coalesce(remainder(modulus) == value, F.lit(False))


def sample_labels(labels: DataFrame, label: str, bound: int = LABELLED_ROWS, keep: Column | None = None) -> DataFrame:
    """(doc_id, label) of at most `bound` labelled ids: those with the smallest hashes, so the same on every run.

    Rows without an id or a label are left out; an id that is labelled twice counts once, with the
    larger label.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    if keep is not None:
        rows = rows.where(keep)
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, label) of the sampled documents. The sample is bounded, so it is broadcast."""
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
