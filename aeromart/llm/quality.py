"""Quality classifier: boosted trees over document statistics, scored by numpy over flat node arrays.

The statistics are those of `statistics.py`. A bounded sample of labelled rows trains the trees on
the driver (at most LABELLED_ROWS rows of some thirty numbers each reach it); every document is
then measured and scored where it is read, without a shuffle.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeromart.llm import statistics, trees
from aeromart.llm.labelled import LABELLED_ROWS, labelled_texts, sample_labels
from aeromart.llm.words import SMALL_BLOCK, Texts, blocks

THRESHOLD = 0.7


def sample_matrix(docs: DataFrame, labels: DataFrame, label: str, bound: int = LABELLED_ROWS, keep: Column | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(statistics, labels) of a bounded sample of labelled documents, in an order that does not vary."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", SMALL_BLOCK):
            matrix = statistics.measure(Texts(block["text"]))[1]
            values = pa.FixedSizeListArray.from_arrays(pa.array(matrix.ravel()), matrix.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([block["doc_id"], block["label"], values], names=["doc_id", "label", "x"])

    sampled = labelled_texts(docs, sample_labels(labels, label, bound, keep))
    # Repeated ids could make the join larger than the sample; the bound holds for them too.
    rows = sampled.mapInArrow(run, "doc_id long, label int, x array<double>").limit(2 * bound).toArrow()
    x = np.array(rows["x"].to_pylist(), dtype=float).reshape(rows.num_rows, len(statistics.FEATURES))
    y = rows["label"].to_numpy()
    order = np.lexsort((*x.T[:4], rows["doc_id"].to_numpy()))
    return x[order], (y[order] > 0).astype(float)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = LABELLED_ROWS, keep: Column | None = None) -> trees.Trees:
    """Trees for the labels. Without labels, or with one class only, the model is a constant."""
    return trees.fit(*sample_matrix(docs, labels, label, bound, keep))


def score_quality(docs: DataFrame, model: trees.Trees, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= threshold) of every row of `docs`.

    Null and empty texts have the score of a document without words. Rows are neither dropped nor
    merged: repeated ids give repeated rows, a null id stays null. Other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", SMALL_BLOCK):
            score = model.probabilities(statistics.measure(Texts(block["text"]))[1])
            yield pa.RecordBatch.from_arrays([block["doc_id"], pa.array(score)], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
