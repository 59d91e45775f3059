"""Quality rules: fixed limits, and boosted trees with monotonic constraints for the rest.

The trees see the same statistics as the classifier, but a larger share of symbols, repeated
windows, repeated lines, one word, pipes or words without letters can only lower a document's score.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from aeromart.llm import statistics, trees
from aeromart.llm.labelled import LABELLED_ROWS
from aeromart.llm.quality import sample_matrix
from aeromart.llm.words import SMALL_BLOCK, Texts, blocks

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: A document stays if the trees give it at least this probability of being good.
KEEP_FROM = 0.5
MEASURES = (*statistics.BASE, "base_failed", "kept")


def fit_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = LABELLED_ROWS) -> trees.Trees:
    """Monotonic trees for the labels; without labels they keep everything."""
    signs = np.array([-1 if name in statistics.FALLING else 0 for name in statistics.FEATURES])
    return trees.fit(*sample_matrix(docs, labels, label, bound), signs=signs)


def judge(column: pa.Array, model: trees.Trees, keep_from: float = KEEP_FROM) -> dict[str, np.ndarray]:
    base, matrix = statistics.measure(Texts(column))
    failed = (base["n_words"] < LEAST_WORDS) | (100 * base["n_repeat_words"] > MOST_REPEATED_PERCENT * base["n_words"])
    return base | {"base_failed": failed, "kept": ~failed & (model.probabilities(matrix) >= keep_from)}


def quality_rules(docs: DataFrame, model: trees.Trees, keep_from: float = KEEP_FROM) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row of `docs`.

    A null or empty text has zero counts and fails the base rule. Repeated ids give repeated rows,
    a null id stays null. Other columns are not read.
    """
    schema = "doc_id long, " + ", ".join(f"{n} long" for n in statistics.BASE) + ", base_failed boolean, kept boolean"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", SMALL_BLOCK):
            found = judge(block["text"], model, keep_from)
            yield pa.RecordBatch.from_arrays([block["doc_id"], *(pa.array(found[n]) for n in MEASURES)], names=["doc_id", *MEASURES])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: trees.Trees, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", SMALL_BLOCK):
            yield block.filter(pa.array(judge(block["text"], model, keep_from)["kept"]))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
