"""Toxic passages: maximum-scoring segments of token log-odds, with extreme-value significance.

Learning. A token is a lower-cased run of letters; its first 6, 7 and 8 bytes count as tokens too,
so that a form that was never seen can be judged by its stem. Over a bounded sample of labelled documents, the
document counts of every token in toxic and in other documents give a log-odds ratio with an
informative Dirichlet prior (the prior of a token is proportional to its overall count). Tokens whose ratio is significantly positive
make up the table, all of them: the sample bounds it. Any other token scores REST.

Scanning. All maximal scoring segments of a document are found in linear time (Ruzzo and Tompa);
between two tabled tokens the scores are constant, so only tabled tokens are visited. A segment of
score s in a text of n tokens has the expected count E = K n exp(-lambda s) by chance (Karlin and
Altschul); lambda and K come from the sample's other documents. A document's evidence is
the sum of -log E over its segments with E below 1, and a logistic curve turns it into a probability.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeromart.llm import words as W
from aeromart.llm.labelled import LABELLED_ROWS, labelled_texts, sample_labels

STEMS = (6, 7, 8)
#: Score of a token outside the table; below zero, so that segments end.
REST = -0.4
#: Least z-score of a tabled token, and least number of toxic documents that hold it.
LEAST_Z, LEAST_DOCS = 3.2, 3
#: Prior counts as a share of the observed ones.
PRIOR = 0.1
THRESHOLD = 0.5

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def tokens(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """(first, hashes): hashes of the whole tokens and, for each length of STEMS, of the stems (0: none)."""
    texts = W.Texts(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))
    starts, ends, first = W.spans(texts, _LETTER[texts.raw])
    found = [W.span_hashes(texts.raw, starts, ends)]
    for i, size in enumerate(STEMS):
        hashes = np.zeros(len(starts), np.uint64)
        longer = np.flatnonzero(ends - starts > size)
        hashes[longer] = W.mixed(W.span_hashes(texts.raw, starts[longer], starts[longer] + size) + np.uint64(i + 1))
        found.append(hashes)
    return first, found


@dataclass
class Lexicon:
    keys: np.ndarray  # sorted token hashes
    scores: np.ndarray
    rate: float = 1.0  # lambda
    scale: float = 1.0  # K
    slope: float = 1.0
    offset: float = -1.0

    def __post_init__(self):
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.keys & np.uint64((1 << 20) - 1)] = True

    def found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the hashes that are in the table."""
        maybe = np.flatnonzero(self.sieve[hashes & np.uint64((1 << 20) - 1)])
        if not len(maybe) or not len(self.keys):
            return maybe[:0], np.zeros(0)
        at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
        same = self.keys[at] == hashes[maybe]
        return maybe[same], self.scores[at[same]]

    def hits(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, positions, scores) of the tabled tokens: a whole token before its longest stem, a stem at half its score."""
        first, found = tokens(column)
        best = np.zeros(int(first[-1]) if len(first) else 0)
        for weight, hashes in zip((0.5,) * len(STEMS) + (1.0,), [*found[1:], found[0]], strict=True):
            at, score = self.found(hashes)
            best[at] = weight * score
        at = np.flatnonzero(best)
        return first, at, best[at]

    def evidence(self, column: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """Per document: the evidence, and its significant segments as (first token, last token, -log E)."""
        first, at, scores = self.hits(column)
        rows = len(first) - 1
        out, passages = np.zeros(rows), [[] for _ in range(rows)]
        bounds = np.searchsorted(at, first)
        for row in np.flatnonzero(np.diff(bounds)):
            low, high = bounds[row], bounds[row + 1]
            n = int(first[row + 1] - first[row])
            for start, stop, score in segments((at[low:high] - first[row]).tolist(), scores[low:high].tolist()):
                bits = self.rate * score - np.log(max(self.scale * n, 1e-9))
                if bits > 0:
                    out[row] += bits
                    passages[row].append((start, stop, float(bits)))
        return out, passages

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(evidence) + self.offset, -40, 40)))


def segments(positions: list[int], scores: list[float], rest: float = REST) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a text whose other tokens score `rest`.

    Each new positive token starts a segment; it is joined with an earlier one as long as that one
    begins at a lower and ends at a lower running total. Every segment is pushed and merged once.
    """
    stack: list[tuple[int, int, float, float]] = []  # first, last, total before, total after
    total, seen = 0.0, 0
    for position, score in zip(positions, scores, strict=True):
        total += rest * (position - seen)
        first, before, total = position, total, total + score
        seen = position + 1
        last = position
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= before:
                k -= 1
            if k < 0 or stack[k][3] >= total:
                stack.append((first, last, before, total))
                break
            first, before = stack[k][0], stack[k][2]
            del stack[k:]
    return [(a, b, after - before) for a, b, before, after in stack]


def token_counts(sampled: DataFrame) -> DataFrame:
    """token, toxic, others: in how many of the documents (text, label) a token occurs, added up by block before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "text"):
            first, found = tokens(block["text"])
            owner, label = W.owners_of(first), block["label"].to_numpy() > 0
            counts = []
            for hashes in found:
                keep = hashes != 0
                rows, values = owner[keep], hashes[keep]
                order = np.lexsort((rows, values))
                rows, values = rows[order], values[order]
                new = np.ones(len(values), bool)
                new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
                distinct, where = np.unique(values[new], return_inverse=True)
                toxic = np.bincount(where, label[rows[new]], len(distinct)).astype(np.int64)
                counts.append((distinct.view(np.int64), toxic, np.bincount(where, minlength=len(distinct)) - toxic))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*counts, strict=True)], names=["token", "toxic", "others"])

    rows = sampled.select("text", "label").mapInArrow(run, "token long, toxic long, others long")
    return rows.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("others").alias("others"))


def one_of_each(sampled: DataFrame) -> DataFrame:
    """One document of each group with the same smallest shingle hash and label, so that copies do not count as evidence."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "text"):
            first, found = tokens(block["text"])
            windows = W.window_hashes(found[0], 3)
            windows[~W.windows_inside(first, 3, len(found[0]))] = np.uint64(2**64 - 1)
            smallest = [int(windows[a : max(a, b - 2)].min()) if b - a > 2 else int(found[0][a]) if b > a else 0 for a, b in zip(first[:-1], first[1:], strict=True)]
            keys = pa.array(np.array(smallest, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([block["doc_id"], block["text"], block["label"], keys], names=["doc_id", "text", "label", "key"])

    keyed = sampled.select("doc_id", "text", "label").mapInArrow(run, "doc_id long, text string, label int, key long")
    first = Window.partitionBy("key", "label").orderBy("doc_id", "text")
    return keyed.withColumn("place", F.row_number().over(first)).where("place = 1").select("doc_id", "text", "label")


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = LABELLED_ROWS, keep: Column | None = None) -> Lexicon:
    """The table of tokens, lambda, K and the logistic curve, from at most `bound` labelled documents.

    Without labels of both kinds the table is empty and every document scores low.
    """
    sampled = one_of_each(labelled_texts(docs, sample_labels(labels, label, bound, keep)))
    counts = token_counts(sampled)
    sums = counts.agg(F.sum("toxic").alias("all_toxic"), F.sum("others").alias("all_others"))
    prior = PRIOR * (F.col("toxic") + F.col("others"))
    prior_all = PRIOR * (F.col("all_toxic") + F.col("all_others"))
    odds = lambda own, total: F.log((own + prior) / (total + prior_all - own - prior))
    rated = (
        counts.where(F.col("toxic") >= LEAST_DOCS)
        .crossJoin(F.broadcast(sums))  # one row
        .withColumn("score", odds(F.col("toxic"), F.col("all_toxic")) - odds(F.col("others"), F.col("all_others")))
        .withColumn("z", F.col("score") / F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("others") + prior)))
        .where(f"z >= {LEAST_Z} AND score > 0")
        .select("token", "score")
        .toArrow()
    )
    keys = rated["token"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return calibrated(sampled, Lexicon(keys[order], rated["score"].to_numpy()[order]))


def calibrated(sampled: DataFrame, table: Lexicon) -> Lexicon:
    """lambda, K and the logistic curve; one pass gives, per sampled document, the tokens, the best segment and the evidence."""

    def run(batches: Iterable[pa.RecordBatch], lexicon: Lexicon, wanted: str) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "text"):
            if wanted == "evidence":
                values = [(e, 0.0, 0) for e in lexicon.evidence(block["text"])[0]]
            else:
                first, at, scores = lexicon.hits(block["text"])
                bounds = np.searchsorted(at, first)
                values = []
                for row in range(block.num_rows):
                    low, high = bounds[row], bounds[row + 1]
                    own = segments((at[low:high] - first[row]).tolist(), scores[low:high].tolist()) if high > low else []
                    values.append((max((s for *_, s in own), default=0.0), float(scores[low:high].sum()), int(high - low)))
            n = np.diff(tokens(block["text"])[0]) if wanted != "evidence" else np.zeros(block.num_rows, np.int64)
            columns = zip(*values, strict=True)
            yield pa.RecordBatch.from_arrays([block["label"], pa.array(n, pa.int64()), *(pa.array(c, t) for c, t in zip(columns, (pa.float64(), pa.float64(), pa.int64()), strict=True))], names=["label", "n", "best", "total", "hits"])

    schema = "label int, n long, best double, total double, hits long"
    plain = sampled.where("label = 0").mapInArrow(lambda b: run(b, table, "best"), schema).toArrow()
    hits, n = int(pc.sum(plain["hits"]).as_py() or 0), int(pc.sum(plain["n"]).as_py() or 0)
    if n and len(table.keys):
        # lambda: the positive root of sum p exp(lambda s) = 1, with the mean score of tabled tokens in other documents.
        share, mean = (hits + 0.5) / (n + 1), float(pc.sum(plain["total"]).as_py()) / hits if hits else float(np.median(table.scores))
        low, high = 1e-3, 20.0
        for _ in range(60):
            middle = (low + high) / 2
            grown = share * np.exp(min(700.0, middle * mean)) + (1 - share) * np.exp(middle * REST)
            low, high = (middle, high) if grown < 1 else (low, middle)
        table.rate = low
        # K: with E = K n exp(-lambda s), the best segment's n exp(-lambda s) has the mean 1 / K.
        sizes, best = np.maximum(plain["n"].to_numpy(), 1), plain["best"].to_numpy()
        table.scale = float(1 / np.mean(sizes * np.exp(-table.rate * best)))
    every = sampled.mapInArrow(lambda b: run(b, table, "evidence"), schema).toArrow()
    table.slope, table.offset = _logistic(np.log1p(every["best"].to_numpy()), every["label"].to_numpy() > 0)
    return table


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and offset by Newton steps with a small ridge."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 0.05 * np.eye(2)
        w += np.clip(np.linalg.solve(h, a.T @ (y - p) - 0.05 * w), -3, 3)
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, -2.0)


def score_toxicity(docs: DataFrame, table: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted and the significant passages (first word, last word, evidence) of every row.

    A null or empty text has no passage. Repeated ids give repeated rows, a null id stays null;
    other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("evidence", pa.float64())]))
        for block in W.blocks(batches, "text"):
            evidence, passages = table.evidence(block["text"])
            listed = pa.array([[{"first": a, "last": b, "evidence": e} for a, b, e in row] for row in passages], kind)
            yield pa.RecordBatch.from_arrays([block["doc_id"], pa.array(table.probability(evidence)), listed], names=["doc_id", "score", "passages"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, passages array<struct<first: long, last: long, evidence: double>>")
    return scored.select("doc_id", "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "passages")
