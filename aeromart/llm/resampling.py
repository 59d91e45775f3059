"""Importance resampling towards a target text: hashed word features, weights, and an exact weighted draw.

The weight of a document is the mean log ratio of its features' shares in the target and in the corpus,
in thousandths. A Gumbel number drawn from the document's id is added to it: the highest sums are a
weighted draw without replacement that is the same on every run.

Both passes over the texts are numpy on blocks of bytes: checksums of all words of a block are taken together,
and that of a pair follows from those of its words. What is gathered from the corpus is one count per
bucket. The scores are written once; the cutoff is then found by bisection, each step an exact count
over the written scores, first of the score itself and then of the ids that are tied at it. Drawn rows are
range-partitioned by their order and ranked by the sizes of the ranges before them. No row is
sent to the driver.
"""

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeromart.llm.staging import staged
from aeromart.llm.words import LOWER, Texts, blocks, owners_of, per_row, spans

#: Thresholds that one count job tries at once: four bisection steps.
PROBES = 15
#: Words of up to so many bytes are summed together, longer ones one by one.
SHORT_WORD = 48

#: Fixed value: the polynomial of CRC-32, reversed.
POLYNOMIAL = 0xEDB88320


@dataclass(frozen=True)
class Draw:
    """Buckets of the feature hash, words a document needs to be drawn, percentage drawn, and seed of the draw."""

    buckets: int = 10_000
    least_words: int = 20
    percent: int = 25
    seed: int = 7


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


TABLE = _crc_table()


def _shifts(longest: int) -> np.ndarray:
    """[n, j, b]: what byte j of a checksum, having the value b, becomes when n bytes of zero follow."""
    now = np.arange(256, dtype=np.uint32)[None, :] << np.array([0, 8, 16, 24], np.uint32)[:, None]
    out = [now]
    for _ in range(longest):
        now = TABLE[now & 255] ^ (now >> 8)
        out.append(now)
    return np.stack(out)


SHIFTS = _shifts(SHORT_WORD + 1)

#: Bytes of words: digits, small letters and every byte of a character beyond ASCII.
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True


def checksums(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of raw[starts[i]:ends[i]]."""
    lengths = ends - starts
    order = np.argsort(-np.minimum(lengths, SHORT_WORD + 1), kind="stable")
    order = order[np.searchsorted(-lengths[order], -SHORT_WORD, side="left") :]
    at, sums = starts[order], np.full(len(order), 0xFFFFFFFF, np.uint32)
    active = np.searchsorted(-lengths[order], -np.arange(1, SHORT_WORD + 1), side="right")
    for k, m in enumerate(active.tolist()):
        if not m:
            break
        part = sums[:m]
        sums[:m] = TABLE[(part ^ raw[at[:m] + k]) & 255] ^ (part >> 8)
    out = np.empty(len(starts), np.uint32)
    out[order] = ~sums
    for i in np.flatnonzero(lengths > SHORT_WORD).tolist():
        out[i] = zlib.crc32(raw[starts[i] : ends[i]].tobytes())
    return out


def joined_checksums(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray, first: np.ndarray) -> np.ndarray:
    """CRC-32 of the words first[i] and first[i] + 1 with one space between them."""
    second = first + 1
    lengths = ends[second] - starts[second]
    short = np.minimum(lengths, SHORT_WORD)
    table, left, n = SHIFTS, sums[first], short + 1
    out = table[n, 0, left & 255] ^ table[n, 1, (left >> 8) & 255] ^ table[n, 2, (left >> 16) & 255] ^ table[n, 3, left >> 24]
    space = np.uint32(zlib.crc32(b" "))
    out ^= (table[short, 0, space & 255] ^ table[short, 1, (space >> 8) & 255] ^ table[short, 2, (space >> 16) & 255] ^ table[short, 3, space >> 24]) ^ sums[second]
    for i in np.flatnonzero(lengths > SHORT_WORD).tolist():
        a, b = int(first[i]), int(second[i])
        out[i] = zlib.crc32(raw[starts[b] : ends[b]].tobytes(), zlib.crc32(b" ", int(sums[a])))
    return out


def features(texts: Texts, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the words and of the pairs of consecutive words; where the words and the pairs of each row begin."""
    raw = LOWER[texts.raw]
    starts, ends, first = spans(texts, WORD_BYTE[raw])
    sums = checksums(raw, starts, ends)
    owner = owners_of(first)
    heads = np.flatnonzero(owner[1:] == owner[:-1])
    pairs = joined_checksums(raw, starts, ends, sums, heads)
    return (sums % np.uint32(buckets)).astype(np.int64), (pairs % np.uint32(buckets)).astype(np.int64), first, np.searchsorted(heads, first)


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket: a sum per task, then one per bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for block in blocks(batches, "text"):
            words, pairs, _, _ = features(Texts(block["text"]), buckets)
            total += np.bincount(words, minlength=buckets) + np.bincount(pairs, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    sums = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in sums.collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares in target and corpus, rounded down."""
    s_all, t_all, n = float(corpus.sum() + len(corpus)), float(target.sum() + len(target)), len(corpus)
    ratios = ((float(target[b]) + 1) * s_all / ((float(corpus[b]) + 1) * t_all) for b in range(n))
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel number drawn from the id, rounded down."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, draw: Draw) -> DataFrame:
    """doc_id, n_features, weight, score and eligible (does it have enough words?) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            words, pairs, first, first_pair = features(Texts(block["text"]), draw.buckets)
            n_words, n = np.diff(first), np.diff(first) + np.diff(first_pair)
            total = per_row(first, gain[words]) + per_row(first_pair, gain[pairs])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            score = weight + np.array([gumbel(i, draw.seed) for i in block["doc_id"].to_pylist()], np.int64)
            columns = [block["doc_id"], pa.array(n), pa.array(weight), pa.array(score), pa.array(n_words >= draw.least_words)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_features", "weight", "score", "eligible"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_features long, weight long, score long, eligible boolean")


def _split(rows: DataFrame, key: Column, wanted: int) -> tuple[int, int, int]:
    """The smallest v that at least `wanted` rows have as key or exceed it not, and how many lie below and at v."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    while low < high:
        probes = sorted({low + (high - low) * k // (PROBES + 1) for k in range(1, PROBES + 1)} | {low})
        counts = rows.agg(*[F.count_if(key <= F.lit(p)).alias(f"c{k}") for k, p in enumerate(probes)]).first()
        enough = next((k for k, c in enumerate(counts) if c >= wanted), len(probes))
        low, high = probes[enough - 1] + 1 if enough else low, probes[enough] if enough < len(probes) else high
    below, upto = rows.agg(F.count_if(key < F.lit(low)), F.count_if(key <= F.lit(low))).first()
    return low, below, upto - below


def first_rows(rows: DataFrame, keys: list[Column], wanted: int) -> Column:
    """A condition that holds for exactly `wanted` rows: the first by `keys`, whole numbers that together are unique.

    `rows` must be a written table of at least `wanted` rows: it is counted again and again.
    """
    if not wanted:
        return F.lit(False)
    tied, before = [], []
    for key in keys:
        value, below, at = _split(reduce(DataFrame.where, tied, rows), key, wanted)
        before.append(reduce(Column.__and__, [*tied, key < F.lit(value)]))
        tied.append(key == F.lit(value))
        wanted -= below
        if at == wanted:
            break
    return reduce(Column.__or__, [*before, reduce(Column.__and__, tied)])


def ranked(rows: DataFrame, order: list[Column], out: str = "rank") -> DataFrame:
    """The rows with their place in `order`, from 1. They are range-partitioned, so no task sees all of them.

    The ranges are written once, with the place of each row in its range; only the ranges' sizes
    reach the driver.
    """
    names = rows.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            places = pa.array(np.arange(seen + 1, seen + n + 1))
            seen += n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), places], names=[*names, "_part", "_place"])

    schema = T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_place", T.LongType())])
    ranges = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), "ranges")
    sizes = sorted(ranges.groupBy("_part").count().collect())
    starts = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    found = ranges.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts, strict=False)], "_part int, _before long")
    return ranges.join(F.broadcast(found), "_part").withColumn(out, F.col("_before") + F.col("_place")).select(*names, out)


def resample(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of `docs`; rank is NULL for rows that are not drawn.

    A null or empty text has no features, the weight 0, and is never drawn (unless `least_words` is 0). A null id
    is hashed as an empty text and stands last among equal scores. Repeated rows are rows of their own: of rows that
    tie in score and id, those with fewer features come first, and equal ones in any order. An empty
    target or corpus is allowed; an empty table gives an empty result. Other columns are not read.
    """
    gain = gains(bucket_counts(docs, draw.buckets), bucket_counts(target, draw.buckets))
    rows = staged(scored(docs, gain, draw).withColumn("row", F.monotonically_increasing_id()), "scores")
    order = [-F.col("score"), F.col("doc_id").isNull().cast("long"), F.coalesce("doc_id", F.lit(0)), F.col("n_features"), F.col("row")]
    eligible = rows.where("eligible")
    wanted = draw.percent * eligible.count() // 100
    out = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    drawn = F.col("eligible") & first_rows(eligible, order, wanted)
    left = rows.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked(rows.where(drawn), order).select(*out, "rank").unionByName(left)


def resampling_sql(draw: Draw = Draw()) -> str:
    """DuckDB SQL for the same rows, with CRC-32 computed byte by byte for each distinct feature."""
    features_of = "SELECT {key} AS k, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM {table}"
    return f"""
    WITH crc_table AS (
        SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
            CASE WHEN c % 2 = 1 THEN xor(c // 2, {POLYNOMIAL}) ELSE c // 2 END)) AS t
    ), ascii_lower AS (
        SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
    ), target_words AS (
        SELECT 0 AS k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
    ), doc_features AS (
        {features_of.format(key="k", table="ascii_lower")}
    ), target_features AS (
        {features_of.format(key="k", table="target_words")}
    ), distinct_features AS (
        SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM doc_features UNION SELECT f FROM target_features)
    ), hashed AS (
        SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
            lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) % {draw.buckets} AS b
        FROM distinct_features, crc_table
    ), corpus AS (SELECT b, count(*) AS n FROM doc_features JOIN hashed USING (f) GROUP BY b),
    target AS (SELECT b, count(*) AS n FROM target_features JOIN hashed USING (f) GROUP BY b),
    totals AS (SELECT coalesce((SELECT sum(n) FROM corpus), 0)::DOUBLE AS s, coalesce((SELECT sum(n) FROM target), 0)::DOUBLE AS t),
    gain AS (
        SELECT corpus.b, floor(1000 * ln((coalesce(target.n, 0) + 1)::DOUBLE * (totals.s + {draw.buckets}) / ((corpus.n + 1)::DOUBLE * (totals.t + {draw.buckets}))))::BIGINT AS g
        FROM corpus LEFT JOIN target USING (b), totals
    ), weights AS (SELECT k, count(*) AS n_features, sum(g) AS total FROM doc_features JOIN hashed USING (f) JOIN gain USING (b) GROUP BY k),
    scores AS (
        SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(total // n_features - (CASE WHEN total % n_features < 0 THEN 1 ELSE 0 END), 0)::BIGINT AS weight,
            floor(-1000 * ln(-ln((('0x' || substr(sha256('{draw.seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
        FROM ascii_lower LEFT JOIN weights USING (k)
    ), placed AS (
        SELECT *, weight + noise AS score, n_words >= {draw.least_words} AS eligible,
            row_number() OVER (PARTITION BY n_words >= {draw.least_words} ORDER BY weight + noise DESC, doc_id NULLS LAST, n_features) AS place,
            count(*) FILTER (n_words >= {draw.least_words}) OVER () AS n
        FROM scores
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND place <= {draw.percent} * n // 100 THEN place END AS rank FROM placed
    """
