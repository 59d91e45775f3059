"""Hard negatives for anchors, by the threshold algorithm over sorted lists of components.

Vectors become whole numbers, so every score is an exact inner product. Rows are dealt by a hash of
their id into blocks, the anchors (a stated share of the rows) into chunks; every chunk meets every
block in a task of its own. In a block the rows are listed by each component. For an anchor the lists are
read from the end that its component's sign favours, a stretch of all lists at a time; rows met
for the first time are scored. The threshold is the score of a row that has in every list the last value
read: no row that was not met can exceed it. Reading stops once it lies strictly below the k-th
score of each window (or the window's lower end, where fewer than k are known), so ties are never cut.

This is done twice: for the best rows of the anchor's label, whose scores set the windows, and for the best
rows of other labels within each window. Of a block only the first k rows of a window travel; a
window over the blocks' rows takes the first k of these.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeromart.llm.staging import staged

#: Most rows of a block and anchors of a chunk, on average; and the rows of a block while there are fewer blocks than shuffle partitions.
BLOCK_ROWS = 16_384
CHUNK_ANCHORS = 2_048
SMALL_BLOCK_ROWS = 1_024


@dataclass(frozen=True)
class Mining:
    """Scale of the components; positives of an anchor; negatives of a pair; their scores, in per cent of the positive's."""

    scale: int = 256
    positives: int = 5
    negatives: int = 10
    low_percent: int = 30
    high_percent: int = 90


def whole_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and the vector times `scale`, rounded down, of every usable row; one row for each id.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Of rows that share an id the one
    with the smallest label and vector counts; they are reduced before they are shuffled.
    """
    x = F.col("embedding")
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    q = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("long"))
    kept = rows.where(F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("long"), F.struct(F.col("label").cast("long").alias("label"), q.alias("q")).alias("row"))
    return kept.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.q")


class Lists:
    """The rows of a block, listed by each component."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        self.lists = np.ascontiguousarray(np.argsort(values, axis=0, kind="stable").T.astype(np.int32))

    def search(self, anchor: np.ndarray, eligible: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[np.ndarray]:
        """For each window of scores (low, high), the places of its first k eligible rows: by falling score, then by id. Also sets `scores`."""
        n = len(self.ids)
        rising, falling = np.flatnonzero(anchor < 0), np.flatnonzero(anchor > 0)
        seen, known = np.zeros(n, bool), np.zeros(n, bool)
        self.scores = scores = np.zeros(n, self.values.dtype)
        depth, bounds = 0, [low for low, _ in windows]
        open_ = [w for w, (low, high) in enumerate(windows) if low <= high]
        while open_ and depth < n:
            before, depth = depth, min(n, max(2 * depth, k, n // 64)) if len(rising) + len(falling) else n
            if depth == n:
                seen[:] = True
            else:
                seen[self.lists[rising, before:depth]] = True
                seen[self.lists[falling, n - depth : n - before]] = True
            met = np.flatnonzero(seen & ~known)
            scores[met] = self.values[met] @ anchor
            known[met] = True
            if depth == n:
                threshold = None
            else:
                threshold = anchor[rising] @ self.values[self.lists[rising, depth - 1], rising] + anchor[falling] @ self.values[self.lists[falling, n - depth], falling]
            ordered = np.sort(scores[known & eligible])
            for w in open_:
                low, high = windows[w]
                a, b = np.searchsorted(ordered, low, "left"), np.searchsorted(ordered, high, "right")
                bounds[w] = ordered[b - k] if b - a >= k else low
            open_ = [w for w in open_ if threshold is not None and not threshold < bounds[w]]
        found, usable = [], known & eligible
        for (_, high), bound in zip(windows, bounds, strict=True):
            at = np.flatnonzero(usable & (scores >= bound) & (scores <= high))
            found.append(at[np.lexsort((self.ids[at], -scores[at]))[:k]])
        return found


def _matrix(lists: pa.ChunkedArray, dims: int, kind: type) -> np.ndarray:
    """The vectors as rows of a matrix; short ones are filled up with zeros."""
    out = np.zeros((len(lists), dims), kind)
    joined = lists.combine_chunks()
    lengths = np.diff(joined.offsets.to_numpy())
    out[np.arange(dims)[None, :] < lengths[:, None]] = joined.flatten().to_numpy(zero_copy_only=False)
    return out


def _table(columns: dict[str, list[np.ndarray]]) -> pa.Table:
    return pa.table({name: pa.array(np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)) for name, parts in columns.items()})


class _Dealt:
    """Rows in blocks and anchors in chunks, and the kind of number in which all scores are exact."""

    def __init__(self, rows: DataFrame, anchor: Column):
        anchor = F.coalesce(anchor, F.lit(False))
        largest = F.max(F.greatest(F.coalesce(F.array_max("q"), F.lit(0)), -F.coalesce(F.array_min("q"), F.lit(0))))
        n, anchors, dims, top = rows.agg(F.count("*"), F.count_if(anchor), F.max(F.size("q")), largest).first()
        self.dims = max(dims or 0, 1)
        reach = self.dims * (top or 0) ** 2 * 100
        if reach >= 2**63:
            raise ValueError("the scores of these vectors do not fit 64 bits")
        self.kind = np.float64 if reach < 2**53 else np.int64
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.blocks = max(-(-n // BLOCK_ROWS), min(parts, -(-n // SMALL_BLOCK_ROWS)), 1)
        self.chunks = max(-(-anchors // CHUNK_ANCHORS), 1)
        self.rows = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(self.blocks)).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(self.chunks - 1))))
        self.anchors = staged(rows.where(anchor), "anchors")

    def met(self, anchors: DataFrame, search, schema: str) -> DataFrame:
        """The rows that `search` returns for every block and chunk."""
        dealt = anchors.withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(self.chunks)).cast("int"))
        dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))))
        return self.rows.groupBy("block", "chunk").cogroup(dealt.groupBy("block", "chunk")).applyInArrow(search, schema)


def _first(rows: DataFrame, keys: list[str], score: str, tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), tie)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives(dealt: _Dealt, mining: Mining) -> DataFrame:
    """anchor_id, positive_id, positive_score, rank: the best other rows of each anchor's label."""
    dims, kind, k = dealt.dims, dealt.kind, mining.positives

    def search(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor_id": [], "positive_id": [], "positive_score": []}
        ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        values, wanted = _matrix(rows["q"], dims, kind), _matrix(anchors["q"], dims, kind)
        own = anchors["label"].to_numpy()
        for label in np.unique(own):
            at = np.flatnonzero(labels == label)
            if not len(at):
                continue
            lists = Lists(ids[at], values[at])
            for i in np.flatnonzero(own == label):
                anchor_id = anchors["vec_id"][int(i)].as_py()
                (best,) = lists.search(wanted[i], lists.ids != anchor_id, [(-(2**62), 2**62)], k)
                out["anchor_id"].append(np.full(len(best), anchor_id))
                out["positive_id"].append(lists.ids[best])
                out["positive_score"].append(lists.scores[best])
        return _table(out)

    found = dealt.met(dealt.anchors, search, "anchor_id long, positive_id long, positive_score long")
    return _first(found, ["anchor_id"], "positive_score", "positive_id", k)


def negatives(dealt: _Dealt, pairs: DataFrame, mining: Mining) -> DataFrame:
    """anchor_id, positive_id, positive_score, negative_id, negative_score, rank: the best rows of other labels within each pair's window."""
    dims, kind, k = dealt.dims, dealt.kind, mining.negatives
    low, high = mining.low_percent, mining.high_percent
    held = pairs.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("pairs"))
    anchors = dealt.anchors.join(held, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "q", F.col("pairs.positive_id").alias("positive_ids"), F.col("pairs.positive_score").alias("positive_scores"))

    def search(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor_id": [], "positive_id": [], "positive_score": [], "negative_id": [], "negative_score": []}
        labels = rows["label"].to_numpy()
        if rows.num_rows and anchors.num_rows:
            lists = Lists(rows["vec_id"].to_numpy(), _matrix(rows["q"], dims, kind))
            for anchor, vector in zip(anchors.drop_columns(["q"]).to_pylist(), _matrix(anchors["q"], dims, kind), strict=True):
                # Whole scores s with low * p <= 100 * s <= high * p.
                windows = [(-(-low * p // 100), high * p // 100) for p in anchor["positive_scores"]]
                found = lists.search(vector, labels != anchor["label"], windows, k)
                for positive, score, best in zip(anchor["positive_ids"], anchor["positive_scores"], found, strict=True):
                    for name, value in (("anchor_id", anchor["vec_id"]), ("positive_id", positive), ("positive_score", score)):
                        out[name].append(np.full(len(best), value))
                    out["negative_id"].append(lists.ids[best])
                    out["negative_score"].append(lists.scores[best])
        return _table(out)

    found = dealt.met(anchors, search, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    return _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", k)


def hard_negatives(rows: DataFrame, anchor: Column, mining: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    `rows` has vec_id, embedding and label; `anchor` tells by vec_id which rows are anchors. For rows that take no part and rows that share an
    id, see `whole_vectors`. A vector that is shorter than others counts as filled up with zeros. Ties go to
    the smaller id. Anchors without a positive, and pairs without a negative, give no row; an empty table gives an empty result.
    A positive score below zero has an empty window. Other columns are not read. Scores that could exceed 64 bits raise a ValueError.
    """
    dealt = _Dealt(staged(whole_vectors(rows, mining.scale), "vectors"), anchor)
    pairs = staged(positives(dealt, mining), "positives")
    found = negatives(dealt, pairs, mining)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def negatives_sql(every: int = 100, mining: Mining = Mining()) -> str:
    """DuckDB SQL for the same rows, by scoring all pairs; ids must be unique and vectors of one length."""
    return f"""
    WITH usable AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor({mining.scale} * x::DOUBLE)::BIGINT) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scores AS (
        SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
            list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * r.q[i]))::BIGINT AS score
        FROM usable a JOIN usable r ON a.vec_id % {every} = 0 AND a.vec_id <> r.vec_id
    ), positive AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {mining.positives}
    )
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
        id AS negative_id, positive_score, score AS negative_score
    FROM positive JOIN scores USING (anchor_id)
    WHERE NOT same AND {mining.low_percent} * positive_score <= 100 * score AND 100 * score <= {mining.high_percent} * positive_score
    QUALIFY rank <= {mining.negatives}
    """
