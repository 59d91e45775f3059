"""Removal of repeated passages: exact counting of word windows in super-k-mer buckets.

A window is `size` consecutive words. Its minimiser is the smallest hash among its runs of GRAM
words, so equal windows have equal minimisers, and neighbouring windows mostly share theirs. Each
maximal run of windows with one minimiser travels as one packed string (a 64-bit fingerprint per
window) to the minimiser's bucket. There the fingerprints are sorted; within a bucket equal
fingerprints are equal windows, and all but the first in document order are repeats. (Two different
windows would have to agree in 32 bits of the minimiser and in an independent 64-bit fingerprint.)

Hot keys. A window that occurs again within a block of text is known as a repeat at once and does
not travel, so a passage of a third of all documents is sent once per block. Minimisers are first
counted in BINS bins; windows whose bin holds more than HOT times the mean are sent one by one under their own
fingerprint, which spreads a phrase that occurs everywhere in different surroundings. At most
BINS / HOT bins can be hot, so their list is bounded. Buckets are sorted by Spark and read in
pieces that end where a key ends.
"""

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeromart.llm import words as W

SIZE = 20
GRAM = 4
BINS = 1 << 16
HOT, HOT_LEAST = 8, 1000
#: A reducer sorts at least so many fingerprints at a time, if its partition has them.
PIECE = 1 << 20
#: A missing id becomes one of so many at the upper end, by the text: later than any other, and not one key for all such rows.
NO_IDS = 1 << 40

_OCCURRENCES = "key int, id long, place long, n int, windows binary"


class _Windows:
    """The windows of a block, in order of id, text and start."""

    def __init__(self, block: pa.RecordBatch, size: int):
        texts = W.Texts(block["text"])
        starts, ends, first = W.words(texts)
        hashes = W.span_hashes(texts.raw, starts, ends)
        ids, marks = block["id"].to_numpy(), text_marks(hashes, first)
        order = np.lexsort((marks, ids))
        # A row that repeats an earlier one in id and words is the same text at the same place.
        same = np.zeros(len(order), bool)
        same[1:] = (ids[order][1:] == ids[order][:-1]) & (marks[order][1:] == marks[order][:-1])
        order = order[~same]
        if len(order) != block.num_rows or (order[1:] < order[:-1]).any():
            counts = np.diff(first)[order]
            take = np.repeat(first[:-1][order] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
            hashes, first = hashes[take], np.concatenate(([0], np.cumsum(counts)))
        self.ids, self.places, self.first, self.hashes = ids[order], marks[order].astype(np.int64) << 32, first, hashes
        self.owner = W.owners_of(first)
        self.at = np.flatnonzero(W.windows_inside(first, size, len(hashes)))
        self.prints = W.window_hashes(hashes, size)[self.at]
        gram = min(GRAM, size)
        least = W.mixed(W.window_hashes(hashes, gram) + np.uint64(0x5851F42D4C957F2D))
        wide, span = size - gram + 1, 1
        while span < wide:
            step = min(span, wide - span)
            least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
            span += step
        # Smallest hashes are small: they are mixed again, so that the bins of their leading bits are even.
        self.least = W.mixed(least[self.at]) if len(self.at) else least[:0]

    def repeats(self) -> np.ndarray:
        """Marks the windows that occur earlier in the block."""
        out = np.zeros(len(self.at), bool)
        values, lengths = W.runs(np.sort(self.prints))
        twice = values[lengths > 1]
        if len(twice):
            spot = np.minimum(np.searchsorted(twice, self.prints), len(twice) - 1)
            among = np.flatnonzero(twice[spot] == self.prints)
            order = among[np.argsort(self.prints[among], kind="stable")]
            out[order[1:]] = self.prints[order][1:] == self.prints[order][:-1]
        return out

    def rows(self, chosen: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of consecutive chosen windows of one document, also cut at `breaks`: (head, length, id, place)."""
        at = self.at[chosen]
        owner = self.owner[at]
        heads = np.ones(len(at), bool)
        heads[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1]) | breaks[1:]
        head = np.flatnonzero(heads)
        row = owner[head]
        return head, np.diff(np.append(head, len(at))), self.ids[row], self.places[row] | (at[head] - self.first[row])


def text_marks(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """31 bits of the word sequence of each text, to tell rows with one id apart."""
    if not len(hashes):
        return np.zeros(len(first) - 1, np.uint32)
    place = np.arange(len(hashes), dtype=np.uint64) - np.repeat(first[:-1], np.diff(first)).astype(np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(W.mixed(hashes ^ W.mixed(place + np.uint64(1))))))
    return (W.mixed(sums[first[1:]] - sums[first[:-1]]) >> np.uint64(33)).astype(np.uint32)


def _id(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"], F.lit(2**63 - 1) - F.pmod(F.xxhash64(docs["text"]), F.lit(NO_IDS)))


def _with_id(docs: DataFrame) -> DataFrame:
    return docs.select(_id(docs).alias("id"), "text")


def hot_bins(docs: DataFrame, size: int = SIZE) -> np.ndarray:
    """The bins of minimisers that hold more than HOT times their share of the windows. At most BINS / HOT numbers reach the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for block in W.blocks(batches, "text"):
            total += np.bincount((_Windows(block, size).least >> np.uint64(48)).astype(np.int64), minlength=BINS)
        bins = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(total[bins])], names=["bin", "n"])

    loads = _with_id(docs).mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    rows = loads.toPandas()  # one row per bin: at most BINS
    mean = rows["n"].sum() / BINS
    return rows["bin"][rows["n"] > max(HOT * mean, HOT_LEAST)].to_numpy(dtype=np.int64)


def _occurrences(size: int, hot: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_hot = np.zeros(BINS, bool)
        is_hot[hot] = True
        for block in W.blocks(batches, "text"):
            found = _Windows(block, size)
            repeat = found.repeats()
            new = ~repeat
            prints, least = found.prints[new], found.least[new]
            alone = is_hot[(least >> np.uint64(48)).astype(np.int64)]
            key = np.where(alone, W.mixed(prints), least)
            breaks = np.ones(len(key), bool)
            breaks[1:] = key[1:] != key[:-1]
            head, length, ids, places = found.rows(new, breaks | alone)
            offsets = np.append(head, len(prints)).astype(np.int32) * 8
            packed = pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(prints.tobytes())])
            yield _batch(key[head], ids, places, np.zeros(len(head), np.int64), packed)
            head, length, ids, places = found.rows(repeat, np.zeros(int(repeat.sum()), bool))
            if len(head):
                keys = W.mixed(ids.view(np.uint64) + places.view(np.uint64))
                yield _batch(keys, ids, places, length, pa.array([b""] * len(head), pa.binary()))

    return run


def _batch(key: np.ndarray, ids: np.ndarray, places: np.ndarray, n: np.ndarray, packed: pa.Array) -> pa.RecordBatch:
    bucket = (key >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(ids), pa.array(places), pa.array(n.astype(np.int32)), packed], names=["key", "id", "place", "n", "windows"])


def _resolve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats among the occurrences of a partition sorted by key, as (id, place, n) runs."""
    for piece in _pieces(batches):
        n = piece["n"].to_numpy()
        known = n > 0
        ids, places, keys = (piece[c].to_numpy() for c in ("id", "place", "key"))
        packed = pa.concat_arrays(piece["windows"].chunks).cast(pa.large_binary())
        bounds = np.frombuffer(packed.buffers()[1], np.int64)[: len(packed) + 1]
        prints = np.frombuffer(packed.buffers()[2], np.uint64, (bounds[-1] - bounds[0]) // 8, bounds[0]) if bounds[-1] > bounds[0] else np.zeros(0, np.uint64)
        values, lengths = W.runs(np.sort(prints))
        twice = values[lengths > 1]
        out = [(ids[known], places[known], n[known].astype(np.int64))]
        if len(twice):
            spot = np.minimum(np.searchsorted(twice, prints), len(twice) - 1)
            among = np.flatnonzero(twice[spot] == prints)
            row = np.searchsorted(bounds - bounds[0], among * 8, side="right") - 1
            place = places[row] + (among - (bounds[row] - bounds[0]) // 8)
            order = np.lexsort((place, ids[row], keys[row], prints[among]))
            p, k, i, w = prints[among][order], keys[row][order], ids[row][order], place[order]
            opens = np.ones(len(p), bool)
            opens[1:] = (p[1:] != p[:-1]) | (k[1:] != k[:-1])
            lead = np.flatnonzero(opens)[np.cumsum(opens) - 1]
            late = (i != i[lead]) | (w != w[lead])
            i, w = i[late], w[late]
            order = np.lexsort((w, i))
            i, w = i[order], w[order]
            heads = np.ones(len(i), bool)
            heads[1:] = (i[1:] != i[:-1]) | (w[1:] > w[:-1] + 1)
            head = np.flatnonzero(heads)
            last = np.append(head[1:], len(i)) - 1
            if len(head):
                out.append((i[head], w[head], w[last] - w[head] + 1))
        columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "place", "n"])


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about PIECE fingerprints in which every key is complete."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch["key"].to_numpy()
        if size >= PIECE * 8:
            # What has the key of the last held row belongs to it; after that a new piece begins.
            cut = int(np.searchsorted(keys, held[-1]["key"][-1].as_py(), side="right"))
            if cut < batch.num_rows:
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held, size, batch = [], 0, batch.slice(cut)
        held.append(batch)
        size += batch["windows"].nbytes
    if held:
        yield pa.Table.from_batches(held)


def repeated_windows(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(id, runs): per document the runs of windows whose words occur earlier, as (mark, start, n).

    Earlier means a smaller id or, in the same document, an earlier start. `id` is doc_id, or a number that stands for a
    missing one; `mark` tells apart the texts of rows that share an id.
    """
    hot = hot_bins(docs, size)
    sent = _with_id(docs).mapInArrow(_occurrences(size, hot), _OCCURRENCES)
    found = sent.repartition("key").sortWithinPartitions("key").mapInArrow(_resolve, "id long, place long, n long")
    run = F.struct(
        F.shiftright("place", 32).cast("int").alias("mark"), F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("start"), F.col("n").cast("int").alias("n")
    )
    return found.groupBy("id").agg(F.collect_list(run).alias("runs"))


def _reduced(block: pa.RecordBatch, size: int) -> Iterator[tuple[int, int, bytes]]:
    """(n_words, n_removed, kept words joined by one space) of each text."""
    runs = block["runs"]
    texts = block["text"].to_pylist()
    marked = [i for i in range(block.num_rows) if runs[i].is_valid]
    marks = {}
    if marked:
        own = W.Texts(block["text"].take(pa.array(marked)))
        starts, ends, first = W.words(own)
        marks = dict(zip(marked, text_marks(W.span_hashes(own.raw, starts, ends), first).tolist(), strict=True))
    for i, text in enumerate(texts):
        found = (text or "").encode().split()
        if i not in marks:
            yield len(found), 0, b" ".join(found)
            continue
        edge = np.zeros(len(found) + 1, np.int64)
        for r in runs[i].as_py():
            if r["mark"] == marks[i]:
                edge[r["start"]] += 1
                edge[min(len(found), r["start"] + r["n"] + size - 1)] -= 1
        stay = np.cumsum(edge[:-1]) == 0
        yield len(found), int(len(found) - stay.sum()), b" ".join(compress(found, stay.tolist()))


def _joined(docs: DataFrame, size: int) -> DataFrame:
    """docs with the column `runs`. The runs are the small side, so the texts are shuffled but not sorted."""
    runs = repeated_windows(docs, size).withColumnRenamed("id", "_id").hint("shuffle_hash")
    return docs.join(runs, _id(docs) == F.col("_id"), "left").drop("_id")


def repeat_digests(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words of every row.

    A word is removed if a window that holds it occurs earlier. A null or empty text, or one with fewer words
    than a window, loses nothing. Rows with the same id and words count as one text, and neither is
    earlier than the other; rows with the same id and other words come in a fixed order. A null id is
    later than any other, and rows without one come in the order of a hash of their texts. Other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "text"):
            rows = [(n, gone, hashlib.sha256(kept).hexdigest()) for n, gone, kept in _reduced(block, size)]
            n, gone, digests = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([block["doc_id"], pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _joined(docs.select("doc_id", "text"), size).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of `docs`; texts that repeat a passage keep the other words, joined by one space.

    Texts without a repeat stay as they are. `n_chars`, where present, follows the text. Other
    columns pass unchanged; a column named runs or _id is passed too.
    """
    fields = docs.schema.fields
    inner = docs.select(F.col("doc_id"), F.col("text"), F.struct(*(F.col(f"`{f.name}`") for f in fields)).alias("row"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "text"):
            rows = list(_reduced(block, size))
            old = block["text"].to_pylist()
            new = [kept.decode() if gone else text for text, (_, gone, kept) in zip(old, rows, strict=True)]
            columns = {f.name: c for f, c in zip(block["row"].type, block["row"].flatten(), strict=True)}
            columns["text"] = pa.array(new, pa.string())
            if "n_chars" in columns:
                lengths = [None if t is None else len(t) for t in new]
                columns["n_chars"] = pa.array([a if not gone else b for a, b, (_, gone, _) in zip(columns["n_chars"].to_pylist(), lengths, rows, strict=True)], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return _joined(inner, size).mapInArrow(run, T.StructType(fields))


def repeats_sql(size: int = SIZE) -> str:
    """DuckDB SQL for the rows of `repeat_digests`, for ids that are present and distinct."""
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + {size - 1}], ' ')) AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {size - 2})) AS i FROM w)),
late AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {size})) AS i FROM late),
lists AS (SELECT doc_id, list(i) AS dropped FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(dropped), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN dropped IS NULL THEN words
         ELSE list_transform(list_filter(range(1, len(words) + 1), lambda j: NOT list_contains(dropped, j)), lambda j: words[j]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN lists USING (doc_id)
"""
