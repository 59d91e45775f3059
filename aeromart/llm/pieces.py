"""SentencePiece encoding and decoding with a table of distinct chunks.

A chunk is a run of word markers with the other characters that follow it. Where no piece of the
vocabulary holds a marker after another character, no merge can cross the border of two chunks, so
a text's ids are its chunks' ids in order. Each task keeps a table chunk -> ids: a chunk is
segmented the first time it is met and looked up afterwards, and the ids are joined back by
position. The table is emptied when it holds `table_size` chunks and when the task ends, which bounds memory and changes
no result. Nothing is shuffled. A vocabulary for which the rule does not hold is used on whole
texts.
"""

import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from aeromart.llm.words import SMALL_BLOCK, blocks

MARK = "▁"
TABLE_SIZE = 200_000
_CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class _Table(dict):
    """chunk -> bytes of its ids as little-endian 32-bit integers."""

    def __init__(self, processor, opens: np.ndarray):
        super().__init__()
        self.processor, self.opens = processor, opens

    def fill(self, chunks: list[str]) -> None:
        """Segments the chunks, some thousands in one call: behind a single marker, the pieces that
        open with a marker show where the ids of each chunk begin."""
        single = [c for c in chunks if len(c) > 1 and c[1] != MARK]
        for low in range(0, len(single), 4096):
            part = single[low : low + 4096]
            ids = np.array(self.processor.encode("".join(part)[1:]), "<u4")
            cuts = [*(np.flatnonzero(self.opens[ids]) * 4).tolist(), len(ids) * 4]
            data = ids.tobytes()
            self.update(zip(part, (data[i:j] for i, j in itertools.pairwise(cuts)), strict=True))
        for chunk in chunks:
            if len(chunk) < 2 or chunk[1] == MARK:
                # The library puts a marker before a text; the chunk's own first marker is left to it.
                ids = self.processor.encode(chunk[1:]) if chunk != MARK else [self.processor.piece_to_id(MARK)]
                self[chunk] = np.array(ids, "<u4").tobytes()


class Encoder:
    """Encodes like the library with begin and end ids, and decodes with the library."""

    def __init__(self, model_path: str, table_size: int = TABLE_SIZE):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        count = self.processor.vocab_size()
        pieces = [self.processor.id_to_piece(i) for i in range(count)]
        self.table, self.table_size = _Table(self.processor, np.array([p.startswith(MARK) for p in pieces])), table_size
        probe = self.processor.encode("a", out_type=str)
        self.by_chunk = probe[:1] == [f"{MARK}a"] and self._plain() and not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        self.begin = np.array([self.processor.bos_id()], "<u4").tobytes()
        self.end = np.array([self.processor.eos_id()], "<u4").tobytes()

    def _plain(self) -> bool:
        """True if the library changes no character and keeps every space."""
        samples = ["ﬁ  Ⅷ é ", " a\tb\n c", f"x{MARK} y", "Ａ b"]
        return all(self.processor.decode(self.processor.encode(s)) == s.replace(MARK, " ") for s in samples)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """All ids of each text, begin and end included, as little-endian 32-bit integers."""
        if not self.by_chunk:
            return [self.begin + np.array(self.processor.encode(t or ""), "<u4").tobytes() + self.end for t in texts]
        chunks = [_CHUNKS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        table, met = self.table, set().union(*chunks)
        new = [*itertools.filterfalse(table.__contains__, met)]
        if len(table) + len(new) > self.table_size:
            table.clear()
            new = [*met]
        table.fill(new)
        return [self.begin + b"".join(map(table.__getitem__, c)) + self.end for c in chunks]

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.processor.decode([np.frombuffer(x, "<u4").tolist() for x in ids])


@lru_cache(maxsize=2)
def encoder(model_path: str, table_size: int = TABLE_SIZE) -> Encoder:
    return Encoder(model_path, table_size)


@contextmanager
def coding(model_path: str, table_size: int = TABLE_SIZE) -> Iterator[Encoder]:
    """The encoder for one task. The worker outlives the task, and must not hold its table meanwhile."""
    coder = encoder(model_path, table_size)
    try:
        yield coder
    finally:
        coder.table.clear()


def encode_texts(docs: DataFrame, model_path: str, column: str = "text", out: str = "ids", table_size: int = TABLE_SIZE) -> DataFrame:
    """The rows of `docs` with the token ids of `column` in `out`, an array of ints.

    A null or empty text has the begin and end ids only. Other columns pass unchanged; a column
    that is already named `out` is replaced.
    """
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with coding(model_path, table_size) as coder:
            for block in blocks(batches, column, SMALL_BLOCK):
                ids = coder.encode(block[column].to_pylist())
                offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                lists = pa.ListArray.from_arrays(pa.array(offsets), values)
                yield pa.RecordBatch.from_arrays([*block.columns, lists], names=[*block.schema.names, out])

    return docs.mapInArrow(run, schema)


def decode_ids(docs: DataFrame, model_path: str, column: str = "ids", out: str = "text") -> DataFrame:
    """The rows of `docs` with the decoded text of the array `column` in `out`; null ids give ''."""
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.StringType(), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = encoder(model_path).processor
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                texts = [processor.decode(x) if x else "" for x in part[column].to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out])

    return docs.mapInArrow(run, schema)


def tokenised(docs: DataFrame, model_path: str, column: str = "text", table_size: int = TABLE_SIZE) -> DataFrame:
    """The rows of `docs` with ids, n_tokens and round_trip (do the ids decode to the text?).

    Columns of `docs` with these names are replaced. A null text counts as empty.
    """
    added = [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())]
    docs = docs.drop(*(f.name for f in added))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with coding(model_path, table_size) as coder:
            for block in blocks(batches, column, SMALL_BLOCK):
                texts = block[column].to_pylist()
                ids = coder.encode(texts)
                offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                same = [a == (b or "") for a, b in zip(coder.decode(ids), texts, strict=True)]
                columns = [*block.columns, lists, pa.array(np.diff(offsets).astype(np.int64)), pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, names=[*block.schema.names, *(f.name for f in added)])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def token_digests(docs: DataFrame, model_path: str, table_size: int = TABLE_SIZE) -> DataFrame:
    """Per row of (doc_id, text): number of ids, SHA-256 of the ids and of the decoded text.

    Encoding and decoding happen in one pass, so that ids and decoded texts are never written.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with coding(model_path, table_size) as coder:
            for block in blocks(batches, "text", SMALL_BLOCK):
                ids = coder.encode(block["text"].to_pylist())
                decoded = coder.decode(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        block["doc_id"],
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, DIGESTS)
