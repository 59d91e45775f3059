"""Token sequences packed to the brim: tokenised pieces of documents, put into bins by a grouping genetic algorithm.

Words are tokenised once per worker and joined as bytes. Only documents longer than a
sequence are cut; full pieces are sequences already, the others are dealt at random into
shards of some thousand, and each shard is packed by several islands. An island holds a few packings.
A crossover takes whole well-filled bins of one packing into another, removes the bins that hold any of their
pieces, and puts what these have lost back by best fit, longest first; a mutation empties the
least filled bins likewise. After some generations the best packing of every island moves on to the next island of its
shard, by a join; after the last round the best one of the shard counts. Islands are rows, so they
run in as many tasks as there are, and a lost one is computed again from the last round's table.

What a shard could not fill, its least filled bins, is given back: the pieces in them are dealt anew, into
far fewer shards, until one shard is left. So the room that is lost does not grow with the number of shards.
"""

import random
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeromart.llm.staging import staged
from aeromart.llm.words import blocks
from aeromart.session import staging

#: Entries of a worker's tables of words and of their parts; longer ones than LONG_WORD characters are not kept.
TABLE_SIZE = 800_000
LONG_WORD = 64


@dataclass(frozen=True)
class Packing:
    """Tokens of a sequence, the id that ends a document, and the sizes of the search."""

    room: int = 4096
    end_id: int = 1
    shard_pieces: int = 4096
    islands: int = 3
    rounds: int = 3
    generations: int = 5
    members: int = 5
    offspring: int = 3


#: Texts of these characters are split as the tokenizer does: white space, printable ASCII and the letters of Latin-1, all in composed form.
_PLAIN = re.compile(r"[\t-\r -~\xc0-\xd6\xd8-\xf6\xf8-\xff]*").fullmatch
#: Fixed value: the tokenizer's parts of such a text in small letters.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z0-9\xdf-\xf6\xf8-\xff]+").findall


class _Parts(dict):
    """Token ids of the parts of words, by the tokenizer's own merges."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        # The characters that stand for the bytes of Latin-1 letters.
        probe = {chr(b): tokenizer.pre_tokenizer.pre_tokenize_str(chr(b))[0][0] for b in [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]}
        self.spelling = str.maketrans(probe)

    def __missing__(self, part: str) -> bytes:
        found = self.model.tokenize(part if part.isascii() else part.translate(self.spelling))
        ids = struct.pack(f"<{len(found)}I", *[t.id for t in found])
        if len(part) <= LONG_WORD:
            if len(self) >= TABLE_SIZE:
                self.clear()
            self[part] = ids
        return ids


class _Words(dict):
    """Token ids of words between white space, as little-endian 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts = _Parts(self.tokenizer)
        samples = ["Don't  x1,2\n", "wORD!!! \xc9t\xe9\xdf", "#1'S we'll'd\t--' a'ma"]
        self.by_part = all(self._by_part(t) == self._encoded(t) for t in samples)

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _by_part(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, _PARTS(text.lower())))

    def __missing__(self, word: str) -> bytes:
        # "<|" may begin a special token.
        ids = self._by_part(word) if self.by_part and _PLAIN(word) and "<|" not in word else self._encoded(word)
        if len(word) <= LONG_WORD:
            if len(self) >= TABLE_SIZE:
                self.clear()
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """The library's ids of the whole text: its white space separates words, and words do not touch each other."""
        if self.by_part and _PLAIN(text) and "<|" not in text:
            return self._by_part(text)
        # str.split also takes these four for white space, the tokenizer does not.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self._encoded(text)
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(path)


def cut_pieces(docs: DataFrame, tokenizer_path: str, packing: Packing) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = _words(tokenizer_path), np.array([packing.end_id], "<u4").tobytes()
        step = 4 * packing.room
        for block in blocks(batches, "text"):
            out: list[tuple] = []
            for doc_id, text in zip(block["doc_id"].to_pylist(), block["text"].to_pylist(), strict=True):
                ids = words.ids(text or "") + end
                for piece, low in enumerate(range(0, len(ids), step)):
                    part = ids[low : low + step]
                    out.append((doc_id, piece, low // 4, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(values, kind) for values, kind in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


#: A packing: lists of pieces, one for each bin.
Bins = list[list[int]]


def best_fit(bins: Bins, fills: list[int], pieces: Iterable[int], lengths: list[int], room: int) -> None:
    """Puts each piece into the bin that it fills best, or into a new one. Bins of equal room are stacks, and the bits of `open_` tell which rooms occur."""
    by_room: dict[int, list[int]] = {}
    open_ = 0
    for b, fill in enumerate(fills):
        by_room.setdefault(room - fill, []).append(b)
        open_ |= 1 << (room - fill)
    for piece in pieces:
        length = lengths[piece]
        fitting = open_ >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            stack = by_room[left]
            b = stack.pop()
            if not stack:
                open_ ^= 1 << left
            bins[b].append(piece)
        else:
            left, b = room, len(bins)
            bins.append([piece])
            fills.append(0)
        fills[b] += length
        left -= length
        stack = by_room.setdefault(left, [])
        if not stack:
            open_ |= 1 << left
        stack.append(b)


def given_back(fills: list[int], sizes: list[int], room: int) -> list[int]:
    """The bins that a shard gives back: the least filled ones that are not full, at most one of 16 and half of the pieces."""
    back, pieces, most = [], 0, sum(sizes) // 2
    for b in sorted(range(len(fills)), key=lambda b: (fills[b], b))[: max(1, len(fills) // 16)]:
        pieces += sizes[b]
        if fills[b] == room or pieces > most:
            break
        back.append(b)
    return back


class Island:
    """A population of packings of the same pieces, best first: (worth, bins, fills) each."""

    def __init__(self, lengths: list[int], packing: Packing, seed: str, members: list[list[int]]):
        self.lengths, self.packing, self.rng = lengths, packing, random.Random(seed)
        self.order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
        self.least = -(-sum(lengths) // packing.room)
        self.members = [self._judged(*_bins_of(m, lengths)) for m in members] or self._first()
        self._keep()

    def _judged(self, bins: Bins, fills: list[int]) -> tuple[tuple[int, int], Bins, list[int]]:
        """Fewer bins are better, then more room in few bins."""
        return (len(bins), -sum([f * f for f in fills])), bins, fills

    def _first(self) -> list:
        found = []
        for k in range(self.packing.members):
            order = self.order
            if k:  # longest first, but for some noise
                noise = [-x * self.rng.uniform(1 - 0.1 * k, 1) for x in self.lengths]
                order = sorted(range(len(noise)), key=noise.__getitem__)
            bins, fills = [], []
            best_fit(bins, fills, order, self.lengths, self.packing.room)
            found.append(self._judged(bins, fills))
        return found

    def _keep(self) -> None:
        """The best members of different worth."""
        worths: dict = {}
        for m in sorted(self.members, key=lambda m: m[0]):
            worths.setdefault(m[0], m)
        self.members = [*worths.values()][: self.packing.members]

    @property
    def done(self) -> bool:
        """Can nothing be gained? The best packing has the least number of bins, and all its room lies in the bins that the shard gives back."""
        _, bins, fills = self.members[0]
        if len(bins) > self.least:
            return False
        room = self.packing.room
        kept = {*range(len(fills))}.difference(given_back(fills, [*map(len, bins)], room))
        return all(fills[b] == room for b in kept) or len(bins) == 1

    def _crossed(self, mother: tuple, father: tuple) -> tuple[Bins, list[int]]:
        """Some of the father's fullest bins whole, the mother's bins that share no piece with them, and all other pieces by best fit."""
        _, bins, fills = father
        ranked = sorted(range(len(bins)), key=lambda b: -fills[b])
        taken = self.rng.sample(ranked[: max(1, len(ranked) // 2)], k=max(1, int(len(ranked) * self.rng.uniform(0.05, 0.3))))
        placed = {i for b in taken for i in bins[b]}
        others = [b for b, held in enumerate(mother[1]) if placed.isdisjoint(held)]
        return self._refilled([bins[b] for b in taken] + [mother[1][b] for b in others], [fills[b] for b in taken] + [mother[2][b] for b in others])

    def _mutated(self, member: tuple) -> tuple[Bins, list[int]]:
        """All bins but the least filled ones and a few others, and the pieces of these by best fit."""
        _, bins, fills = member
        emptied = {*sorted(range(len(bins)), key=fills.__getitem__)[: self.rng.randint(1, 4)], *self.rng.sample(range(len(bins)), k=min(len(bins), self.rng.randint(1, 8)))}
        left = [b for b in range(len(bins)) if b not in emptied]
        return self._refilled([bins[b] for b in left], [fills[b] for b in left])

    def _refilled(self, whole: Bins, fills: list[int]) -> tuple[Bins, list[int]]:
        """The bins as they are, with all other pieces put in by best fit, longest first."""
        bins = [*map(list, whole)]
        held = set().union(*bins)
        displaced = [i for i in self.order if i not in held]
        best_fit(bins, fills, displaced, self.lengths, self.packing.room)
        return bins, fills

    def evolve(self) -> None:
        for _ in range(self.packing.generations):
            if self.done:
                return
            young = []
            for _ in range(self.packing.offspring):
                if len(self.members) > 1:
                    mother, father = self.rng.sample(self.members, k=2)
                    young.append(self._judged(*self._crossed(mother, father)))
                young.append(self._judged(*self._mutated(self.rng.choice(self.members))))
            self.members += young
            self._keep()


def _bins_of(numbers: list[int], lengths: list[int]) -> tuple[Bins, list[int]]:
    bins: Bins = [[] for _ in range(max(numbers) + 1)]
    fills = [0] * len(bins)
    for piece, b in enumerate(numbers):
        bins[b].append(piece)
        fills[b] += lengths[piece]
    return bins, fills


def _numbers_of(bins: Bins, n: int) -> np.ndarray:
    out = np.zeros(n, np.int32)
    for b, pieces in enumerate(bins):
        out[pieces] = b
    return out


ISLANDS = "shard int, island int, rows array<long>, lengths array<int>, members array<array<int>>, bins long, squares long, done boolean"


def _evolved(islands: DataFrame, packing: Packing, seed: str) -> DataFrame:
    """One round: rows of shard, island, rows, lengths and members (the packings so far, none at first)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                island = Island(row["lengths"], packing, f"{seed}-{row['shard']}-{row['island']}", row["members"])
                island.evolve()
                bins, squares = island.members[0][0]
                row |= {"members": [_numbers_of(m[1], len(row["rows"])) for m in island.members], "bins": bins, "squares": -squares, "done": island.done}
                yield pa.RecordBatch.from_pylist([row], schema=arrow)

    arrow = pa.schema(
        [
            ("shard", pa.int32()), ("island", pa.int32()), ("rows", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
            ("members", pa.list_(pa.list_(pa.int32()))), ("bins", pa.int64()), ("squares", pa.int64()), ("done", pa.bool_()),
        ]
    )
    return islands.select("shard", "island", "rows", "lengths", "members").mapInArrow(run, ISLANDS)


def _placed(best: DataFrame, packing: Packing, last: bool) -> DataFrame:
    """row, length, sequence_id, offset and given_back of every piece. A sequence is named by its smallest row.

    Nothing is given back if this is the last level.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = batch.slice(k, 1).to_pylist()[0]
                rows, lengths = found["rows"], found["lengths"]
                bins, fills = _bins_of(found["numbers"], lengths)
                back = set() if last else {*given_back(fills, [*map(len, bins)], packing.room)}
                out = []
                for b, members in enumerate(bins):
                    name, offset = min(rows[i] for i in members), 0
                    for i in sorted(members, key=lambda i: rows[i]):
                        out.append((rows[i], lengths[i], name, offset, b in back))
                        offset += lengths[i]
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["row", "length", "sequence_id", "offset", "given_back"])

    return best.select("rows", "lengths", "numbers").mapInArrow(run, "row long, length int, sequence_id long, offset long, given_back boolean")


def _best_of_shards(pieces: DataFrame, shards: int, packing: Packing, seed: str) -> DataFrame:
    """rows, lengths and the bins' numbers of each shard's best packing, after all rounds."""
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(shards)).cast("int"))
    shard = dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("row", "length"))).alias("p"))
    shard = shard.select("shard", F.col("p.row").alias("rows"), F.col("p.length").alias("lengths"), F.array().cast("array<array<int>>").alias("members"))
    islands = shard.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(packing.islands - 1)))).repartition("shard", "island")
    state = staged(_evolved(islands, packing, f"{seed}-0"), "islands")
    for k in range(1, packing.rounds):
        if not state.where("NOT done").limit(1).count():
            break
        elites = state.select("shard", F.pmod(F.col("island") + 1, F.lit(packing.islands)).alias("island"), F.col("members")[0].alias("elite"))
        met = state.join(elites, ["shard", "island"]).withColumn("members", F.array_append("members", F.col("elite")))
        state = staged(_evolved(met, packing, f"{seed}-{k}"), "islands")
    best = F.min_by(F.struct("rows", "lengths", F.col("members")[0].alias("numbers")), F.struct("bins", -F.col("squares"), "island"))
    return state.groupBy("shard").agg(best.alias("best")).select("best.*")


def pack(docs: DataFrame, tokenizer_path: str, packing: Packing = Packing()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every row of `docs`.

    A null or empty text is the end id alone. Repeated rows and rows without an id are documents like all others; equal
    lengths are packed in the order of the table. An empty table gives an empty result. Other columns are
    not read. A sequence is named by a number that means nothing else.
    """
    cut = staged(cut_pieces(docs, tokenizer_path, packing).withColumn("row", F.monotonically_increasing_id()), "pieces")
    places = []
    with staging(docs.sparkSession):
        pieces, level = cut.where(F.col("length") < packing.room).select("row", F.col("length").cast("int")), 0
        while n := pieces.count():
            shards = -(-n // packing.shard_pieces)
            placed = staged(_placed(_best_of_shards(pieces, shards, packing, str(level)), packing, shards == 1), "placed", keep=True)
            places.append(placed.where("NOT given_back").select("row", "sequence_id", "offset"))
            pieces, level = placed.where("given_back").select("row", "length"), level + 1
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    found = cut.where(F.col("length") >= packing.room).withColumns({"sequence_id": F.col("row"), "offset": F.lit(0).cast("long")}).select(*out)
    if places:
        joined = places[0]
        for more in places[1:]:
            joined = joined.unionByName(more)
        found = found.unionByName(cut.where(F.col("length") < packing.room).join(joined, "row").select(*out))
    return found
