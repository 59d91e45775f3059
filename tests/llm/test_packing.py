"""Packing against the tokenizer itself, against the best packings of small sets, and as a whole."""

import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from aeromart.llm import packing
from aeromart.llm.packing import Island, Packing, best_fit, given_back, pack
from aeromart.llm.queries import WORD_TOKENIZER, tokenizer_path

PATH = tokenizer_path(WORD_TOKENIZER)
ODD = [
    "a", "B", "'s", "'S", "'", " ", "\n", "é", "É", "ß", "ÿ", "Ÿ", "×", "1", "٣", "<|endoftext|>", "<|", "|>", "-", "!", "'ll", "#",
    "́", " ", "\x85", "\x1c", "\x00", "Σ", "İ", "日", "🙂", " ", "​", "ﬁ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_library(library):
    rng = random.Random(2)
    words = packing._words(PATH)
    assert words.by_part
    for _ in range(4000):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(words.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_small_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(packing, "TABLE_SIZE", 3)
    words = packing._Words(PATH)
    text = "one two three four, five six… one two " + "x" * 200
    assert np.frombuffer(words.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(words) <= 3 and len(words.parts) <= 3


def fewest(lengths, room):
    """The least number of bins, by trying all ways to put one piece after another."""

    def place(k, fills):
        if k == len(lengths):
            return len(fills)
        best = len(lengths)
        for b in range(len(fills)):
            if fills[b] + lengths[k] <= room:
                best = min(best, place(k + 1, (*fills[:b], fills[b] + lengths[k], *fills[b + 1 :])))
        return min(best, place(k + 1, (*fills, lengths[k])))

    return place(0, ())


def test_islands_reach_the_fewest_bins():
    rng = random.Random(4)
    for case in range(25):
        lengths = [rng.randint(1, 10) for _ in range(rng.randint(1, 8))]
        island = Island(lengths, Packing(room=10, generations=20), str(case), [])
        island.evolve()
        _, bins, fills = island.members[0]
        assert sorted(itertools.chain(*bins)) == list(range(len(lengths)))
        assert fills == [sum(lengths[i] for i in b) for b in bins] and max(fills) <= 10
        assert len(bins) == fewest(lengths, 10)


def test_crossover_and_migration_improve_on_best_fit():
    """Triples that fill a bin exactly: longest first alone does not find them."""
    rng = random.Random(9)
    lengths = []
    for _ in range(40):
        a, b = rng.randint(26, 40), rng.randint(26, 33)
        lengths += [a, b, 100 - a - b]
    plain, fills = [], []
    best_fit(plain, fills, sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 100)
    settings = Packing(room=100, generations=60, members=8, offspring=4)
    first = Island(lengths, settings, "a", [])
    first.evolve()
    elites = [packing._numbers_of(m[1], len(lengths)).tolist() for m in first.members]
    second = Island(lengths, settings, "b", elites)
    second.evolve()
    assert 40 <= len(second.members[0][1]) <= len(first.members[0][1]) < len(plain)


def test_bins_given_back():
    assert given_back([4, 1, 9, 10], [2, 1, 3, 2], 10) == [1]
    assert given_back([10] * 32, [1] * 32, 10) == []
    assert given_back([3], [4], 10) == []  # more than half of the pieces
    assert given_back([*range(64)], [1] * 64, 64) == [0, 1, 2, 3]


@pytest.mark.parametrize("shard", [4096, 16])
def test_every_piece_has_its_place(frame, library, shard):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["red", "Blue,", "x1", "naïve"]) for _ in range(rng.choice([0, 3, 20, 60, 200]))) for _ in range(150)]
    rows = [*enumerate(texts), (3, texts[3]), (None, "red red"), (200, None), (201, "red " * 64 * 3)]
    settings = Packing(room=64, shard_pieces=shard)
    got = [r.asDict() for r in pack(frame(rows), PATH, settings).collect()]
    wanted = []
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for k, low in enumerate(range(0, len(ids), 64)):
            part = ids[low : low + 64]
            wanted.append((i, k, low, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(map(str, wanted)) == sorted(str((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in got)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    # As few as by best fit, longest first, over all pieces; a few more if shards are tiny.
    lengths, plain = sorted((r["length"] for r in got), reverse=True), []
    best_fit(plain, [], range(len(lengths)), lengths, 64)
    assert len(by_sequence) <= len(plain) + (0 if shard == 4096 else 3)


def test_tables_without_rows_or_text(frame):
    assert pack(frame([]), PATH).count() == 0
    (row,) = pack(frame([(5, None)]), PATH).collect()
    assert (row["doc_id"], row["piece"], row["start"], row["length"], row["offset"]) == (5, 0, 0, 1, 0)
    clashing = frame([(1, "a b")]).withColumnsRenamed({"lang": "row", "source": "sequence_id", "runs": "length"})
    assert pack(clashing, PATH).count() == 1
    long = pack(frame([(1, "word " * 300_000)]), PATH).collect()
    assert sum(r["length"] for r in long) == 300_001 and len(long) == len({r["sequence_id"] for r in long}) == 74
