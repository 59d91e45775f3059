"""Weights, draw and ranks against a plain computation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from aeromart.llm import resampling
from aeromart.llm.resampling import Draw, first_rows, resample

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def buckets(text, n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [zlib.crc32(f.encode()) % n for f in [*words, *map(" ".join, zip(words, words[1:], strict=False))]]


def plain(rows, target, draw):
    n = draw.buckets
    corpus, wanted = Counter(), Counter()
    for _, text in rows:
        corpus.update(buckets(text, n)[1])
    for text in target:
        wanted.update(buckets(text, n)[1])
    s_all, t_all = sum(corpus.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + n) / ((corpus[b] + 1) * (t_all + n)))) for b in corpus}
    out = []
    for i, text in rows:
        words, own = buckets(text, n)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{draw.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words) >= draw.least_words])
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    ranks = {id(r): k for k, r in enumerate(order[: draw.percent * len(order) // 100], 1)}
    return sorted(map(str, ((*r[:4], ranks.get(id(r))) for r in out)))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    vocabulary = ["Été", "naïve", "x1", "THE", "of", "日本", "a" * 60, "don't", *(f"w{i}" for i in range(30))]
    return [rng.choice([" ", "-", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 5, 25, 70]))) for _ in range(200)]


@pytest.mark.parametrize("draw", [Draw(), Draw(97, 3, 60, 1), Draw(10_000, 0, 100)])
def test_rows_are_those_of_a_plain_computation(spark, frame, texts, draw):
    rows = [*enumerate(texts), (4, texts[4]), (4, texts[9]), (None, texts[5]), (None, texts[5]), (500, None), (501, "... --")]
    target = [*texts[:7], None, "the w1 w2"]
    benchmark = spark.createDataFrame(list(enumerate(target)), "item_id long, text string")
    got = resample(frame(rows), benchmark, draw)
    assert got.columns == COLUMNS and [t for _, t in got.dtypes] == ["bigint"] * 5
    assert sorted(map(str, map(tuple, got.collect()))) == plain(rows, target, draw)


def test_checksums_of_words_of_any_length():
    rng = random.Random(3)
    words = ["".join(rng.choice("abé日9") for _ in range(k)) for k in [*range(1, 60), 47, 48, 49, 300]]
    import pyarrow as pa

    from aeromart.llm.words import Texts

    own, pairs, first, _ = resampling.features(Texts(pa.array([" ".join(words)])), 2**31)
    assert own.tolist() == [zlib.crc32(w.encode()) % 2**31 for w in words]
    assert pairs.tolist() == [zlib.crc32(f"{a} {b}".encode()) % 2**31 for a, b in zip(words, words[1:], strict=False)]


def test_the_cutoff_is_exact_with_ties_in_every_key(spark):
    rng = random.Random(5)
    rows = [(rng.randint(-3, 3), rng.randint(0, 2), k) for k in range(300)]
    table = spark.createDataFrame(rows, "a long, b long, k long").cache()
    keys = [F.col("a"), -F.col("b"), F.col("k")]
    order = sorted(rows, key=lambda r: (r[0], -r[1], r[2]))
    for wanted in (0, 1, 37, 150, 299, 300):
        found = table.where(first_rows(table, keys, wanted)).collect()
        assert sorted(map(tuple, found)) == sorted(order[:wanted])
    table.unpersist()


def test_empty_tables_and_clashing_columns(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resample(frame([]), none).count() == 0
    rows = [(i, "one two three " * 10) for i in range(8)]
    assert sorted(map(str, map(tuple, resample(frame(rows), none).collect()))) == plain(rows, [], Draw())
    clashing = frame(rows).withColumnsRenamed({"lang": "score", "source": "row", "runs": "rank"})
    assert sorted(map(str, map(tuple, resample(clashing, none).collect()))) == plain(rows, [], Draw())
    long = [(1, "one two " * 400_000), (2, "x" * 500_000)]
    assert sorted(map(str, map(tuple, resample(frame(long), none).collect()))) == plain(long, [], Draw())
