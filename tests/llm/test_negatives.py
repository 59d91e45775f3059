"""Hard negatives against scoring all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeromart.llm import negatives
from aeromart.llm.negatives import Lists, Mining, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, block string, rank string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, is_anchor, mining):
    usable = {}
    for i, x, label in rows:
        if i is None or x is None or label is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        row = (label, [math.floor(mining.scale * float(np.float32(v))) for v in x])
        usable[i] = min(usable.get(i, row), row)
    out = []
    for a, (label, q) in usable.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(u * v for u, v in zip(q, p, strict=False)), i, other == label) for i, (other, p) in usable.items() if i != a)
        for minus, positive, _ in [s for s in scored if s[2]][: mining.positives]:
            fits = [(i, -s) for s, i, same in scored if not same and mining.low_percent * -minus <= 100 * -s <= mining.high_percent * -minus]
            out += [(a, positive, k, i, -minus, s) for k, (i, s) in enumerate(fits[: mining.negatives], 1)]
    return sorted(out)


def found(spark, rows, every=5, mining=Mining()):
    table = spark.createDataFrame([(i, x, label, "b", "r") for i, x, label in rows], SCHEMA)
    got = hard_negatives(table, F.col("vec_id") % every == 0, mining)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()))


def vectors(rng, n, dims, spread=1.0, labels=3):
    return [(i, [rng.gauss(0.3, spread) for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("dims, spread, mining", [(8, 0.5, Mining()), (3, 1.0, Mining(4, 3, 4, 10, 100)), (1, 0.2, Mining(2, 2, 50, 0, 100))])
def test_rows_are_those_of_all_pairs(spark, monkeypatch, dims, spread, mining):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 40)  # several blocks and chunks
    monkeypatch.setattr(negatives, "CHUNK_ANCHORS", 16)
    rng = random.Random(dims)
    rows = vectors(rng, 300, dims, spread)
    # Ties: the same vector under many ids, and small whole numbers.
    rows += [(1000 + k, rows[0][1], k % 3) for k in range(60)]
    rows += [(2000 + k, [float(rng.randint(-2, 2)) for _ in range(dims)], 1) for k in range(40)]
    wanted = plain(rows, lambda i: i % 5 == 0, mining)
    assert wanted and found(spark, rows, mining=mining) == wanted


def test_rows_that_take_no_part(spark):
    rng = random.Random(1)
    rows = vectors(rng, 60, 4)
    bad = [(None, [1.0] * 4, 0), (100, None, 0), (105, [1.0] * 4, None), (110, [1.0, None, 1.0, 1.0], 0), (115, [float("nan")] + [9.0] * 3, 1), (120, [float("inf")] * 4, 1)]
    assert found(spark, rows + bad) == found(spark, rows) == plain(rows, lambda i: i % 5 == 0, Mining())
    # Of rows that share an id, the one with the smallest label and vector counts.
    twice = rows + [rows[5], (7, [9.0] * 4, 5), (10, [0.5] * 4, 0)]
    assert found(spark, twice) == plain(twice, lambda i: i % 5 == 0, Mining())
    # Short and empty vectors are filled up with zeros; an anchor of zeros has the score 0 with every row.
    short = rows + [(125, [2.0, 2.0], 0), (130, [], 1), (135, [0.0] * 4, 2)]
    assert found(spark, short) == plain(short, lambda i: i % 5 == 0, Mining())


def test_empty_tables_and_lone_labels(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 0)]) == []
    assert found(spark, [(0, [1.0], 0), (1, [1.0], 0)]) == []  # no other label
    assert found(spark, [(0, [1.0], 0), (1, [1.0], 1)]) == []  # no positive
    with pytest.raises(ValueError):
        found(spark, [(0, [3e38], 0), (1, [3e38], 0)])


def test_large_numbers_stay_exact(spark):
    rows = [(0, [3000.0, 1.0], 0), (1, [400000.0, 3.0], 0), (2, [200000.0, 7.0], 1), (3, [200000.0, 8.0], 1)]
    rows += [(4, [150000.0, 0.0], 1), (5, [4e5, 4e5], 2), (6, [4e5, 4e5 - 1], 2), (7, [1e5, 2e5 + 1], 0)]
    assert found(spark, rows) == plain(rows, lambda i: i % 5 == 0, Mining())


def test_reading_stops_once_no_unmet_row_can_enter():
    """One component decides: the lists are read from the favoured end only, and few rows are scored."""
    rng = np.random.default_rng(2)
    values = np.column_stack([np.arange(5000, dtype=float), rng.integers(-1, 2, (5000, 3))])
    lists = Lists(np.arange(5000), values)
    for sign in (1, -1):
        anchor = np.array([100.0 * sign, 1, -1, 0])
        (best,) = lists.search(anchor, np.ones(5000, bool), [(-(2**62), 2**62)], 5)
        wanted = np.lexsort((lists.ids, -(values @ anchor)))[:5]
        assert lists.ids[best].tolist() == wanted.tolist()
        assert 0 < np.count_nonzero(lists.scores) < 2500
