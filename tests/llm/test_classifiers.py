"""Counts against plain Python, trees against their constraints, segments against all intervals, held-out accuracy."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from aeromart.llm import quality, rules, statistics, toxicity, trees
from aeromart.llm.queries import QUERIES
from aeromart.llm.words import Texts, blocks

SF = "/root/testdata/sf0.01"


def counts(text):
    t = text or ""
    w = t.encode().split()
    seen, lines = set(), 0
    for line in t.split("\n"):
        if line.encode().split():
            lines += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), lines, len(repeated)


def test_counts_of_odd_texts():
    rng = random.Random(1)
    texts = ["", None, " \n\t", "a", "a b c a b c", "x\nx\n\n x\nx ", "é#é <b>|", "\x0b\x0c\r", "a  b c"]
    texts += ["".join(rng.choice("ab é\n #|x日") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    base, matrix = statistics.measure(Texts(pa.array(texts, pa.string())))
    assert [tuple(int(base[n][i]) for n in statistics.BASE) for i in range(len(texts))] == [counts(t) for t in texts]
    assert np.isfinite(matrix).all() and matrix.shape == (len(texts), len(statistics.FEATURES))


def test_monotonic_trees():
    rng = np.random.default_rng(2)
    x = rng.random((600, 3))
    y = (x[:, 0] + 0.3 * rng.random(600) > 0.6).astype(float)
    model = trees.fit(x, y, rounds=20, signs=np.array([1, -1, 0]))
    for j, sign in ((0, 1), (1, -1)):
        grid = np.tile(rng.random((50, 1, 3)), (1, 40, 1))
        grid[:, :, j] = np.linspace(0, 1, 40)
        steps = np.diff(model.margins(grid.reshape(-1, 3)).reshape(50, 40), axis=1) * sign
        assert (steps >= -1e-12).all()
    assert ((model.probabilities(x) > 0.5) == y).mean() > 0.85
    assert trees.fit(np.zeros((0, 3)), np.zeros(0)).probabilities(x[:2]).tolist() == [0.5, 0.5]
    assert trees.fit(x, np.ones(600)).probabilities(x[:1])[0] > 0.9


def test_segments_are_the_maximal_ones():
    """The best segment is the best interval, and no segment can be extended or cut to a better one."""
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(1, 14)
        at = sorted(rng.sample(range(n), rng.randint(1, n)))
        scores = [rng.choice([0.3, 0.7, 1.5, 3.0]) for _ in at]
        line = [toxicity.REST] * n
        for i, s in zip(at, scores, strict=True):
            line[i] = s
        found = toxicity.segments(at, scores)
        best = max(sum(line[i : j + 1]) for i in range(n) for j in range(i, n))
        assert max(s for *_, s in found) == pytest.approx(best)
        for first, last, score in found:
            assert score == pytest.approx(sum(line[first : last + 1]))
            assert all(sum(line[first:k]) > 0 for k in range(first + 1, last + 2))
            assert all(sum(line[k : last + 1]) > 0 for k in range(first, last + 1))
        assert all(a[1] < b[0] for a, b in zip(found, found[1:]))  # noqa: B905


def test_margins_are_those_of_a_plain_walk():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 5))
    model = trees.fit(x, (x[:, 0] * x[:, 1] > 0).astype(float), rounds=15, depth=3)
    for row, margin in zip(x, model.margins(x), strict=True):
        total = model.bias
        for feature, threshold, value in zip(model.feature, model.threshold, model.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += value[node - len(feature)]
        assert margin == pytest.approx(total)


def ranking_quality(pairs):
    """The chance that a row of label 1 scores above one of label 0; half for ties."""
    ones, zeros = ([s for s, y in pairs if y == k] for k in (1, 0))
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])


@pytest.mark.parametrize(("name", "label", "auc", "recall"), [("op2_quality_classifier", "quality", 0.99, 0.95), ("op9_toxicity", "toxic", 0.95, 0.9)])
def test_held_out_labels(spark, name, label, auc, recall):
    """On held-out labels: ranking, recall and precision, none of which a constant answer can reach."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = QUERIES[name](spark, sf).select("doc_id", "held_out", "score", "predicted")
    rows = found.join(labels, "doc_id", "left").collect()
    assert len(rows) == 10_000 and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r[label] is not None]
    assert ranking_quality([(r["score"], r[label]) for r in held]) >= auc
    ones = [r for r in held if r[label] == 1]
    assert len(ones) >= 50 and np.mean([r["predicted"] for r in ones]) >= recall
    assert np.mean([r[label] for r in held if r["predicted"]]) >= 0.9


def test_verdicts_are_those_of_the_trees(spark):
    """`kept`, recomputed from the statistics of each text by the fitted trees and the fixed limits."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = rules.fit_rules(docs, labels)
    rows = docs.collect()
    _, matrix = statistics.measure(Texts(pa.array([r["text"] for r in rows], pa.string())))
    good = model.probabilities(matrix) >= rules.KEEP_FROM
    found = {r["doc_id"]: r for r in rules.quality_rules(docs, model).collect()}
    assert all(found[r["doc_id"]]["kept"] == (not found[r["doc_id"]]["base_failed"] and bool(good[k])) for k, r in enumerate(rows))


def test_rules_and_their_base(spark):
    found = {r["doc_id"]: r for r in QUERIES["op10_quality_rules"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(found) == len(docs)
    for d in docs:
        r, (n, *rest) = found[d["doc_id"]], counts(d["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, *rest)
        assert r["base_failed"] == (n < 50 or 100 * rest[-1] > 50 * n)
        assert not (r["base_failed"] and r["kept"])


def test_odd_rows_and_no_labels(frame, spark):
    docs = frame([(1, None), (2, ""), (None, "some words"), (2, "again"), (3, "word " * 60)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score_quality(docs, quality.fit_quality(docs, none)).count() == 5
    assert rules.quality_rules(docs, rules.fit_rules(docs, none)).where("kept").count() == 0
    kept = rules.keep_good(frame([(1, " ".join(f"w{i}" for i in range(60))), (2, "x")]), trees.constant())
    assert [(r["doc_id"], r["runs"]) for r in kept.collect()] == [(1, 7)]
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, none)).collect()
    assert len(scored) == 5 and all(r["predicted"] == 0 for r in scored)
    assert quality.score_quality(frame([]), trees.constant()).count() == 0


def test_a_large_batch_is_judged_in_little_memory():
    text = " ".join(f"word{i % 997} and, more. words" for i in range(20_000))
    texts = pa.array([text] * 10)  # some 4 MB
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    tracemalloc.start()
    for block in blocks([batch], "text", rules.SMALL_BLOCK):
        rules.judge(block["text"], trees.constant())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
