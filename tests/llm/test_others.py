"""Licences against SQL, the language model against its definition, pages against known text, the pipeline stage by stage."""

import itertools
import math
import random
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aeromart.llm import licences, maxent, pages
from aeromart.llm.labelled import remainder
from aeromart.llm.staging import staged

SF = "/root/testdata/sf0.001"


def test_licences_as_in_sql(frame):
    rows = [
        (1, "Intro\nLicensed under the Apache License, Version 2.0.\nmore text here"), (2, "released under the mit license"),
        (3, licences.TEMPLATES["MIT grant"].replace(",", ",\n")), (4, ""), (5, None), (6, "the license"), (None, "Licensed under CC BY-NC 4.0."),
        (7, "This work is licensed under the GNU General Public License, version 2.\n\nReleased under the MIT License."), (7, "one"),
    ]
    found = [tuple(r) for r in licences.licence_units(frame(rows)).collect()]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(map(repr, found)) == sorted(map(repr, connection.execute(licences.licence_sql()).fetchall()))
    assert {(r[0], r[2]) for r in found} >= {(1, "Apache-2.0"), (2, "MIT"), (3, "MIT grant"), (None, "CC-BY-NC-4.0"), (7, "GPL-2.0"), (7, "MIT")}


def test_base_score_and_model(spark, frame):
    rng = random.Random(7)
    words = ["The", "of", "und", "Éa.", "x,", "rare"] + [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words[: rng.choice([6, 66])]) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    rows += [(70, None), (71, " \n"), (72, "unseen " * 5), (None, "The of"), (3, "twice")]
    found = maxent.score_texts(frame(rows), remainder(5) != 1).collect()
    assert len(found) == len(rows)
    tokens = [((t or "").encode().lower().split() + [None], i is not None and zlib.crc32(str(i).encode()) % 5 != 1) for i, t in rows]
    seen = Counter(w for t, learnt in tokens if learnt for w in t)
    total, floor = sum(seen.values()), math.log10(sum(seen.values()) + 0.5 * (len(seen) + 1))
    wanted = Counter((str(i), len(t), sum(seen[w] > 0 for w in t), round(sum(math.log10(seen[w] + 0.5) - floor for w in t), 6)) for (i, _), (t, _) in zip(rows, tokens, strict=True))
    assert Counter((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in found) == wanted
    assert all(r["train_tokens"] == total and r["score"] < 0 for r in found)
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)


def test_model_is_a_distribution():
    import numpy as np

    rng = np.random.default_rng(0)
    weights = rng.normal(size=(maxent.TEMPLATES * maxent.ROWS, maxent.CLASSES)).astype(np.float32)
    features = np.stack([rng.integers(0, maxent.ROWS, 20) + k * maxent.ROWS for k in range(maxent.TEMPLATES)])
    assert np.allclose(maxent._expected(weights, np.zeros(maxent.CLASSES, np.float32), features).sum(1), 1, atol=1e-5)


def test_gradient_and_scores_by_a_plain_loop(spark, frame):
    """Observed less expected counts, and the score of every text, token by token from the formula."""
    import numpy as np

    rng = random.Random(5)
    words = [f"w{i}{e}" for i in range(40) for e in ("", ".", "a")]
    rows = [(i, " ".join(rng.choice(words[: rng.choice([5, 120])]) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    docs, learnt = frame(rows), remainder(5) != 1
    vocabulary = maxent.vocabulary(docs.where(learnt))
    encoded = staged(maxent.encode(docs, learnt, vocabulary), "test-encoded")
    bias = np.log(vocabulary.prior()).astype(np.float32)
    weights = np.random.default_rng(1).normal(0, 0.5, (maxent.TEMPLATES * maxent.ROWS, maxent.CLASSES)).astype(np.float32)

    def histories(row):
        classes, hashes = np.frombuffer(row["classes"], np.uint8).tolist(), np.frombuffer(row["hashes"], np.uint16).tolist()
        for k, own in enumerate(classes):
            c1, c2, c3 = (classes[k - j] if k >= j else 0 for j in (1, 2, 3))
            h1, h2 = (hashes[k - j] if k >= j else 0 for j in (1, 2))
            r = maxent.ROWS
            yield own, [h1 % r, r + c2 * maxent.CLASSES + c1, 2 * r + (h2 * 2654435761 >> 7) % r, 3 * r + c3 * maxent.CLASSES + c1]

    def shares(model, rows_of):
        logits = sum(model[k].astype(float) for k in rows_of) + bias
        e = np.exp(np.clip(logits, -30, 30))
        return e / e.sum()

    wanted, texts = np.zeros(weights.shape), encoded.collect()
    for row in texts:
        for own, places in histories(row) if row["train"] else ():
            rest = -shares(weights, places)
            rest[own] += 1
            for k in places:
                wanted[k] += rest
    observed = maxent.observed_counts(encoded)
    assert np.allclose(maxent.gradient(encoded, weights, bias, observed), wanted, atol=1e-3)

    model = maxent.train(encoded, bias, maxent.UPDATES)
    counts = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in t.encode().lower().split())
    unseen = vocabulary.unseen()
    scores = {r["doc_id"]: r["score"] for r in maxent.score_texts(docs, learnt).collect()}
    for row in texts:
        total = 0.0
        for (own, places), word in zip(histories(row), [*dict(rows)[row["doc_id"]].encode().lower().split(), None], strict=True):
            total += math.log(shares(model, places)[own])
            if word is not None:
                n = counts[word]
                total += math.log((1 - unseen[own]) * n / vocabulary.inside[own] if n else unseen[own])
        assert scores[row["doc_id"]] == pytest.approx(total / math.log(10), rel=1e-4)


def test_gradient_meets_each_history_once(monkeypatch):
    """Copies of a text cost a gradient pass nothing but their count; stretches, steps and texts of one token change no sum."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    lengths = [1, 2, 3, 1, 1, 40, 75, 5]
    texts = [(rng.integers(1, maxent.CLASSES, n).astype(np.uint8), rng.integers(0, 1 << 16, n).astype(np.uint16)) for n in lengths]
    for values in itertools.chain(*texts):
        values[-1] = 0
    column = lambda k: pa.array([t[k].tobytes() for t in texts * 30], pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array(lengths * 30), column(0), column(1)], names=["n_tokens", "classes", "hashes"])
    weights = rng.normal(0, 0.5, (maxent.TEMPLATES * maxent.ROWS, maxent.CLASSES)).astype(np.float32)
    bias = rng.normal(size=maxent.CLASSES).astype(np.float32)
    ((_, _, _, features),) = maxent._tokens([batch])
    wanted = np.zeros(weights.shape)
    for rows in features:
        np.add.at(wanted, rows, maxent._expected(weights, bias, features).astype(float))

    def summed(encoded, parts_of, sums_of):
        sums = np.zeros(weights.shape)
        for part in parts_of([encoded]):
            sums_of(sums, *part)
        return sums

    met, product = [], maxent._product
    monkeypatch.setattr(maxent, "_summed", summed)
    monkeypatch.setattr(maxent, "_product", lambda factors, rows, out: met.append(len(out)) or product(factors, rows, out))
    assert np.allclose(-maxent.gradient(batch, weights, bias, np.zeros(weights.shape)), wanted, atol=1e-3)
    assert sum(met) == len({tuple(x) for x in features.T.tolist()}) <= sum(lengths)
    for name, value in (("HISTORIES", 700), ("SPREAD", 32), ("CHUNK", 10)):
        monkeypatch.setattr(maxent, name, value)
    assert np.allclose(-maxent.gradient(batch, weights, bias, np.zeros(weights.shape)), wanted, atol=1e-3)


def test_words_are_counted_and_encoded_as_defined(spark, frame, monkeypatch):
    """Every kind of white space, empty parts, letters that only Unicode lowers."""
    import numpy as np

    monkeypatch.setattr(maxent, "FREQUENT", 40)
    texts = ["", None, " \n", "\x0b\x0cThe\r\tb\n", "É é À x\x1cy\x85z", "x\x00y X\x00Y x", "İ I ſ \u2003 w", "q" * 3000 + " w. (W) w.. ''"]
    texts += [" ".join(f"w{(k * 7 + j * j) % 90}" for j in range(k)) for k in range(40)]
    docs = frame(list(enumerate(texts)))
    found = [(t or "").encode().lower().split() for t in texts]
    counts = Counter(w for words in found for w in words)
    vocabulary = maxent.vocabulary(docs)
    assert {r["word"].encode(): r["n"] for r in vocabulary.counts.collect()} == counts
    listed = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:40]]
    own = {w: k + 1 if k < maxent.SINGLES else maxent.form(w) for k, w in enumerate(listed)}
    base = dict(zip(listed, vocabulary.base(np.array([counts[w] for w in listed])).tolist(), strict=True))
    rows = {r["doc_id"]: r for r in maxent.encode(docs, F.col("doc_id") % 2 == 0, vocabulary).collect()}
    assert len(rows) == len(texts)
    for i, words in enumerate(found):
        row = rows[i]
        assert list(row["classes"]) == [own.get(w, maxent.form(w)) for w in words] + [0]
        assert np.frombuffer(row["hashes"], np.uint16).tolist() == [zlib.crc32(w) & 0xFFFF for w in words] + [0]
        assert (row["train"], row["n_tokens"], row["n_frequent"]) == (i % 2 == 0, len(words) + 1, sum(w in own for w in words) + 1)
        assert {(r["word"].encode(), r["form"]): r["n"] for r in row["rare"]} == Counter((w, maxent.form(w)) for w in words if w not in own)
        assert row["base"] == pytest.approx(sum(base[w] for w in words if w in own) + vocabulary.base(np.array([len(texts)]))[0])


def test_training_ends_when_judged_texts_gain_no_more(spark, frame, monkeypatch):
    """Not after a fixed number of updates: a language of histories asks for several, one without any is not learnt by heart."""
    import numpy as np

    def trained(texts):
        docs = frame(list(enumerate(texts)))
        vocabulary = maxent.vocabulary(docs)
        encoded = staged(maxent.encode(docs, F.lit(True), vocabulary), "test-training").coalesce(1).cache()
        bias = np.log(vocabulary.prior()).astype(np.float32)
        learnt, judged = maxent.divided(encoded)
        assert learnt.count() + judged.count() == len(texts) and 0 < judged.count() < len(texts) / 4
        losses, loss_of = [], maxent.loss
        with monkeypatch.context() as patched:
            patched.setattr(maxent, "loss", lambda *of: losses.append(loss_of(*of)) or losses[-1])
            model = maxent.train(encoded, bias, None)
        gains = [(a - b) / a for a, b in itertools.pairwise(losses)]
        assert all(g >= maxent.TOLERANCE for g in gains[:-1]) and gains[-1] < maxent.TOLERANCE
        assert maxent.loss(judged, model, bias) == pytest.approx(min(losses))
        return losses, maxent.loss(judged, np.zeros_like(model), bias)

    rng = random.Random(11)
    found = [0, 1]
    for _ in range(6000):
        found.append((found[-2] + 2 * found[-1]) % 8 if rng.random() < 0.8 else rng.randrange(8))
    losses, _ = trained([" ".join(f"w{w}" for w in found[k : k + 60]) for k in range(0, 6000, 60)])
    assert len(losses) > 3 and min(losses) < 0.96 * losses[1]
    losses, without = trained([" ".join(f"w{rng.randrange(24)}" for _ in range(40)) for _ in range(100)])
    assert min(losses) < 1.02 * without


PAGE = """<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav>menu</nav><div class="cookie-notice">We use</div>
<div id="content"><h1>T &amp; x</h1><p>One<br>two <b>bo</b>ld<p>Three<ul><li>a<li>b</ul><form>f</form><div class="comments"><p>c1</div></div>
<aside>s</aside><footer>f</footer><script>var a="<p>no</p>"</script>"""


def test_text_of_a_page():
    assert pages.main_text(pages.lines_of(PAGE), None) == "T & x\n\nOne two bold\n\nThree\n\na\n\nb"
    article = pages.lines_of("<div>other</div><article class='post has-sidebar'><p>in</p><div class='ad'>buy</div><article class='comment'>me too</article></article>")
    assert pages.main_text(article, None) == "in"
    assert pages.main_text(pages.lines_of(""), None) == ""


def test_neighbours_lose_what_they_share(spark):
    body = "<div>top bar</div><div>welcome to the site</div><div>{}</div><div>all rights</div>"
    rows = [
        (1, "http://h.org/en/101", body.format("a text of the first page that is long enough to matter here")),
        (2, "http://h.org/en/102", body.format("another text of the second page, as long as the first one is")),
        (3, "http://lone.org/x", body.format("alone")), (4, None, None), (5, "http://h.org/en/103?q=1", ""), (6, None, "<p>no url</p>"),
    ]
    found = {r["page_id"]: r for r in pages.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[1]["text"] == "a text of the first page that is long enough to matter here"
    assert found[2]["text"].startswith("another") and "top bar" not in found[2]["text"]
    assert found[3]["text"].startswith("top bar") and found[4]["text"] == found[5]["text"] == "" and found[6]["n_chars"] == 6


def test_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(500):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in range(2))
        length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                length[i + 1][j + 1] = length[i][j] + 1 if x == y else max(length[i][j + 1], length[i + 1][j])
        places, rest = sorted(pages.common_lines(a, b)), iter(b)
        assert len(places) == length[-1][-1] and all(a[i] in rest for i in places)


@pytest.fixture
def sf_dir():
    return SF


def test_pipeline_keeps_the_columns_and_only_removes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "test")
        assert docs.columns == columns, name
        assert 0 < docs.count() <= left
        left = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == left and last.where("NOT round_trip OR size(ids) <> n_tokens").count() == 0
