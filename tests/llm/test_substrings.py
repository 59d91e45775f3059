"""Removed words against a dictionary of all windows."""

import hashlib
import random

import pytest

from aeromart.llm import substrings


def brute(rows, size):
    seen, out = {}, {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - size + 1):
            window = tuple(w[k : k + size])
            if window in seen:
                gone |= set(range(k, k + size))
            else:
                seen[window] = (i, k)
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("size", [20, 6, 3])
@pytest.mark.parametrize("hot", [1000, 3])
def test_removed_words(frame, monkeypatch, size, hot):
    monkeypatch.setattr(substrings, "HOT_LEAST", hot)
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(30)] + ["é", "日本"]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([size, size + 5, 60]))) for _ in range(8)]
    rows = []
    for i in range(150):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30))) for _ in range(3)]
        parts += [rng.choice(passages) for _ in range(rng.randint(0, 2))]
        rng.shuffle(parts)
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(parts)))
    rows += [(200, "from " * 100), (201, ""), (202, None), (203, rows[5][1]), (204, " ".join(passages))]
    rng.shuffle(rows)
    found = substrings.repeat_digests(frame(rows).repartition(5), size).collect()
    wanted = brute(rows, size)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == wanted


def test_rows_that_share_an_id_and_rows_without_one(frame):
    text = " ".join(f"w{i}" for i in range(30))
    found = substrings.repeat_digests(frame([(1, text), (1, text), (None, text), (2, text)])).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in found) == [("1", 0), ("1", 0), ("2", 30), ("None", 30)]
    assert substrings.repeat_digests(frame([])).count() == 0


def test_rows_without_an_id_are_spread_and_later_than_all_others(frame):
    passage = " ".join(f"w{i}" for i in range(25))
    rows = [(None, f"{passage} {k}") for k in range(40)] + [(None, None), (2**62, f"x {passage}")]
    found = substrings.repeat_digests(frame(rows)).collect()
    assert sorted(r["n_removed"] for r in found if r["doc_id"] is None) == [0] + [25] * 40
    assert [r["n_removed"] for r in found if r["doc_id"]] == [0]
    assert substrings._with_id(frame(rows)).select("id").distinct().count() == 42
    # Without any other id one of them is the first.
    alone = substrings.repeat_digests(frame(rows[:40])).collect()
    assert sorted(r["n_removed"] for r in alone) == [0] + [25] * 39


def test_clashing_columns_pass(frame):
    text = " ".join(f"w{i}" for i in range(30))
    docs = frame([(1, text), (2, text)]).withColumnsRenamed({"lang": "_id", "source": "row"})
    kept = substrings.remove_repeats(docs)
    assert kept.columns == docs.columns and sorted(r["text"] for r in kept.collect()) == ["", text]


def test_the_texts_keep_their_other_columns(frame):
    text = " ".join(f"w{i}" for i in range(30))
    kept = substrings.remove_repeats(frame([(1, text), (2, "before " + text + "  after"), (3, " as  it is"), (4, None)]))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "runs"]
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert (rows[2]["text"], rows[2]["n_chars"], rows[2]["runs"]) == ("before after", 12, 7)
    assert (rows[3]["text"], rows[4]["text"], rows[1]["text"]) == (" as  it is", None, text)
