"""Links and components against brute force over all pairs."""

import random

import pytest

from aeromart.llm import neardup
from aeromart.llm.neardup import Rule, keep_one, near_duplicates


def brute(rows, rule):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        n = rule.shingle
        own = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(own)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= rule.percent * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def family(rng, base, copies, edits):
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("rule", [Rule(3, 85), Rule(5, 80), Rule(3, 85, 32)])
def test_components_are_those_of_all_pairs(frame, rule, monkeypatch):
    monkeypatch.setattr(neardup, "SHORT", 4)  # so that hubs are used
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12))) for _ in range(40)]
    for length, copies, edits in ((60, 25, 3), (200, 30, 12), (12, 8, 1), (300, 12, 40)):
        texts += family(rng, [rng.choice(vocabulary) for _ in range(length)], copies, edits)
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    texts += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(25)) for _ in range(20)]
    texts += [texts[-1].upper(), texts[50], texts[50], "", None, " \n "]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(3, texts[7]), (None, texts[9])]
    found = near_duplicates(frame(rows), rule).collect()
    assert len(found) == len(rows)
    wanted = brute([r for r in rows if r[0] is not None], rule)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == wanted[r["doc_id"]], r
            assert r["kept"] == (r["component_id"] == r["doc_id"])


def test_sizes_and_empty_table(frame):
    found = {r["doc_id"]: r for r in near_duplicates(frame([(1, "a b"), (2, "A B"), (3, ""), (4, "a b c a b c"), (5, None)]), Rule(3, 85)).collect()}
    assert {i: r["n_shingles"] for i, r in found.items()} == {1: 1, 2: 1, 3: 0, 4: 3, 5: 0}
    assert {i: r["component_id"] for i, r in found.items()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    assert near_duplicates(frame([])).count() == 0


def test_the_first_of_a_group_stays_with_its_columns(frame):
    kept = keep_one(frame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "g h"), (None, "a b c d e f")]))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "runs"]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "None"]
