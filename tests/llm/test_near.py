import random

import numpy as np
import pytest

from concord.llm import near

from .conftest import words


def grams(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [grams(t) for _, t in rows]
    n = len(rows)
    links = [[j for j in range(n) if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(n)]
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            low = min([root[i], *(root[j] for j in links[i])])
            changed |= low != root[i]
            root[i] = low
    group = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            group[root[i]] = min(group.get(root[i], d), d)
    return sorted(((d, group.get(root[i]), len(links[i])) for i, (d, _) in enumerate(rows)), key=str)


@pytest.fixture
def rows():
    r = random.Random(11)
    vocabulary = ["".join(r.choices("abcdeé", k=4)) for _ in range(400)]
    out = []
    for family in range(12):
        base = r.choices(vocabulary, k=r.choice([6, 30, 80, 150]))
        for _ in range(r.choice([1, 2, 5, 25])):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            out.append((r.choice([", ", " ", "\n"]).join(x.upper() if r.random() < 0.1 else x for x in w)))
    r.shuffle(out)
    rows = [(1000 - i, t) for i, t in enumerate(out)]
    return rows + [(1, None), (2, ""), (3, "!!"), (4, "one two"), (5, "ONE, two"), (6, "one two three"), (7, "one two"), (7, "one two"), (None, "one two")]


def test_brute_force(docs, rows):
    got = near.similarity_links(docs(rows), recall=0.99999).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(rows)


def test_blocks_of_a_large_cluster(docs, rows, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_NODES", 4)
    monkeypatch.setattr(near, "BLOCK_GRAMS", 300)
    got = near.similarity_links(docs(rows), recall=0.99999).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(rows)


def test_joins_by_shuffle(docs, rows, monkeypatch, spark):
    from concord.llm import frames

    monkeypatch.setattr(frames, "SMALL_ROWS", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = near.similarity_links(docs(rows), recall=0.99999).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(rows)


def test_one_stays(docs, rows):
    frame = docs(rows)
    got = near.keep_one(frame)
    assert got.columns == frame.columns
    want = {c for d, c, _ in brute(rows) if d is not None}
    assert {r.doc_id for r in got.collect()} == want | {None}


def test_empty(docs):
    assert near.similarity_links(docs([])).collect() == []


def test_common_grams_are_counted_alike():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 300, 200).astype(np.uint64)) for _ in range(40)]
    counts = near.shared_counts(sets)
    for i in range(40):
        for j in range(i):
            assert counts[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_bands_reach_the_recall():
    bands = near.bands_for(0.8, 0.999, 8)
    assert 1 - (1 - 0.8**8) ** bands >= 0.999 > 1 - (1 - 0.8**8) ** (bands - 1)
