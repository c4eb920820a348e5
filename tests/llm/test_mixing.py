import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from concord.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


def nearest(sizes, target):
    """The least distance to the target that whole passes and each document once more can have."""
    total = sum(sizes)
    passes = min(3, int(target // total)) if total else 3
    rest = 0 if passes == 3 else round(target - passes * total)
    sums = 1
    for s in sizes:
        sums |= sums << s
    return min((abs(i - rest) for i in range(2 * rest + 1) if sums >> i & 1), default=0)


@pytest.fixture
def rows():
    r = random.Random(3)
    out = []
    for i in range(600):
        source = r.choice(["b", "B", "é", "tiny", None, "b", "b", "zero"])
        n = 0 if source == "zero" else r.choice([1, 2, 3]) if source == "tiny" else r.choice([7, 7, 7, 30, 211, 5000])
        out.append((i, " \t".join(["w x"] * n), source))
    return out + [(600, None, "b"), (601, "", None), (5, "again again", "b"), (5, "again again", "b"), (None, "no id", "B")]


def test_targets_and_taken(docs, rows):
    got = mixing.mix_sources(docs(rows)).collect()
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == 0 if r.size == 0 else r.taken % r.size == 0 and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(3.5, 0.01 * t), (s, taken[s], t)


def test_reruns_agree(docs, rows):
    first = sorted(map(str, mixing.mix_sources(docs(rows)).collect()))
    assert first == sorted(map(str, mixing.mix_sources(docs(rows[::-1]).repartition(3)).collect()))


def test_one_length_is_split_exactly(docs):
    """Copies of one length in a hot source: the rank within parts adds up to the planned number."""
    rows = [(i, "a b c", "hot") for i in range(3000)] + [(5000 + i, "a b", "z") for i in range(1500)]
    got = mixing.mix_sources(docs(rows)).collect()
    want = brute_targets({"hot": 9000, "z": 3000})
    assert abs(sum(r.taken for r in got if r.source == "hot") - want["hot"]) <= 1.5


def test_empty(docs):
    assert mixing.mix_sources(docs([])).collect() == []
    assert [r.taken for r in mixing.mix_sources(docs([(1, None), (2, "")])).collect()] == [0, 0]


def test_fit_is_nearest():
    r = random.Random(7)
    for _ in range(200):
        sizes = np.array(sorted(r.sample(range(1, 40), r.randint(1, 5))))
        counts = np.array([r.randint(1, 4) for _ in sizes])
        sums = {sum(n * s for n, s in zip(c, sizes)) for c in itertools.product(*(range(c + 1) for c in counts))}
        budget = r.randint(0, int((sizes * counts).sum()))
        n = mixing.knapsack(sizes[::-1].astype(object), counts[::-1].astype(object), budget)
        assert (n <= counts[::-1]).all()
        assert abs(int((n * sizes[::-1]).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_large_budget():
    r = np.random.default_rng(1)
    sizes = np.unique(r.integers(1, 20_000, 3000))
    counts = r.integers(1, 10**6, len(sizes))
    for budget in (1, 12_345, 10**9 + 7, int((sizes * counts).sum()) - 1):
        n = mixing.best_fit(sizes, counts, budget)
        assert (n >= 0).all() and (n <= counts).all() and abs(int((n * sizes).sum()) - budget) <= 1
