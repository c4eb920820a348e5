"""Threshold joins against all products, and hard negatives against a search through all rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from concord.llm import negatives


@pytest.mark.parametrize("seed", range(8))
def test_threshold_join_finds_all_pairs(seed):
    rng = np.random.default_rng(seed)
    dims = int(rng.integers(1, 40))
    scale = rng.integers(1, 60, dims)
    q, x = (rng.normal(0, scale, (n, dims)).astype(int).astype(float) for n in (7, 50))
    x[::9] = 0
    products = q @ x.T
    least = np.quantile(products, rng.choice([0.0, 0.5, 0.9, 0.99, 1.0], 7), axis=1).diagonal().copy()
    least[rng.random(7) < 0.2] = -np.inf
    i, j, score = negatives.threshold_join(negatives.Vectors(q), negatives.Vectors(x), least)
    want = {(a, b): products[a, b] for a, b in zip(*np.nonzero(products >= least[:, None]))}
    assert len(i) == len(want) and {(a, b): s for a, b, s in zip(i, j, score)} == want


def brute(rows, low=80, high=100, every=3, positives=5, keep=5):
    rows = [(n, v, lab, x) for n, (v, lab, x) in enumerate(rows) if v is not None and lab is not None and x is not None and None not in x]

    def score(a, b):
        return sum(p * q for p, q in zip(a, b))

    out = []
    for n, v, lab, x in rows:
        if v % every:
            continue
        others = sorted((-score(x, y), w, m, lab2) for m, w, lab2, y in rows if m != n)
        for s, w, _, _ in [o for o in others if o[3] == lab][:positives]:
            fit = [o for o in others if o[3] != lab and low * -s <= 100 * -o[0] <= high * -s][:keep]
            out += [(v, w, k + 1, o[1], -s, -o[0]) for k, o in enumerate(fit)]
    return sorted(out)


def found(spark, rows, every=3, **options):
    frame = spark.createDataFrame([(*r, "a", 1, "b") for r in rows], "vec_id long, label int, x array<long>, row string, window int, score string")
    got = negatives.hard_negatives(frame, F.col("vec_id") % every == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def vectors(n, dims, labels, seed):
    rng = random.Random(seed)
    return [(i, rng.randrange(labels), [rng.randint(-9, 30) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("n, dims, labels, options", [(60, 12, 3, {}), (60, 12, 3, {"block": 4}), (40, 3, 2, {"low": 50}), (12, 20, 6, {})])
def test_brute_force(spark, n, dims, labels, options):
    rows = vectors(n, dims, labels, n)
    assert found(spark, rows, **options) == brute(rows, low=options.get("low", 80))


def test_chunks_and_first_rows(spark, monkeypatch):
    from concord.llm.negatives import first_of_windows

    rows = vectors(50, 6, 2, 5)
    block = negatives.Block(None, None, None, None, None, True, np.zeros((9, 2)), np.zeros((9, 2)))
    pairs = [np.array(c) for c in zip(*[(a, w, s, v, v) for v in range(30) for a in (0, 8) for w in (0, 1) for s in (v % 4,)])]
    got = list(zip(*first_of_windows(block, pairs, 3)))
    want = sorted(zip(*pairs), key=lambda r: (r[0], r[1], -r[2], r[3]))
    assert got == [r for a in (0, 8) for w in (0, 1) for r in [x for x in want if x[0] == a and x[1] == w][:3]]
    monkeypatch.setattr(negatives, "SHARES", (2.0, 0.9, 0.1))
    monkeypatch.setattr(negatives, "WINDOWS", (0.99, 0.95))
    assert found(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_lengths(spark):
    rows = vectors(20, 5, 2, 9)
    rows += [(None, 1, [1] * 5), (21, None, [1] * 5), (24, 0, None), (27, 0, [1, None, 3, 4, 5])]
    rows += [(30, 0, [20, 20]), (30, 0, [20, 20]), (33, 1, [20, 20]), (36, 0, []), (39, 1, [0] * 7)]
    rows += [(100 + i, i % 2, [9] * 5) for i in range(30)]
    assert found(spark, rows) == brute(rows)


def test_one_vector_of_a_third_of_all_rows(spark):
    rows = vectors(60, 8, 3, 11) + [(200 + i, i % 3, [7, 7, 7, 7, 7, 7, 7, 7]) for i in range(40)]
    assert found(spark, rows, every=5) == brute(rows, every=5)


def test_tables_without_pairs(spark):
    assert found(spark, [(0, 1, [1, 2])]) == []
    assert found(spark, [(i, 0, [i, 1]) for i in range(9)]) == []
    frame = spark.createDataFrame([], "vec_id long, label int, x array<long>")
    assert negatives.hard_negatives(frame, F.col("vec_id") % 3 == 0).collect() == []
    with pytest.raises(ValueError, match="too large"):
        found(spark, [(0, 1, [1 << 40]), (1, 1, [1 << 40])])
    large = [(0, 1, [1 << 25, 3]), (1, 1, [1 << 25, 5]), (2, 0, [1 << 25, 4]), (3, 0, [1 << 25, 7])]
    assert found(spark, large) == brute(large)


def test_whole_numbers(spark):
    frame = spark.createDataFrame([([0.5, -0.001],), ([None, 1.0],), ([float("nan")],), ([float("-inf")],), ([],), (None,)], "e array<float>")
    assert [r[0] for r in frame.select(negatives.whole_numbers(F.col("e"))).collect()] == [[128, -1], None, None, None, [], None]
