import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from concord.llm import toxicity
from concord.llm import words as W

from .conftest import words


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(2)
    vocabulary = ["".join(r.choices(["ka", "lo", "mi", "ter", "sün"], k=r.randint(1, 4))) for _ in range(300)]
    rows, labels = [], []
    for d in range(900):
        toxic = d % 6 == 0
        w = r.choices(vocabulary, k=r.choice([8, 40, 200]))
        if toxic:
            for _ in range(max(1, len(w) // 30)):
                w[r.randrange(len(w))] = "grobian" + r.choice(vocabulary)
        rows.append((d, " ".join(w)))
        if d % 7:
            labels.append((d, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, docs, corpus):
    rows, labels = corpus
    rows = rows + [(2000, None), (2001, ""), (2002, "?!"), (5, rows[5][1]), (None, rows[0][1]), (2003, "ka lo mi " * 40_000)]
    labelled = spark.createDataFrame([*labels, (1, None), (None, 1), (99999, 1), labels[0]], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs(rows), labelled).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 0)
    assert all(r.predicted == 0 for r in got if r.doc_id in (2000, 2001, 2002, 2003))


def test_held_out_labels_change_nothing(spark, docs, corpus):
    rows, labels = corpus
    flipped = [(d, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, t in labels]
    a, b = (
        sorted(map(str, toxicity.toxicity_scores(docs(rows[:200]), spark.createDataFrame(x, "doc_id long, toxic int")).collect()))
        for x in (labels, flipped)
    )
    assert a == b


def test_rejected_documents_go(spark, docs, corpus):
    rows, labels = corpus
    frame = docs(rows)
    got = toxicity.drop_toxic(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    kept = {r.doc_id for r in got.collect()}
    assert got.columns == frame.columns
    assert len(kept & {d for d, _ in rows if d % 6}) >= 740 and len(kept & {d for d, _ in rows if d % 6 == 0}) <= 5


def test_no_labels_and_no_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r.predicted == 0 for r in toxicity.toxicity_scores(docs([(1, "a b"), (2, None)]), none).collect())
    assert toxicity.toxicity_scores(docs([]), none).collect() == []


def test_grams_of_words():
    found = W.split(np.frombuffer("Ab abc".encode(), np.uint8), np.array([0, 6]))
    d = toxicity.distinct_words(found)
    texts = {g.to_bytes(5, "big").lstrip(b"\0") for g in d.grams.tolist()}
    assert texts == {b"a", b"ab", b"ab\x01", b"abc", b"abc\x01"}


def test_shared_model_is_kneser_ney(spark):
    text = "ab abc bc bca cab ab"
    frame = spark.createDataFrame([(text, 1)], "text string, label int")
    got = {r.gram: r.p for r in toxicity.shared_model(toxicity.gram_counts(frame)).collect()}
    grams = set()
    for w in set(words(text)):
        s = b"\0\0\0\0" + w.encode() + b"\x01"
        grams |= {s[i - 4 : i + 1] for i in range(4, len(s))}

    levels, level = {}, grams
    for order in (4, 3, 2, 1):
        levels[order] = Counter(g[1:] for g in level)
        level = set(levels[order])

    def p(gram):
        order = len(gram)
        if order == 1:
            return levels[1][gram] / sum(levels[1].values())
        ends = {g: n for g, n in levels[order].items() if g[:-1] == gram[:-1]}
        total = sum(ends.values())
        return max(ends[gram] - 0.75, 0) / total + 0.75 * len(ends) / total * p(gram[1:])

    assert set(got) == {int.from_bytes(g, "big") for g in levels[4]}
    for g in levels[4]:
        assert got[int.from_bytes(g, "big")] == pytest.approx(p(g))


def test_features_of_batches_agree():
    ratios = toxicity.Ratios(np.array([97]), np.array([2.0]), np.array([-1.0]))
    texts = pa.array(["a b", "", None, "a " * 500, "zz"])
    whole = toxicity.features(texts, ratios)
    assert np.allclose(whole, np.concatenate([toxicity.features(texts.slice(i, 1), ratios) for i in range(5)]))
    assert (whole[1] == 0).all() and (whole[2] == 0).all()


def test_class_counts(spark):
    frame = spark.createDataFrame([("aa b", 1), ("aa", 0), ("aa aa", None)], "text string, label int")
    got = {r.gram: (r.toxic, r.plain) for r in toxicity.gram_counts(frame).collect()}
    want = defaultdict(lambda: [0, 0])
    for w, k in (("aa", 0), ("b", 0), ("aa", 1)):
        s = b"\0\0\0\0" + w.encode() + b"\x01"
        for i in range(4, len(s)):
            want[int.from_bytes(s[i - 4 : i + 1], "big")][k] += 1
    assert got == {k: tuple(v) for k, v in want.items()}
