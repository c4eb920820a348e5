"""Words, near words and forms against plain versions."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from concord.llm import spelling

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows, shortest=7, least=2, altered=31):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in _RUN.findall((text or "").translate(_LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if altered and h % altered == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_forms(words, times=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, n, len(near[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items())


def vocabulary(seed, n, letters="abcé", low=7, high=11):
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.randint(low, high))) for _ in range(n // 2)}
    for w in sorted(words):
        for _ in range(2):
            k = rng.randrange(len(w))
            words.add(rng.choice([w[:k] + w[k + 1 :], w[:k] + "b" + w[k:], w[:k] + "ñ" + w[k + 1 :]]))
    words |= {"a" * k for k in range(7, 12)} | {"ab" * k for k in range(4, 7)}
    return {w: rng.choice([2, 3, 25, 40, 500]) for w in words if len(w) >= 7}


def frame(spark, words):
    from concord.llm.frames import written

    return written(spark.createDataFrame(list(words.items()), "word string, n long").repartition(3))


@pytest.mark.parametrize("seed, letters, frequent, limit", [(1, "abcé", 100, 4096), (2, "ab", 3, 40), (3, "abcdefghij", 1, 5), (4, "a", 1, 3), (5, "abc", 1e9, 4096)])
def test_near_words_and_forms(spark, monkeypatch, seed, letters, frequent, limit):
    monkeypatch.setattr(spelling, "FREQUENT", frequent)
    words = vocabulary(seed, 160, letters)
    near = spelling.near_words(frame(spark, words), limit).collect()
    assert sorted((r.word, r.near, r.near_n) for r in near) == sorted((w, v, words[v]) for w in words for v in words if one_edit(w, v))
    forms = spelling.spelling_forms(frame(spark, words), limit=limit)
    assert sorted(tuple(r) for r in forms.select("word", "n", "n_near", "form", "form_n", "root").collect()) == plain_forms(words)


def test_lists_and_dictionary_joined_by_shuffle(spark, monkeypatch):
    from concord.llm import frames

    monkeypatch.setattr(frames, "SMALL_ROWS", 0)
    monkeypatch.setattr(spelling, "PAIRS", 7)
    words = vocabulary(6, 60, "abc")
    near = spelling.near_words(frame(spark, words), 4).collect()
    assert sorted((r.word, r.near) for r in near) == sorted((w, v) for w in words for v in words if one_edit(w, v))


def test_bound_holds_for_every_edit():
    rng = random.Random(7)
    counters = np.zeros(spelling.COUNTERS, np.int32)
    counters[:: 2] = 1000

    def parts(word):
        ((_, points),) = spelling.by_length([word])
        g = spelling.decompose(points, counters, 100)
        return list(zip(g.hashes[0].tolist(), g.places[0].tolist())), int(g.bound[0])

    for _ in range(200):
        w = "".join(rng.choices("abcd", k=rng.randint(7, 14)))
        k = rng.randrange(len(w))
        v = rng.choice([w[:k] + w[k + 1 :], w[:k] + "x" + w[k:], w[:k] + "x" + w[k + 1 :]])
        (a, bound), (b, _) = parts(w), parts(v)
        lost = Counter(h for h, _ in a) - Counter(h for h, _ in b)
        assert sum(lost.values()) <= bound < len(a)


def test_words_of_texts(spark, docs):
    rng = random.Random(8)
    pool = ["Seventh", "seventhly", "straße", "Großmütter", "naïveté", "x÷y×zabcdefg", "short", "été", "ÉTÉlongword", "日本語abcdefgh", "under_score_words", "1234567", "don'tdothis"]
    rows = [(i, " ".join(rng.choices(pool, k=40)) + rng.choice([".", "", "\n"])) for i in range(60)]
    rows += [(None, "Seventh " * 3), (99, None), (100, ""), (101, "seventh" * 9000 + " " + "a" * 300 + " " + "a" * 300), (5, rows[5][1]), (5, rows[5][1])]
    rows += [(200, "ab" * 150 + " " + "ab" * 150), (201, "ab" * 150)]
    for altered in (None, 31, 2):
        got = spelling.word_counts(docs(rows).select("doc_id", "text"), 7, 2, altered).collect()
        assert {r.word: r.n for r in got} == plain_words(rows, altered=altered) and len(got) == len({r.word for r in got})


def test_documents(docs):
    rows = [(1, "Pathetic pathetic " * 30 + "patetic patetic"), (2, None), (2, ""), (3, "PATHETICS pathetics pathetics"), (3, "PATHETICS pathetics pathetics")]
    got = spelling.spelling_variants(docs(rows))
    want = plain_forms(plain_words(rows, altered=None))
    assert sorted(tuple(r) for r in got.select("word", "n", "n_near", "form", "form_n", "root").collect()) == want
    assert spelling.spelling_variants(docs([])).collect() == []
    assert spelling.spelling_variants(docs([(1, "no words of two")])).collect() == []
    with pytest.raises(ValueError, match="code points"):
        spelling.spelling_variants(docs(rows), shortest=3)
