import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from concord.llm import passages

from .conftest import words


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance():
    r = random.Random(1)
    for _ in range(500):
        a, b = ([r.randint(0, 3) for _ in range(r.randint(0, 12))] for _ in range(2))
        assert passages.edit_distance(a, b) == plain_distance(a, b)


def test_chain_over_edits_and_apart():
    place = np.array([0, 3, 9, 30, 33, 40, 500, 505])
    other = np.array([100, 103, 109, 128, 131, 138, 20, 25])
    assert sorted(passages.chains(place, other)) == [(0, 46, 100, 144), (500, 511, 20, 31)]


def test_crossing_matches_are_no_chain():
    found = passages.chains(np.array([0, 5, 10, 50, 55, 60]), np.array([50, 55, 60, 0, 5, 10]))
    assert sorted(found) == [(0, 16, 50, 66), (50, 66, 0, 16)]


def test_chain_behind_a_long_run():
    """Ten-word runs with a word between them, 100 words behind an exact run of 400 words."""
    place, other = list(range(395)), list(range(395))
    for k in range(8):
        place += [500 + 10 * k + i for i in range(5)]
        other += [500 + 11 * k + i for i in range(5)]
    assert sorted(passages.chains(np.array(place), np.array(other))) == [(0, 400, 0, 400), (500, 580, 500, 587)]


@pytest.mark.parametrize("apart", (17, 25))
def test_exact_passage_near_another_phrase(docs, apart):
    """The chain over both has too little identity; the passage on its own is exact."""
    new = iter("v%dq" % i for i in range(10**6))
    passage, phrase = ([next(new) for _ in range(n)] for n in (60, 15))
    rows = [(d, " ".join([*passage, *(next(new) for _ in range(apart)), *phrase, *(next(new) for _ in range(40))])) for d in range(2)]
    got = {r.doc_id: [(p.start, p.stop) for p in r.passages] for r in passages.repeated_passages(docs(rows)).collect()}
    assert all(len(p) == 1 and p[0][0] == 0 and 60 <= p[0][1] <= 60 + apart + 15 for p in got.values())
    assert apart < 25 or got == {d: [(0, 60)] for d in range(2)}


def test_stretches_of_a_chain():
    """Each is similar, none can be made longer by a part on either side, and every exact part is in one."""
    r = random.Random(3)
    for _ in range(200):
        x, y, parts = [], [], []
        for k in range(r.randint(1, 8)):
            if k:
                x += [r.randint(10**6, 10**9) for _ in range(r.randint(0, 20))]
                y += [r.randint(10**6, 10**9) for _ in range(r.randint(1, 20))]
            same = [r.randint(0, 10**6) for _ in range(r.randint(6, 40))]
            parts.append((len(x), len(x) + len(same), len(y), len(y) + len(same)))
            x, y = x + same, y + same
        got = passages.similar_parts(np.array(x), np.array(y), np.array(parts))

        def similar(a, z, c, e):
            return plain_distance(x[a:z], y[c:e]) <= 0.2 * max(z - a, e - c)

        assert all(similar(*g) for g in got)
        every = [(p[0], q[1], p[2], q[3]) for i, p in enumerate(parts) for q in parts[i:]]
        longest = [s for s in every if similar(*s)]
        assert set(got) == {s for s in longest if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in longest)}


@pytest.fixture
def rows():
    """Texts of their own words, some with a passage; of each passage one word in 25 is changed at most."""
    r = random.Random(4)
    new = iter("w%dq" % i for i in range(10**6))
    shared = [[next(new) for _ in range(n)] for n in (60, 90, 200, 40)]
    rows = []
    for d in range(80):
        w = [next(new) for _ in range(r.choice([5, 60, 300]))]
        if d % 4:
            p = list(shared[d % 4 - 1 if d % 8 < 4 else 3])
            if d % 3 == 0:
                for k in range(20, len(p) - 20, 25):
                    p[k] = next(new)
            at = r.randint(0, len(w))
            w[at:at] = p
        rows.append((d, r.choice([" ", ", "]).join(w).title()))
    rows += [(100, rows[1][1].upper()), (101, rows[4][1]), (101, rows[4][1]), (102, None), (103, ""), (104, "dup dup"), (105, "dup dup"), (None, rows[5][1])]
    return rows, shared


def test_planted_passages(docs, rows):
    rows, shared = rows
    texts = {d: words(t) for d, t in rows}
    got = passages.repeated_passages(docs(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        w = texts[r.doc_id]
        assert r.n_words == len(w) and r.n_repeated == sum(p.stop - p.start for p in r.passages) and r.n_copied <= r.n_repeated
        inside = {i for p in r.passages for i in range(p.start, p.stop)}
        assert bool(r.passages) == bool(r.shared_with) and (r.doc_id not in r.shared_with or r.doc_id == 101)
        assert all(set(w) & set(texts[d]) for d in r.shared_with)
        same = sum(x == w for x in texts.values()) > 1 and len(w) >= 50
        for p in shared[:3]:
            places = [i for i, x in enumerate(w) if x in set(p)]
            if len(places) >= 50:
                assert set(range(places[0], places[-1] + 1)) <= inside, (r.doc_id, r.passages)
        if not same:
            allowed = {x for p in shared[:3] for x in p}
            runs = [w[p.start : p.stop] for p in r.passages]
            assert all(sum(x in allowed for x in run) >= 0.9 * len(run) for run in runs)


def test_changed_words(docs):
    """Passages of 60 to 150 words with every 8th, 10th, 12th or 25th word changed: all are found, but for five words at the end at most."""
    r = random.Random(5)
    new = iter("u%dq" % i for i in range(10**6))
    rows, at = [], {}
    for n in (60, 80, 100, 150):
        for every in (8, 10, 12, 25):
            for _ in range(5):
                p = [next(new) for _ in range(n)]
                changed = [next(new) if k % every == every - 1 else w for k, w in enumerate(p)]
                for w in (p, changed):
                    before, after = ([next(new) for _ in range(r.randint(5, 40))] for _ in range(2))
                    at[len(rows)] = len(before), len(before) + n
                    rows.append((len(rows), " ".join(before + w + after)))
    got = {r.doc_id: r.passages for r in passages.repeated_passages(docs(rows)).collect()}
    lost = [d for d, (a, z) in at.items() if not any(p.start == a and z - 6 <= p.stop <= z for p in got[d])]
    assert not lost, f"{len(lost)} of {len(at)}"


@pytest.mark.parametrize("others", (1, 3, 6, 50))
def test_phrases_scattered_elsewhere(docs, others):
    """Two texts share a passage; other texts hold its runs of six words, but not in its order."""
    r = random.Random(others)
    new = iter("s%dq" % i for i in range(10**6))
    p = [next(new) for _ in range(60)]

    def apart():
        out = []
        for i in r.sample(range(55), 55):
            out += [*p[i : i + 6], *(next(new) for _ in range(40))]
        return out

    rows = [(d, " ".join([*(next(new) for _ in range(20)), *p, *(next(new) for _ in range(20))])) for d in range(2)]
    rows += [(10 + d, " ".join(apart())) for d in range(others)]
    got = {x.doc_id: x for x in passages.repeated_passages(docs(rows)).collect()}
    assert [(s.start, s.stop) for s in got[0].passages] == [(s.start, s.stop) for s in got[1].passages] == [(20, 80)]
    assert got[0].shared_with == [1] and got[1].shared_with == [0]
    assert not any(got[10 + d].passages for d in range(others))


def test_every_exact_window(docs):
    """Texts over few words and phrases: every window of PASSAGE words that two texts hold is in passages of both."""
    r = random.Random(9)
    phrases = [["p%d" % r.randint(0, 400) for _ in range(r.randint(6, 30))] for _ in range(40)]
    rows = []
    for d in range(60):
        w = [x for _ in range(r.randint(0, 25)) for x in r.choice(phrases)]
        if rows and d % 3 == 0:
            o = words(r.choice(rows)[1])
            i = r.randint(0, max(0, len(o) - 70))
            w[len(w) // 2 : len(w) // 2] = o[i : i + r.randint(50, 70)]
        rows.append((d, " ".join(w)))
    holders = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - passages.PASSAGE + 1):
            holders.setdefault(tuple(w[i : i + passages.PASSAGE]), set()).add(d)
    got = {x.doc_id: x for x in passages.repeated_passages(docs(rows)).collect()}
    found = 0
    for d, t in rows:
        w = words(t)
        inside = {i for p in got[d].passages for i in range(p.start, p.stop)}
        for i in range(len(w) - passages.PASSAGE + 1):
            if len(holders[tuple(w[i : i + passages.PASSAGE])]) > 1:
                found += 1
                assert set(range(i, i + passages.PASSAGE)) <= inside, (d, i)
    assert found > 100


def test_parts_of_the_seed_join(docs):
    """Every shared occurrence comes back once, matched with the first of the smallest text, frequent seeds included."""
    r = random.Random(2)
    line = ["l%d" % i for i in range(8)]
    rows = [(d, " ".join([*("u%dx%d" % (d, i) for i in range(r.randint(0, 30))), *(line * (d % 3)), *["x%d" % r.randint(0, 2) for _ in range(9)]])) for d in range(70)]
    ours = docs(rows).select("text", F.lit(None).cast("array<long>").alias("skipped"))
    texts = passages.texts_of(docs(rows)).collect()
    nodes = {x.doc_id: x.node for x in texts}
    at = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - passages.SEED + 1):
            at.setdefault(tuple(w[i : i + passages.SEED]), []).append((nodes[d], i))
    want = sorted((n, i, *min(held)) for held in at.values() if len({n for n, _ in held}) > 1 for n, i in held)
    assert max(map(len, at.values())) > 2 * passages.OFTEN
    for n_words in (1, 40 * passages.PART):
        got = passages.shared_seeds(ours, n_words).collect()
        assert sorted((x.node, x.place, x.other, x.at) for x in got) == want


def test_one_occurrence_is_left(docs, rows):
    rows, shared = rows
    got = {r.doc_id: r for r in passages.repeated_passages(docs(rows[:80])).collect()}
    holders = [got[d] for d in range(80) if d % 4 == 3 and d % 8 < 4]
    assert all(r.n_repeated >= 190 for r in holders) and sum(r.n_copied < 100 for r in holders) <= 2


def test_joins_by_shuffle(docs, rows, monkeypatch):
    from concord.llm import frames

    want = sorted(map(str, passages.repeated_passages(docs(rows[0])).collect()))
    monkeypatch.setattr(frames, "SMALL_ROWS", -1)
    assert sorted(map(str, passages.repeated_passages(docs(rows[0])).collect())) == want


def test_empty(docs):
    assert passages.repeated_passages(docs([])).collect() == []


def test_no_two_classes_share_a_window(docs):
    """Texts that hold a window of PASSAGE words are in one class, also where none is matched with the other one."""
    r = random.Random(6)
    new = iter("c%dq" % i for i in range(10**6))
    shared = [[next(new) for _ in range(70)] for _ in range(6)]
    held = {0: (0,), 1: (0,), 2: (0, 1), 3: (1,), 4: (1,), 5: (2,), 6: (2, 3), 7: (3, 4), 8: (4,), 9: (5,), 10: ()}
    rows = []
    for d in r.sample(sorted(held), len(held)):
        w = [next(new) for _ in range(30)]
        for k in held[d]:
            w += [*shared[k], *(next(new) for _ in range(40))]
        rows.append((d, " ".join(w)))
    copied = " ".join(next(new) for _ in range(60))
    rows += [(20, copied), (21, copied), (None, " ".join(shared[5])), (30, None), (31, "a b"), (32, "a b")]
    got = passages.repeated_passages(docs(rows)).collect()
    assert len(got) == len(rows) and any(len(x.shared_with) < 4 for x in got if x.doc_id in range(5))
    found = {x.doc_id: x.class_id for x in got}
    assert found == {**dict.fromkeys(range(5), 0), **dict.fromkeys(range(5, 9), 5), 9: 9, None: 9, 10: 10, 20: 20, 21: 20, 30: 30, 31: 31, 32: 32}


def test_classes_of_every_exact_window(docs):
    """Texts over few phrases, in part with changed words: holders of a window of PASSAGE words are in one class."""
    r = random.Random(12)
    new = iter("e%dq" % i for i in range(10**6))
    rows = []
    for k in range(12):
        phrase = [["k%dp%d" % (k, r.randint(0, 60)) for _ in range(r.randint(6, 30))] for _ in range(6)]
        for _ in range(6):
            w = [x for _ in range(r.randint(2, 12)) for x in r.choice(phrase)]
            rows.append((len(rows), " ".join(next(new) if r.random() < 0.02 else x for x in w)))
    holders = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - passages.PASSAGE + 1):
            holders.setdefault(tuple(w[i : i + passages.PASSAGE]), set()).add(d)
    found = {x.doc_id: x.class_id for x in passages.repeated_passages(docs(rows)).collect()}
    several = [h for h in holders.values() if len(h) > 1]
    assert len(several) > 30 and all(len({found[d] for d in h}) == 1 for h in several)
    assert all(found[d] // 6 == d // 6 and found[d] <= d for d in found)


def test_rounds_of_the_seed_join(docs, monkeypatch):
    """Seeds are shuffled in rounds of about the same size, whose shuffle files are gone when the next one begins."""
    spark = docs([]).sparkSession
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    packed, sent, left = passages.packed_seeds, [], []

    def files():
        found = held.getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    def watched(ours, parts, first, last):
        for _ in range(50):
            if not (rest := files() - known):
                break
            time.sleep(0.1)
        left.append(rest)
        out = packed(ours, parts, first, last)
        sent.append(sum(len(r.seeds) for r in out.collect()))
        return out

    known = files()
    monkeypatch.setattr(passages, "packed_seeds", watched)
    new = iter("r%dq" % i for i in range(10**6))
    rows = [(d, " ".join(next(new) for _ in range(200))) for d in range(40)]
    passages.shared_seeds(docs(rows).select("text", F.lit(None).cast("array<long>").alias("skipped")), 40 * passages.PART)
    whole = 40 * (200 - passages.SEED + 1) * passages.LOW
    assert sum(sent) == whole and max(sent) < 0.5 * whole and len(sent) == passages.ROUNDS
    assert not any(left)


def test_words_around_exact_chains():
    """Only the words around a chain of one exact part are sent, and the chain reaches as far as with all of them."""
    r = random.Random(8)
    for _ in range(200):
        n = r.randint(12, 300)
        same = [r.randint(10**6, 10**9) for _ in range(n)]
        sides = [([r.randint(0, 1) for _ in range(r.randint(0, passages.MARGIN))], [r.randint(0, 1) for _ in range(r.randint(0, passages.MARGIN))]) for _ in range(2)]
        got = []
        for exact in (False, True):
            row = {"node": 1, "start": 20, "stop": 20 + n, "other": 2, "low": 50, "high": 50 + n, "exact": exact, "parts": np.array([0, n, 0, n], np.int32).tobytes()}
            for name, (before, after) in zip(("", "other_"), sides):
                row |= {name + "ahead": len(before), name + "words": np.array([*before, *([] if exact else same), *after], np.uint64).tobytes()}
            got.append([b.to_pylist() for b in passages._aligned([pa.RecordBatch.from_pylist([row])])])
        assert got[0] == got[1] and got[0]
    text = " ".join("w%d" % i for i in range(500))
    node = next(passages._seeds({"text": pa.array([text]), "skipped": pa.array([None], pa.list_(pa.int64()))}, 0, (1 << 64) - 1))[0][0]
    chain = {"node": int(node), "start": 30, "stop": 430, "other": 5, "low": 0, "high": 400, "parts": b""}
    wanted = [chain | {"exact": exact} for exact in (False, True)]
    out = [row for b in passages._slices([pa.RecordBatch.from_pylist([{"text": text, "wanted": wanted}])]) for row in b.to_pylist()]
    assert [(x["exact"], x["ahead"], len(x["words"]) // 8) for x in out] == [(False, 16, 432), (True, 16, 32)]


def test_seed_tables_are_removed(docs, rows, monkeypatch):
    from concord import session

    spark, tables = docs([]).sparkSession, []
    plain = passages.shared_seeds

    def watched(*given):
        before = session.written_folders(spark)
        out = plain(*given)
        tables.extend(f for f in session.written_folders(spark) if f not in before)
        return out

    monkeypatch.setattr(passages, "shared_seeds", watched)
    found = passages.repeated_passages(docs(rows[0]))
    assert tables and not set(tables) & set(session.written_folders(spark))
    assert found.where("n_repeated > 0").count()
