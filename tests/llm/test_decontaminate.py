import random

import pytest

from concord.llm import decontaminate

from .conftest import words


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(0, len(w) - 10) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    out = []
    for d, text in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        out.append((d, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=str)


@pytest.fixture
def tables():
    r = random.Random(5)
    vocabulary = ["a", "B", "ça", "d9", "e", "f", "g", "h", "i"]
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([1, 2, 3, 9, 10, 11, 25, 60])))) for i in range(25)]
    items += [(30, items[3][1].upper()), (31, None), (32, ""), (33, "..."), (3, items[3][1]), (None, "zz yy xx ww vv uu tt ss rr qq pp")]
    rows = []
    for d in range(60):
        w = r.choices(vocabulary, k=r.choice([0, 1, 5, 9, 10, 40, 300]))
        if d % 2:
            _, text = r.choice(items[:25])
            part = text.split()
            a = r.randrange(len(part))
            w[len(w) // 2 : len(w) // 2] = part[a : a + r.randint(1, 30)]
        rows.append((d, r.choice([" ", ", ", "-"]).join(w)))
    rows += [(70, None), (71, ""), (72, "x zz yy xx ww vv uu tt ss rr qq pp y"), (5, rows[5][1]), (5, rows[5][1]), (None, items[0][1]), (73, "a " * 30_000)]
    return rows, items


def test_brute_force(spark, docs, tables):
    rows, items = tables
    got = decontaminate.contamination(docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.items) for r in got), key=str) == brute(rows, items)
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r.items) for r in got)


def test_long_items_only(spark, docs, tables):
    rows, items = tables
    items = [x for x in items if len(words(x[1])) >= 10]
    got = decontaminate.contamination(docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.items) for r in got), key=str) == brute(rows, items)


def test_clean_documents_stay(spark, docs, tables):
    rows, items = tables
    frame = docs(rows)
    got = decontaminate.drop_contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == frame.columns
    assert {r.doc_id for r in got.collect()} == {d for d, _, hit, _ in brute(rows, items) if not hit} | {None}


def test_empty_tables(spark, docs, tables):
    rows, items = tables
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.n_hit == 0 for r in decontaminate.contamination(docs(rows), none).collect())
    assert decontaminate.contamination(docs([]), spark.createDataFrame(items, "item_id long, text string")).collect() == []
