from collections import defaultdict

import numpy as np

from concord.llm import exact

ROWS = [(1, "Abc"), (2, "aBC"), (3, None), (4, ""), (5, "ÄBC"), (6, "äBC"), (7, "only"), (7, "only"), (8, "abc "), (9, "x" * 200_000), (10, "X" * 200_000), (None, "abc"), (None, "null id")]


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").encode().lower()].append(i)
    return {k: (max((i for i in v if i is not None), default=None), len(v)) for k, v in groups.items()}


def test_groups(docs):
    got = exact.exact_groups(docs(ROWS)).collect()
    want = brute(ROWS)
    assert len(got) == len(ROWS)
    texts = dict(ROWS)
    for r in got:
        if r.doc_id is not None:
            assert (r.keep_id, r.group_size) == want[(texts[r.doc_id] or "").encode().lower()]
            assert bytes(r.digest) == exact.digest((texts[r.doc_id] or "").encode())
    assert sum(r.kept for r in got) == len(want)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_kept_rows_have_all_columns(docs):
    frame = docs(ROWS)
    got = exact.keep_exact(frame)
    assert got.columns == frame.columns
    assert sorted((r.text or "").encode().lower() for r in got.collect()) == sorted(brute(ROWS))
    assert {r.doc_id for r in got.collect()} == {2, 4, 5, 6, 7, 8, 10, None}


def test_empty(docs):
    assert exact.exact_groups(docs([])).collect() == []
    assert exact.keep_exact(docs([])).collect() == []


def test_full_filter_loses_nothing(docs, monkeypatch):
    monkeypatch.setattr(exact, "FILTER_BYTES", 1 << 10)
    rows = [(i, f"text {i // 2 if i < 40 else i}") for i in range(3000)]
    got = exact.exact_groups(docs(rows)).collect()
    assert sum(r.kept for r in got) == 2980 and sum(r.group_size == 2 for r in got) == 40


def test_both_bits_lie_in_one_block():
    d = np.random.default_rng(1).integers(0, 256, 32 * 100).astype(np.uint8)
    a, b = exact.places(d, 8)
    assert (a >> np.uint64(exact.BLOCK_BITS) == b >> np.uint64(exact.BLOCK_BITS)).all() and a.max() < 8 << exact.BLOCK_BITS
