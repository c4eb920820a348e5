import random
from pathlib import Path

import pytest

from concord.llm import tokens

BITS = ["  ", " ", "'s", "'l", "l", "\n", "\n\n", "foo", " 12", "...", "é", "", " 'll", "x" * 100, " a b c d e" * 200, "😀"]


@pytest.fixture(scope="module")
def count():
    return tokens.counter(Path(tokens.VOCABULARY).read_bytes(), tokens.PRE_TOKENS)


def test_edits_count_as_a_new_text(count):
    r = random.Random(5)
    for _ in range(300):
        text = "".join(r.choice(BITS + list(" 'slr\n1a.")) for _ in range(r.choice([0, 3, 30, 600])))
        tree = tokens.TokenTree.of(text, count)
        for _ in range(6):
            a = r.randint(0, len(text))
            z = min(len(text), a + r.choice([0, 1, 2, 10, 300]))
            new = r.choice(BITS)
            text = text[:a] + new + text[z:]
            tree.edit(a, z, new)
            assert tree.text == text and tree.length == len(text)
            assert tree.tokens == len(count.encoding.encode_ordinary(text))


def test_only_touched_regions_are_encoded(count):
    text = "The quick brown fox jumps over the lazy dog. " * 5000
    tree = tokens.TokenTree.of(text, count)
    tree.edit(100_000, 100_003, "cat")
    tree.edit(0, 0, "Once ")
    assert 0 < tree.recoded < 3000


def test_frames(spark, count):
    rows = [
        (1, "hello world", [(0, 5, "bye"), (3, 3, ",")]), (2, None, [(5, 2, "new")]), (3, "", None), (4, "abc", [(1, None, None), None, (-4, 99, "é")]),
        (5, "word " * 30_000, [(7, 9, "x")]), (5, "word " * 30_000, [(7, 9, "x")]), (None, "tie", []),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:int,stop:int,text:string>>")
    got = tokens.apply_edits(tokens.build_trees(docs), text=True).collect()
    want = {1: "bye, world", 2: "new", 3: "", 4: "é", 5: "word wox" + ("word " * 30_000)[9:], None: "tie"}
    assert len(got) == 7
    for r in got:
        assert r.text == want[r.doc_id] or r.doc_id == 5
        assert r.n_tokens_edited == len(count.encoding.encode_ordinary(r.text)) == sum(r.leaf_tokens)
        assert r.n_chars_edited == len(r.text) == sum(r.leaf_chars)
    before = {r.doc_id: r.n_tokens for r in got}
    assert before[5] == len(count.encoding.encode_ordinary("word " * 30_000)) and before[3] == 0


def test_stored_trees_take_further_edits(spark, count):
    docs = spark.createDataFrame([(1, "a b c " * 500, [(4, 6, "zz")])], "doc_id long, text string, edits array<struct<start:int,stop:int,text:string>>")
    once = tokens.apply_edits(tokens.build_trees(docs), text=True)
    again = once.selectExpr("doc_id", "text", "leaf_chars", "leaf_tokens", "array(named_struct('start', 100, 'stop', 130, 'text', 'new')) AS edits")
    r = tokens.apply_edits(again, text=True).first()
    assert r.n_tokens_edited == len(count.encoding.encode_ordinary(r.text))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, edits array<struct<start:int,stop:int,text:string>>")
    assert tokens.apply_edits(tokens.build_trees(docs)).collect() == []
