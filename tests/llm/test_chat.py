import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from concord.llm import chat

TRICKY = st.lists(st.sampled_from(["\\", "|", "<", ">", "<|end|>\n", "<|user|>", "a", "\n", "é", "😀", "end"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TRICKY, TRICKY), max_size=6))
def test_read_back(messages):
    formatted, _ = chat.render(messages)
    assert chat.parse(formatted) == messages


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), TRICKY), max_size=6))
def test_mask_covers_each_answer_once(messages):
    formatted, spans = chat.render(messages)
    assert [chat.unescape(formatted[a:z]) for a, z in spans] == [t for r, t in messages if r == "assistant"]


def test_fold():
    events = [
        ("start", 1, "user", None), ("delta", 1, None, "He"), ("start", 2, "assistant", None), ("delta", 2, None, "A"), ("delta", 1, None, "llo"),
        ("delta", 2, None, "B"), ("regenerate", 2, None, None), ("delta", 2, None, "C"), ("delta", 2, None, "D"), ("message", None, "system", "S"),
        ("message", None, "system", "S"), ("edit", 1, None, "Hi"), ("start", 3, "user", "x"), ("delete", 3, None, None), ("delta", 4, "tool", "t"),
    ]
    assert chat.fold(events) == [("user", "Hi"), ("assistant", "CD"), ("system", "S"), ("system", "S"), ("tool", "t")]
    with pytest.raises(ValueError):
        chat.fold([("other", 1, "user", "x")])


def test_log(spark):
    schema = "conv long, n long, what string, id long, role string, body string, order0 string, message int"
    rows = [
        (1, 3, "delta", 7, None, "lo | \\"), (1, 1, "message", None, "user", "hi"), (1, 2, "delta", 7, "assistant", "hel"),
        (None, 1, "message", None, "assistant", None), (2, None, "message", None, None, "first"), (2, 0, "message", None, "user", "x" * 100_000),
        (3, 1, "message", None, "user", "dup"), (3, 1, "message", None, "user", "dup"), (4, 1, "start", 1, "user", "gone"), (4, 2, "delete", 1, None, None),
    ]
    log = spark.createDataFrame([(*r, "o", 1) for r in rows], schema)
    got = {r.conversation: r for r in chat.format_chats(log, ["n"], "conv", "what", "id", "role", "body").collect()}
    told = {k: chat.parse(r.formatted) for k, r in got.items()}
    assert told == {
        1: [("user", "hi"), ("assistant", "hello | \\")], None: [("assistant", "")], 2: [("", "first"), ("user", "x" * 100_000)],
        3: [("user", "dup"), ("user", "dup")], 4: [],
    }
    read = {r.conversation: r for r in chat.digests(chat.format_chats(log, ["n"], "conv", "what", "id", "role", "body")).collect()}
    assert read[1].loss_chars == 9 and read[1].loss_sha256 == hashlib.sha256(b"hello | \\").hexdigest()


def test_empty(spark):
    log = spark.createDataFrame([], "conversation long, sequence long, event string, message long, role string, text string")
    assert chat.format_chats(log).collect() == []


def test_streamed_turns_fold_to_the_turns(spark):
    texts = ["", None, "a", "😀é", "x|y\\z", "same", "same", "long " * 5000, "<|end|>"]
    turns = [(c, n, "assistant" if n % 2 else "user", t) for c in (1, 2, None) for n, t in enumerate(texts)]
    turns += [(1, 5, "assistant", "same"), (1, None, "system", "first")]
    frame = spark.createDataFrame([(*t, "e", 1) for t in turns], "conv long, turn int, role string, text string, event string, step int")
    log = chat.streamed(frame, "conv", ["turn", "role", "text"])
    kinds = {r.event: r.n for r in log.groupBy("event").agg({"*": "count"}).toDF("event", "n").collect()}
    assert set(kinds) == {"message", "start", "delta", "edit", "regenerate"} and kinds["message"] == 6
    assert log.where("event = 'message' AND text <> ''").count() == 0
    got = {r.conversation: chat.parse(r.formatted) for r in chat.format_chats(log, ["sequence", "step"]).collect()}
    for c in (1, 2, None):
        rows = sorted((t for t in turns if t[0] == c), key=lambda t: (t[1] is not None, t[1], t[2], t[3] or ""))
        assert got[c] == [(r, t or "") for _, _, r, t in rows]
    assert chat.streamed(frame.limit(0), "conv", ["turn"]).collect() == []
