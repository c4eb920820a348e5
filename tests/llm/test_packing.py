"""Ids against the tokenizer, first fit against a plain search, and the contract of the packed pieces."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from concord.llm import packing, pretokens


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(packing.vocabulary())
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def ids(texts):
    encoder = pretokens.Encoder(open(packing.vocabulary(), "rb").read())
    return [x.tolist() for x in encoder.texts(pa.array(texts, pa.string()))]


def test_ids_are_those_of_the_tokenizer(encode):
    random.seed(3)
    bits = [*"abstrelmvd'''  \n\t\r.,!?-_09AZéüñ日本½²Ⅷ🙂|<>", "　", "​", "́", "\x1c", "\x85", "'s", "'ll", "  ", "<|endoftext|>"]
    texts = ["".join(random.choices(bits, k=random.randint(0, 40))) for _ in range(3000)]
    texts += [None, "", "'", " ", "\n", "a" * 5000, " " * 3000, "it's 'round we'll's'"]
    assert ids(texts) == [encode(t) for t in texts]


def test_ids_when_little_is_remembered(encode, monkeypatch):
    monkeypatch.setattr(pretokens, "REMEMBERED", 3)
    texts = ["one two three four five", "six seven one", "one"]
    assert ids(texts) == [encode(t) for t in texts]


def plain_first_fit(lengths, room):
    bins = []
    for n in sorted(lengths, reverse=True):
        for b in bins:
            if sum(b) + n <= room:
                b.append(n)
                break
        else:
            bins.append([n])
    return bins


@pytest.mark.parametrize("seed", range(6))
def test_first_fit_is_the_plain_one(seed):
    random.seed(seed)
    lengths = [random.randint(1, 64) for _ in range(random.randint(1, 200))]
    got = defaultdict(list)
    for s in sorted(packing.pack(lengths, 64, slack=64), key=lambda s: (s.sequence, s.offset)):
        got[s.sequence].append(s.length)
    assert list(got.values()) == plain_first_fit(lengths, 64)


@pytest.mark.parametrize("lengths", ([], [1], [64] * 3, [63, 62, 61], [5, 5, 5], list(range(1, 65))))
def test_every_token_has_one_place_and_little_padding(lengths):
    slots = packing.pack(lengths, 64, slack=2)
    at, inside = defaultdict(list), defaultdict(list)
    for s in slots:
        at[s.item].append((s.start, s.length))
        inside[s.sequence].append((s.offset, s.length))
    for i, n in enumerate(lengths):
        assert sorted(at[i])[0][0] == 0 and sum(x for _, x in at[i]) == n
        assert all(a + x == b for (a, x), (b, _) in zip(sorted(at[i]), sorted(at[i])[1:]))
    for runs in inside.values():
        runs.sort()
        assert runs[0][0] == 0 and all(a + x == b for (a, x), (b, _) in zip(runs, runs[1:]))
        filled = sum(x for _, x in runs)
        assert filled <= 64 and (64 - filled <= 2 or filled & (filled - 1) == 0)


def check(rows, texts, encode, sequence):
    """rows: of the operator; texts: the documents by id, each of them once."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for d, pieces in by_doc.items():
        want = np.array([*encode(texts[d]), 1], "<u4")
        pieces.sort(key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in pieces) == want.tobytes()
        assert [r.start for r in pieces] == np.cumsum([0, *(len(r.ids) // 4 for r in pieces)])[:-1].tolist()
        assert {r.doc_tokens for r in pieces} == {len(want)}
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        lengths = [len(r.ids) // 4 for r in pieces]
        assert [r.offset for r in pieces] == np.cumsum([0, *lengths])[:-1].tolist()
        filled = sum(lengths)
        assert filled <= sequence
        padding += 0 if filled & (filled - 1) == 0 else sequence - filled
    return padding / max(1, sum(len(r.ids) // 4 for r in rows))


def test_documents(docs, encode):
    random.seed(5)
    texts = {i: " ".join(random.choices(["alpha", "beta", "it's", "42", "é"], k=random.randint(0, 300))) for i in range(80)}
    texts |= {80: None, 81: "", 82: "word " * 20_000, None: "no id"}
    frame = docs(list(texts.items()))
    rows = packing.pack_documents(frame, sequence=128, group=2000).collect()
    assert check(rows, texts, encode, 128) < 0.02
    again = packing.pack_documents(frame, sequence=128, group=2000).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_repeated_rows_and_empty_tables(docs):
    rows = packing.pack_documents(docs([(7, "same words here")] * 5)).collect()
    assert sum(r.start == 0 for r in rows) == 5 and {r.doc_tokens for r in rows} == {4}
    assert packing.pack_documents(docs([])).collect() == []


def test_query(spark, encode):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = packing.op13_packing(spark, folder).collect()
    held = {d: np.array([*encode(t), 1], "<u4") for d, t in texts.items()}
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(held[r.doc_id][r.start : r.start + r.length].tobytes())
        assert r.doc_tokens == len(held[r.doc_id])
    assert sum(r.length for r in rows) == sum(map(len, held.values()))
