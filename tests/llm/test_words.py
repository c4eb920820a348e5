import random

import numpy as np
import pyarrow as pa

from concord.llm import words as W

from .conftest import words


def test_words_and_hashes(monkeypatch):
    monkeypatch.setattr(W, "SLICE", 64)
    r = random.Random(1)
    bits = ["a", "B", "é", "9", " ", "\n", "-", "😀", "zz", "", "\x00", "\x7f", "[", "`", "{", "@"]
    texts = ["".join(r.choices(bits, k=r.choice([0, 1, 5, 50]))) for _ in range(200)] + [None, "x" * 1000, "X" * 1000]
    hashes, seen = [], []
    for i, j, data, offsets in W.blocks(pa.array(["", *texts]).slice(1), 200):
        found = W.split(data, offsets)
        assert found.counts.tolist() == [len(words(t)) for t in texts[i:j]]
        assert [bytes(data[a:z]).decode().lower() for a, z in zip(found.starts, found.ends)] == [w.lower() for t in texts[i:j] for w in words(t)]
        hashes += found.hashes().tolist()
        seen += [w for t in texts[i:j] for w in words(t)]
    assert len(set(zip(seen, hashes))) == len(set(seen)) == len(set(hashes))


def test_sequence_hashes_tell_order_and_borders():
    def one(*texts):
        data = "".join(texts).encode()
        offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
        found = W.split(np.frombuffer(data, np.uint8), offsets)
        return W.sequence_hashes(found.hashes(), found.first).tolist()

    a, b, c, d, e = one("x y ", "y x ", "x,Y ", "", "x y y")
    assert a == c != b and d == 0 and e not in (a, b)
    assert one("", "")[0] == 0


def test_grams():
    h = W.seeded(5, 10)
    assert W.grams(h, 3)[2] == W.grams(h[2:5], 3)[0] and len(W.grams(h[:2], 3)) == 0
