"""Ids of byte-level BPE for whole columns of texts.

The tokenizer's file says what the ids are; splitting a text into pre-tokens, which is most of the
work, is done here on arrays of code points, and the tokenizer encodes only the distinct pre-tokens
that a worker does not remember.

A control string of the vocabulary inside a text is ordinary text.
"""

from __future__ import annotations

import os
import struct
import unicodedata

import numpy as np
import pyarrow as pa

from concord.llm import words as W

LETTER, NUMBER, OTHER, SPACE = range(4)
# Fixed value: the code points with the Unicode property White_Space.
SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Fixed value: endings that stay with an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Pre-tokens whose ids a worker remembers.
REMEMBERED = 600_000

_kinds: list[np.ndarray] = []


def kinds() -> np.ndarray:
    """The kind of each code point, worked out once in a worker."""
    if not _kinds:
        of = {"L": LETTER, "N": NUMBER}
        table = np.array([of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
        table[SPACES] = SPACE
        _kinds.append(table)
    return _kinds[0]


def token_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens start: code points of texts end to end, the first code point of each text."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = kinds()[points]
    opens = np.zeros(n + 1, bool)
    opens[first] = True
    opens[n] = True
    run = opens.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    starts = run[:n].copy()
    # The last of some white space before a text goes on is a token of its own, or starts one if it is a blank.
    ends = np.flatnonzero((kind == SPACE) & run[1:] & ~opens[1:])
    starts[ends] = True
    starts[ends[points[ends] == 0x20] + 1] = False
    # An apostrophe alone, not behind a blank, keeps its ending; letters after that are the next token.
    lone = np.flatnonzero((points == 0x27) & starts & run[1:] & ~opens[1:])
    rest = np.flatnonzero(run)
    stop = rest[np.searchsorted(rest, lone + 1, "right")] if len(lone) else lone
    for ending in ENDINGS:
        fits = stop - lone - 1 >= len(ending)
        for k, c in enumerate(ending):
            fits &= points[np.minimum(lone + 1 + k, n - 1)] == ord(c)
        at = lone[fits]
        starts[at + 1] = False
        after = at + 1 + len(ending)
        starts[after[after < stop[fits]]] = True
    return np.flatnonzero(starts)


class Encoder:
    """Ids of blocks of texts by the tokenizer of a file's content."""

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(content)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[bytes, bytes] = {}

    def ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token as bytes, four an id."""
        new = [p for p in pieces if p not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = pieces
        for i in range(0, len(new), 10_000):
            part = new[i : i + 10_000]
            found = self.tokenizer.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
            self.known.update(zip(part, [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in found]))
        return [self.known[p] for p in pieces]

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a block's texts end to end, and where each text's ids start."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        first = np.searchsorted(lead, offsets)
        starts = token_starts(points, first[:-1][offsets[:-1] < len(data)])
        begin = lead[starts]
        end = np.append(begin[1:], len(data)) if len(begin) else begin
        hashes = W.Words(data, begin, end, first).hashes(fold=np.arange(256, dtype=np.uint8))
        _, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        pieces = [raw[a:z] for a, z in zip(begin[at].tolist(), end[at].tolist())]
        ids = self.ids_of(pieces)
        flat = np.frombuffer(b"".join(ids), "<u4")
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        heads = np.cumsum(lengths) - lengths
        counts = lengths[which]
        place = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=place[1:])
        out = flat[np.repeat(heads[which] - place[:-1], counts) + np.arange(place[-1])]
        return out, place[np.searchsorted(begin, offsets)]

    def texts(self, column: pa.Array):
        """The ids of each text; a null is an empty text."""
        for _, _, data, offsets in W.blocks(column):
            ids, place = self.block(data, offsets)
            for a, z in zip(place[:-1].tolist(), place[1:].tolist()):
                yield ids[a:z]


_encoders: dict[int, Encoder] = {}


def encoder(content: bytes) -> Encoder:
    """One encoder for each tokenizer of a worker; it remembers from task to task."""
    key = hash(content)
    if key not in _encoders:
        _encoders[key] = Encoder(content)
    return _encoders[key]
