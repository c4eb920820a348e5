"""Substring de-duplication by collinear chaining.

Every run of SEED words is a seed; a copy without SEED unchanged words in a row is not found. Seeds are
joined by their hashes in parts of about PART seeds, as many as the texts need, and travel as packed
numbers, a range of hashes in each of up to ROUNDS rounds: the files of a round's shuffle go before the
next one, so that a part of the seeds lies on the disks at a time. Each occurrence of a seed that several texts hold is matched with one occurrence only, the
first in the text with the smallest number among them; a passage in n texts gives n matches a seed,
never pairs. That text may hold the seeds of a passage scattered, which hides the texts that hold it
whole: so a window of PASSAGE words whose seeds are all shared, but not matched with one stretch of
one text, is a seed of its own and matched in the same way. Whatever text is chosen for it holds the
whole window, so every window of PASSAGE words that two different texts hold is found in both.

A text's matches with one other text are joined into runs on one diagonal, and the runs are chained
in the order of both texts at a cost for gaps, the best predecessor within MAX_GAP coming from a
segment tree (a Fenwick tree gives the best of all predecessors, however far away, and not that of a
window). The words of a chain on both sides are then aligned; chains of at least IDENTITY are fuzzy
copies, and of any other chain its longest stretches that are, with exact extension over the ends.
What a text shares with one or more others, put together over small gaps, is a passage from PASSAGE
words on.

Words are runs of digits, letters and non-ASCII characters after lower-casing A-Z. Copies (the same
words in the same order) are one text; all of it is a passage if it is long enough. A null text is
empty, a very long one is looked at whole. Rows that agree in id and words are one document and get
the same result. An empty table gives an empty result. Other columns than id and text are left out.
"""

from __future__ import annotations

import functools
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm import words as W
from concord.llm.components import stars
from concord.llm.frames import fields, picked, small_or_shuffled, table, written_once
from concord.session import drop_folders, written_folders

SEED = 6
#: Words between matches of one run, and between runs of one chain.
NEAR = 12
MAX_GAP = 32
GAP_COST = 0.1
#: Shortest chain, shortest passage, words between parts of a passage, and least identity of a chain.
CHAIN = 12
PASSAGE = 50
BRIDGE = 8
IDENTITY = 0.8
#: Words around a chain that it may be extended over.
MARGIN = 16
#: Seeds a task gathers before it passes them on, and seeds of a part of the join on average.
GATHERED = 1 << 20
PART = 1 << 20
#: Rounds in which the parts are joined; each reads the texts once more.
ROUNDS = 3
#: Of a seed that a task has gathered more often, two occurrences go to its part; the others wait for its answer.
OFTEN = 16
#: Seeds in a window of PASSAGE words.
WINDOW = PASSAGE - SEED + 1
#: Bytes of a seed's hash that are passed on.
LOW = 5
#: Words of a text whose spans are fetched together.
STRETCH = 4096
#: Bytes of a chain's parts if it has one.
ONE_PART = 16


def _seeds(batch, least: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By block of the texts of (text, skipped): hashes of the texts, text number, place and hash of every seed whose hash
    is from least to most."""
    skipped = batch["skipped"].to_pylist()
    for i, j, data, offsets in W.blocks(batch["text"]):
        found = W.split(data, offsets)
        hashes = found.hashes()
        nodes = W.sequence_hashes(hashes, found.first).view(np.int64)
        grams = W.grams(hashes, SEED)
        owner = np.repeat(np.arange(j - i), found.counts)[: len(grams)]
        left = np.array([s is None or n not in s for n, s in zip(nodes.tolist(), skipped[i:j])], bool)
        inside = (np.arange(len(grams)) + SEED <= found.first[1:][owner]) & left[owner]
        at = np.flatnonzero(inside & (grams >= np.uint64(least)) & (grams <= np.uint64(most)))
        yield nodes, owner[at], at - found.first[owner[at]], grams[at]


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id, node (a hash of the words; null without any), n_words."""
    schema = T.StructType([*fields(docs, ["doc_id"]), T.StructField("node", T.LongType()), T.StructField("n_words", T.LongType())])

    def run(batches):
        for b in batches:
            for i, j, data, offsets in W.blocks(b["text"]):
                found = W.split(data, offsets)
                nodes = W.sequence_hashes(found.hashes(), found.first).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"].slice(i, j - i), pa.array(nodes, mask=found.counts == 0), pa.array(found.counts.astype(np.int64))],
                    names=["doc_id", "node", "n_words"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


#: Kinds of packed seeds: usual ones, the two passed on of a frequent one, and its other occurrences.
USUAL, ENDS, WAITING = 0, 1, 2
_PACKED = "to int, part int, kind int, seeds binary, nodes binary, places binary"
_SHARED = "seed long, node long, place int, other long, at int"


def _heads(sorted_values: np.ndarray) -> np.ndarray:
    """Where each value of a sorted array begins."""
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])[: len(sorted_values)])


def _kinds(seeds: np.ndarray, nodes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The kind of each of the sorted seeds."""
    n = np.diff(np.append(_heads(seeds), len(seeds)))
    kinds = np.zeros(len(seeds), np.int8)
    often = np.flatnonzero(np.repeat(n > OFTEN, n))
    if len(often):
        often = often[np.lexsort((places[often], nodes[often], seeds[often]))]
        kinds[often] = WAITING
        heads = _heads(seeds[often])
        tails = np.append(heads[1:], len(often)) - 1
        kinds[often[heads]] = ENDS
        kinds[often[tails[nodes[often[heads]] != nodes[often[tails]]]]] = ENDS
    return kinds


def _short(places: np.ndarray) -> bytes:
    """Two bytes each if that is enough."""
    return places.astype(np.uint16 if places.max(initial=0) < 1 << 16 else np.int32).tobytes()


def _unpacked(parts: list[int], seeds: list[bytes], nodes: list[bytes], places: list[bytes]) -> list[np.ndarray]:
    """Seeds, made of their part and their low bytes, texts and places."""
    out: list[list[np.ndarray]] = [[], [], []]
    for part, s, n, p in zip(parts, seeds, nodes, places):
        whole = np.zeros((len(s) // LOW, 8), np.uint8)
        whole[:, :LOW] = np.frombuffer(s, np.uint8).reshape(-1, LOW)
        out[0].append(whole.view(np.uint64).ravel() | np.uint64(part << 8 * LOW))
        out[1].append(np.frombuffer(n, np.int64))
        out[2].append(np.frombuffer(p, np.uint16 if len(p) == 2 * len(whole) else np.int32).astype(np.int32))
    return [W.concat(c, k) for c, k in zip(out, (np.uint64, np.int64, np.int32))]


def packed_seeds(docs: DataFrame, parts: int, first: int, last: int) -> DataFrame:
    """The seeds of (text, skipped) in the parts from first to last - 1, of so many, as packed arrays by part of their
    hashes; those that wait go to any part.

    A seed is its part and the low LOW bytes of its hash: in a part of a million seeds one in a million falls together
    with another one, whatever the number of parts. Words are compared later on.
    """
    bits = 64 - (parts.bit_length() - 1)
    shift = np.uint64(bits) if parts > 1 else None
    least, most = first << bits, (last << bits) - 1

    def passed_on(held):
        seeds, nodes, places = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(seeds)
        seeds, nodes, places = seeds[order], nodes[order], places[order]
        kinds = _kinds(seeds, nodes, places)
        rows = []
        for kind in (USUAL, ENDS, WAITING):
            at = np.flatnonzero(kinds == kind)
            s, n, p = seeds[at], nodes[at], places[at]
            of = (s >> shift).astype(np.int64) if parts > 1 else np.zeros(len(s), np.int64)
            cuts = _heads(of)
            for k, a, z in zip(of[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(s)]):
                to = (k + int(n[a]) if kind == WAITING else k) % parts
                rows.append((to, k, kind, s[a:z].view(np.uint8).reshape(-1, 8)[:, :LOW].tobytes(), n[a:z].tobytes(), _short(p[a:z])))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["to", "part", "kind", "seeds", "nodes", "places"]
        )

    def run(batches):
        held, size = [], 0
        for b in batches:
            for nodes, owner, places, seeds in _seeds(b, least, most):
                if len(seeds):
                    held.append((seeds, nodes[owner], places.astype(np.int32)))
                    size += len(seeds)
                if size >= GATHERED:
                    yield passed_on(held)
                    held, size = [], 0
        if held:
            yield passed_on(held)

    return docs.select("text", "skipped").mapInArrow(run, _PACKED)


def _joined(rows: pa.Table) -> pa.Table:
    """The seeds of a part that several texts hold, each with its occurrence (other, at) to be matched with.

    Seeds that others wait for also come alone, without node; those that wait come without other.
    """
    kinds = rows["kind"].to_numpy()
    packed = [rows[name].to_pylist() for name in ("part", "seeds", "nodes", "places")]

    def of(*which):
        return _unpacked(*([x for x, k in zip(c, kinds) if k in which] for c in packed))

    usual, asking, late = of(USUAL), of(ENDS), of(WAITING)
    ends = np.repeat([False, True], [len(usual[0]), len(asking[0])])
    seeds, nodes, places = (np.concatenate(c) for c in zip(usual, asking))
    order = np.argsort(seeds)
    same = seeds[order][1:] == seeds[order][:-1]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[: len(same)] |= same
    at = order[again]
    at = at[np.lexsort((places[at], nodes[at], seeds[at]))]
    seeds, nodes, places, ends = seeds[at], nodes[at], places[at], ends[at]
    heads = _heads(seeds)
    n = np.diff(np.append(heads, len(seeds)))
    tails = heads + n - 1
    several = nodes[heads] != nodes[tails]
    keep = np.repeat(several, n)
    other, first = np.repeat(nodes[heads], n), np.repeat(places[heads], n)
    asked = heads[several & (np.add.reduceat(ends, heads, dtype=np.int64) > 0 if len(heads) else several)]
    none, nothing = np.zeros(len(asked), bool), np.zeros(len(late[0]), bool)

    def column(kind, usual, alone, waiting):
        mask = np.concatenate([np.zeros(int(keep.sum()), bool), none if alone is not None else ~none, nothing if waiting is not None else ~nothing])
        values = [usual[keep], alone if alone is not None else none, waiting if waiting is not None else nothing]
        return pa.array(np.concatenate([v.astype(kind) for v in values]), mask=mask)

    return pa.Table.from_arrays(
        [column(np.int64, seeds.view(np.int64), seeds[asked].view(np.int64), late[0].view(np.int64)), column(np.int64, nodes, None, late[1]),
         column(np.int32, places, None, late[2]), column(np.int64, other, nodes[asked], None), column(np.int32, first, places[asked], None)],
        names=["seed", "node", "place", "other", "at"],
    )


def shared_seeds(docs: DataFrame, n_words: int) -> DataFrame:
    """(seed, node, place, other, at): every occurrence of the seeds of (text, skipped) that several texts hold, with the
    occurrence it is matched with; that one is there as well, matched with itself."""
    parts = 1 << max(0, (n_words - 1) // PART).bit_length()
    rounds = min(ROUNDS, parts)
    cuts = [parts * i // rounds for i in range(rounds + 1)]
    rounds = [written_once(packed_seeds(docs, parts, a, z).groupBy("to").applyInArrow(_joined, _SHARED)) for a, z in zip(cuts, cuts[1:])]
    joined = functools.reduce(DataFrame.unionByName, rounds)
    answers = joined.where("node IS NULL").select("seed", "other", "at")
    late = joined.where("other IS NULL").select("seed", "node", "place").join(small_or_shuffled(answers), "seed")
    return joined.where("node IS NOT NULL AND other IS NOT NULL").unionByName(late.select(joined.columns))


class Window:
    """Best (value, item) of a range of ranks among the items held; they leave in the order they came in."""

    def __init__(self, n: int):
        self.n = n
        self.best = [(0.0, -1)] * (2 * n)
        self.held: dict[int, deque] = defaultdict(deque)

    def _update(self, i: int) -> None:
        held = self.held[i]
        i += self.n
        self.best[i] = held[0] if held else (0.0, -1)
        while i > 1:
            i >>= 1
            self.best[i] = max(self.best[2 * i], self.best[2 * i + 1])

    def add(self, i: int, value: float, item: int) -> None:
        held = self.held[i]
        while held and held[-1][0] <= value:
            held.pop()
        held.append((value, item))
        self._update(i)

    def remove(self, i: int, item: int) -> None:
        held = self.held[i]
        if held and held[0][1] == item:
            held.popleft()
            self._update(i)

    def within(self, a: int, z: int) -> tuple[float, int]:
        """Of the ranks from a to z - 1."""
        out, a, z = (0.0, -1), a + self.n, z + self.n
        while a < z:
            if a & 1:
                out = max(out, self.best[a])
                a += 1
            if z & 1:
                z -= 1
                out = max(out, self.best[z])
            a, z = a >> 1, z >> 1
        return out


def runs(place: np.ndarray, other: np.ndarray) -> list[np.ndarray]:
    """Matches near each other on one diagonal, put together: of each run the exact parts, rows of (start, stop,
    other start, other stop)."""
    order = np.lexsort((place, other - place))
    place, other = place[order], other[order]
    apart, step = np.diff(other - place) != 0, np.diff(place)
    heads = np.flatnonzero(np.concatenate([[True], apart | (step > SEED)]))
    tails = np.concatenate([heads[1:], [len(place)]]) - 1
    parts = np.stack([place[heads], place[tails] + SEED, other[heads], other[tails] + SEED], axis=1)
    return np.split(parts, np.flatnonzero(np.concatenate([[True], apart | (step > NEAR)])[heads])[1:])


def chains(place: np.ndarray, other: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Disjoint chains of the matches of two texts, as (start, stop, other start, other stop)."""
    return [(int(p[0, 0]), int(p[-1, 1]), int(p[0, 2]), int(p[-1, 3])) for p in linked(place, other)]


def linked(place: np.ndarray, other: np.ndarray) -> list[np.ndarray]:
    """The exact parts of each chain, in order."""
    joined = sorted(runs(place, other), key=lambda p: p[0, 0])
    if len(joined) == 1:
        return joined
    parts = np.array([(p[0, 0], p[-1, 1], p[0, 2], p[-1, 3]) for p in joined])
    rows = parts.tolist()
    ends = np.unique(parts[:, 3])
    rank, before = np.searchsorted(ends, parts[:, 3]).tolist(), np.searchsorted(ends, parts[:, 2], "right").tolist()
    after = np.searchsorted(ends, parts[:, 2] - MAX_GAP).tolist()
    tree, score, ahead = Window(len(ends)), [0.0] * len(rows), [-1] * len(rows)
    waiting, k, gone = sorted(range(len(rows)), key=lambda i: rows[i][1]), 0, 0
    for i, (start, stop, low, _) in enumerate(rows):
        while k < len(rows) and rows[waiting[k]][1] <= start:
            j = waiting[k]
            tree.add(rank[j], score[j] + GAP_COST * (rows[j][1] + rows[j][3]), j)
            k += 1
        while gone < k and rows[waiting[gone]][1] < start - MAX_GAP:
            tree.remove(rank[waiting[gone]], waiting[gone])
            gone += 1
        value, item = tree.within(after[i], before[i])
        gain = value - GAP_COST * (start + low)
        score[i] = stop - start
        if item >= 0 and gain > 0:
            score[i] += gain
            ahead[i] = item
    out, used = [], [False] * len(rows)
    for i in sorted(range(len(rows)), key=lambda i: -score[i]):
        if used[i]:
            continue
        chain = [i]
        used[i] = True
        while ahead[chain[-1]] >= 0 and not used[ahead[chain[-1]]]:
            chain.append(ahead[chain[-1]])
            used[chain[-1]] = True
        out.append(np.concatenate([joined[j] for j in reversed(chain)]))
    return out


def _groups(batches, keys: list[str], rest: list[str]) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """(key, columns) of each key of a sorted stream."""
    now, held = None, []
    for b in batches:
        if not b.num_rows:
            continue
        key = np.stack([b[c].to_numpy() for c in keys], axis=1)
        columns = [b[c].to_numpy(zero_copy_only=False) for c in rest]
        cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]])
        for a, z in zip(cuts[:-1], cuts[1:]):
            this = tuple(key[a].tolist())
            if this != now and held:
                yield now, [np.concatenate(c) for c in zip(*held)]
                held = []
            now = this
            held.append([c[a:z] for c in columns])
    if held:
        yield now, [np.concatenate(c) for c in zip(*held)]


def _mixed_windows(place: np.ndarray, seed: np.ndarray, other: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the windows of PASSAGE words whose seeds are all shared, but not matched with one stretch of one text.

    A window is matched if its first and last seed are on one diagonal with one text and the seeds there make one run
    that leaves out no more words than IDENTITY allows: such a run is a stretch of a chain. All texts that hold the
    window find the same here, since it follows from its seeds alone.
    """
    if len(place) < WINDOW:
        return place[:0], seed[:0]
    ends, begins = slice(WINDOW - 1, None), slice(None, len(place) - WINDOW + 1)
    away = at.astype(np.int64) - place
    changes = (other[1:] != other[:-1]) | (away[1:] != away[:-1])
    breaks = np.concatenate([[0], np.cumsum(changes)])
    found = np.flatnonzero((place[ends] - place[begins] == WINDOW - 1) & (breaks[ends] != breaks[begins]))
    if not len(found):
        return place[:0], seed[:0]
    hashes = W.grams(seed.view(np.uint64), WINDOW)[found].view(np.int64)
    mixed = np.ones(len(found), bool)
    for a in range(0, len(found), 1024):
        rows = found[a : a + 1024]
        inside = rows[:, None] + np.arange(WINDOW)
        same = (other[inside] == other[rows][:, None]) & (away[inside] == away[rows][:, None])
        before = np.maximum.accumulate(np.where(same, np.arange(WINDOW), 0), axis=1)
        steps = np.where(same[:, 1:], np.arange(1, WINDOW) - before[:, :-1], 0)
        left_out = np.maximum(steps - SEED, 0).sum(axis=1)
        mixed[a : a + 1024] = ~same[:, -1] | (steps.max(axis=1) > NEAR) | (left_out > (1 - IDENTITY) * PASSAGE)
    return place[found[mixed]], hashes[mixed]


def _chain_rows(node: int, place: np.ndarray, other: np.ndarray, at: np.ndarray) -> Iterator[tuple]:
    """The chains of a text with each other text; the matches are in the order of their places."""
    order = np.argsort(other, kind="stable")
    place, other, at = place[order].astype(np.int64), other[order], at[order].astype(np.int64)
    heads = _heads(other)
    tails = np.append(heads[1:], len(other))
    for a, z in zip(heads.tolist(), tails.tolist()):
        if other[a] == node or place[z - 1] + SEED - place[a] < CHAIN:
            continue
        for p in linked(place[a:z], at[a:z]):
            if p[-1, 1] - p[0, 0] >= CHAIN:
                yield (node, p[0, 0], p[-1, 1], int(other[a]), p[0, 2], p[-1, 3], (p - p[0, [0, 0, 2, 2]]).astype(np.int32).tobytes())


def _chained(batches):
    """Chains, and mixed windows as (node, start, stop, hash) without low, high and parts."""
    rows = []
    for (node,), (place, seed, other, at) in _groups(batches, ["node"], ["place", "seed", "other", "at"]):
        once = _heads(place)
        place, seed, other, at = place[once], seed[once], other[once], at[once]
        rows.extend(_chain_rows(node, place, other, at))
        for p, h in zip(*(x.tolist() for x in _mixed_windows(place, seed, other, at))):
            rows.append((node, p, p + PASSAGE, h, None, None, None))
        if len(rows) >= 10_000:
            yield _chain_batch(rows, "parts")
            rows = []
    if rows:
        yield _chain_batch(rows, "parts")


def _chained_windows(batches):
    """Chains of matched windows, each of which stands for the seeds in it."""
    inside = np.append(np.arange(0, WINDOW - 1, SEED), WINDOW - 1)
    rows = []
    for (node, other), (place, at) in _groups(batches, ["node", "other"], ["place", "at"]):
        pairs = np.unique(np.stack([(place[:, None] + inside).ravel(), (at[:, None] + inside).ravel()], axis=1), axis=0)
        rows.extend(_chain_rows(node, pairs[:, 0], np.full(len(pairs), other), pairs[:, 1]))
        if len(rows) >= 10_000:
            yield _chain_batch(rows, "parts")
            rows = []
    if rows:
        yield _chain_batch(rows, "parts")


_CHAIN = "node long, start int, stop int, other long, low int, high int"
_CHAIN_NAMES = ["node", "start", "stop", "other", "low", "high"]


def _chain_batch(rows, *more):
    kinds = [*[pa.int64(), pa.int32(), pa.int32()] * 2, *[pa.binary()] * len(more)]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[*_CHAIN_NAMES, *more]
    )


def _slices(batches):
    """The wanted chains of a text, and its spans in the chains of others (without other, low, high and parts), with their
    word hashes, those of MARGIN words on either side, and how many are before.

    Of an exact chain, which has the same words on both sides, only the words around it.
    """
    for b in batches:
        wanted = b["wanted"].to_pylist()
        for first, last, data, offsets in W.blocks(b["text"]):
            found = W.split(data, offsets)
            hashes = found.hashes()
            nodes = W.sequence_hashes(hashes, found.first).view(np.int64).tolist()
            rows = []
            for k in range(first, last):
                low, high = int(found.first[k - first]), int(found.first[k - first + 1])
                for w in wanted[k]:
                    if w["node"] == nodes[k - first]:
                        a, z = max(low, low + w["start"] - MARGIN), min(high, low + w["stop"] + MARGIN)
                        i, j = low + w["start"], low + w["stop"]
                        words = hashes[a:i].tobytes() + hashes[j:z].tobytes() if w["exact"] else hashes[a:z].tobytes()
                        rows.append((*(w[c] for c in _CHAIN_NAMES), w["parts"], w["exact"], i - a, words))
                    if len(rows) >= 10_000:
                        yield _slice_batch(rows)
                        rows = []
            if rows:
                yield _slice_batch(rows)


_SLICE = _CHAIN + ", parts binary, exact boolean, ahead int, words binary"


def _slice_batch(rows):
    kinds = [*[pa.int64(), pa.int32(), pa.int32()] * 2, pa.binary(), pa.bool_(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], kind) for n, kind in enumerate(kinds)], names=[*_CHAIN_NAMES, "parts", "exact", "ahead", "words"]
    )


def edit_distance(a: list[int], b: list[int]) -> int:
    """Edit distance of two word sequences, the column of the table kept as bits of integers."""
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return len(a) + len(b)
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    mask, top, distance = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down = mask, 0
    for x in b:
        same = where.get(x, 0)
        vertical = same | down
        horizontal = (((same & up) + up) ^ up) | same
        more, less = down | (~(horizontal | up) & mask), up & horizontal
        distance += bool(more & top) - bool(less & top)
        more, less = (more << 1 | 1) & mask, less << 1 & mask
        up, down = less | (~(vertical | more) & mask), more & vertical
    return distance


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def _differing(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) == len(b) and (a == b).all():
        return 0
    return edit_distance(a.tolist(), b.tolist())


def similar_parts(x: np.ndarray, y: np.ndarray, parts: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The longest stretches of a chain, from one exact part to another, that have enough identity.

    x and y are the words of the chain on both sides. Where the whole chain has too little, the edits of a stretch
    are those between its exact parts. Every exact part is in a stretch; stretches may overlap.
    """
    start, stop, low, high = parts.T
    edits = np.zeros(len(parts), np.int64)
    for i in range(1, len(parts)):
        edits[i] = _differing(x[stop[i - 1] : start[i]], y[high[i - 1] : low[i]])
    edits = np.cumsum(edits)
    most = (1 - IDENTITY) * max(len(x), len(y)) + 1e-9
    if edits[-1] <= most or _differing(x, y) <= most:
        return [(0, len(x), 0, len(y))]
    last = np.zeros(len(parts), np.int64)
    for a, z in ((start, stop), (low, high)):
        # Parts i to j are similar if edits[j] - edits[i] <= (1 - IDENTITY) * (z[j] - a[i]): the last such j of each i.
        least = np.minimum.accumulate((edits - (1 - IDENTITY) * z)[::-1])[::-1]
        last = np.maximum(last, np.searchsorted(least, edits - (1 - IDENTITY) * a + 1e-9, "right") - 1)
    reach = np.maximum.accumulate(last)
    firsts = np.flatnonzero(np.concatenate([[True], reach[1:] > reach[:-1]]))
    return [(int(start[i]), int(stop[last[i]]), int(low[i]), int(high[last[i]])) for i in firsts]


def _aligned(batches):
    """Chains, or their parts with enough identity, extended over their ends."""
    for b in batches:
        names = ("node", "start", "other", "low", "stop", "high", "exact", "parts", "ahead", "words", "other_ahead", "other_words")
        rows = []
        for node, start, other, low, stop, high, exact, parts, ahead, ours, other_ahead, theirs in zip(*(b[c].to_pylist() for c in names)):
            x, y = np.frombuffer(ours, np.uint64), np.frombuffer(theirs, np.uint64)
            if exact:
                left, right = _common(x[:ahead][::-1], y[:other_ahead][::-1]), _common(x[ahead:], y[other_ahead:])
                if stop - start + left + right >= CHAIN:
                    rows.append((node, start - left, stop + right, other, low - left, high + right))
                continue
            inner, outer = x[ahead : ahead + stop - start], y[other_ahead : other_ahead + high - low]
            for a, z, c, e in similar_parts(inner, outer, np.frombuffer(parts, np.int32).reshape(-1, 4)):
                i, j = ahead + a, other_ahead + c
                left = _common(x[max(0, i - MARGIN) : i][::-1], y[max(0, j - MARGIN) : j][::-1])
                i, j = ahead + z, other_ahead + e
                right = _common(x[i : i + MARGIN], y[j : j + MARGIN])
                if z - a + left + right >= CHAIN:
                    rows.append((node, start + a - left, start + z + right, other, low + c - left, low + e + right))
        if rows:
            yield _chain_batch(rows)


def merged(spans: list[tuple[int, int]], bridge: int) -> list[tuple[int, int]]:
    """Sorted spans put together over gaps of at most so many words."""
    out: list[tuple[int, int]] = []
    for a, z in spans:
        if out and a <= out[-1][1] + bridge:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


_PASSAGES = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _passages(batches):
    rows = []

    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([[{"start": a, "stop": z} for a, z in r[1]] for r in rows], _PASSAGES),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.list_(pa.int64()))],
            names=["node", "passages", "copied", "others"],
        )

    for (node,), (start, stop, copy, other) in _groups(batches, ["node"], ["start", "stop", "copy", "other"]):
        spans = list(zip(start.tolist(), stop.tolist()))
        long = [p for p in merged(spans, BRIDGE) if p[1] - p[0] >= PASSAGE]
        if not long:
            continue
        own = merged([s for s, c in zip(spans, copy) if c], 0)
        copied = sum(max(0, min(z, y) - max(a, b)) for a, z in long for b, y in own)
        others = {o for (b, y), o in zip(spans, other.tolist()) if any(a <= b and y <= z for a, z in long)}
        rows.append((node, long, copied, sorted(others)))
        if len(rows) >= 10_000:
            yield batch()
            rows.clear()
    if rows:
        yield batch()


def repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, passages (spans of words that other documents share),
    n_repeated (words in them), n_copied (those of them that a kept text elsewhere has: cutting
    these leaves one occurrence), shared_with (ids of documents that hold the occurrences matched
    with them; of the many that may share a kept occurrence, one for each span), class_id (the smallest id
    of all documents that are linked by a match within a passage, directly or over others, or are copies of 50
    words or more; its own id for a document without links). Any two different texts with a window of 50 words in common
    are in one class, whichever occurrences were matched."""
    docs = picked(docs, doc_id=id_column, text=text_column)
    texts = written_once(texts_of(docs))
    classes = written_once(texts.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("n > 1"))
    copies = texts.join(small_or_shuffled(classes), "node").where(~F.col("doc_id").eqNullSafe(F.col("rep")))
    skip = written_once(copies.groupBy("doc_id").agg(F.collect_set("node").alias("skipped")).withColumnRenamed("doc_id", "skip_id"))
    skip = small_or_shuffled(skip, "skipped")
    ours = docs.join(skip, docs["doc_id"].eqNullSafe(skip["skip_id"]), "left").select("doc_id", "text", "skipped")

    before = written_folders(docs.sparkSession)
    shared = shared_seeds(ours, texts.agg(F.sum("n_words")).first()[0] or 0)
    seeds = [folder for folder in written_folders(docs.sparkSession) if folder not in before]
    matched = written_once(shared.repartition("node").sortWithinPartitions("node", "place").mapInArrow(_chained, _CHAIN + ", parts binary"))
    drop_folders(docs.sparkSession, seeds)  # only the matching reads them
    windows = matched.where("low IS NULL").select(F.col("other").alias("seed"), "node", F.col("start").alias("place"))
    first = windows.groupBy("seed").agg(F.min(F.struct("node", "place")).alias("first"), F.max("node").alias("last"))
    first = written_once(first.where("first.node < last").select("seed", F.col("first.node").alias("other"), F.col("first.place").alias("at")))
    matches = windows.join(small_or_shuffled(first), "seed").where("node <> other").select("node", "other", "place", "at")
    long = matches.repartition("node").sortWithinPartitions("node", "other", "place").mapInArrow(_chained_windows, _CHAIN + ", parts binary")
    found = written_once(matched.where("low IS NOT NULL").unionByName(long))
    # A chain of one exact part is a copy already; its words are needed around it only.
    found = found.withColumn("exact", F.length("parts") == ONE_PART)

    spans = found.select(F.col("other").alias("node"), F.col("low").alias("start"), F.col("high").alias("stop"), "exact").distinct()
    spans = found.unionByName(spans, allowMissingColumns=True)
    holders = written_once(
        texts.join(classes.select("node", "rep"), "node", "left").where("node IS NOT NULL")
        .select("node", F.coalesce("rep", "doc_id").alias("holder")).distinct()
    )
    stretch = F.expr(f"start div {STRETCH}").alias("stretch")
    wanted = spans.join(holders, "node").groupBy("holder", stretch).agg(F.collect_list(F.struct(*spans.columns)).alias("wanted"))
    wanted = small_or_shuffled(written_once(wanted), "wanted")
    words = written_once(docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["holder"])).select("text", "wanted").mapInArrow(_slices, _SLICE))
    theirs = words.where("other IS NULL").select(
        F.col("node").alias("other"), F.col("start").alias("low"), F.col("stop").alias("high"), "exact",
        F.col("ahead").alias("other_ahead"), F.col("words").alias("other_words"),
    )
    theirs = written_once(theirs.dropDuplicates(["other", "low", "high", "exact"]))
    ours = words.where("other IS NOT NULL")
    fuzzy = written_once(ours.join(theirs, ["other", "low", "high", "exact"]).mapInArrow(_aligned, _CHAIN))

    kept = fuzzy.select(
        F.col("other").alias("node"), F.col("low").alias("start"), F.col("high").alias("stop"), F.lit(False).alias("copy"),
        F.col("node").alias("other"),
    )
    parts = fuzzy.select("node", "start", "stop", F.lit(True).alias("copy"), "other").unionByName(kept)
    parts = parts.groupBy("node", "start", "stop", "copy").agg(F.min("other").alias("other"))
    of_node = written_once(
        parts.repartition("node").sortWithinPartitions("node", "start", "stop").mapInArrow(
            _passages, "node long, passages array<struct<start:int,stop:int>>, copied long, others array<long>"
        )
    )
    shared_with = (
        of_node.select(F.col("node").alias("of"), F.explode("others").alias("node")).join(holders, "node")
        .groupBy(F.col("of").alias("node")).agg(F.collect_set("holder").alias("shared_with"))
    )
    # Spans name one partner each; the classes take every match within a passage.
    within = F.exists("passages", lambda x: (x["start"] <= F.col("start")) & (F.col("stop") <= x["stop"]))
    matches = fuzzy.join(of_node.select("node", "passages"), "node").where(within).select(F.col("node").alias("a"), F.col("other").alias("b"))
    linked_to = stars(of_node.select(F.col("node").alias("a"), F.explode("others").alias("b")).unionByName(matches))
    members = linked_to.unionByName(linked_to.select(F.col("b").alias("a"), "b").distinct())
    members = written_once(members.join(holders, F.col("a") == F.col("node")).select("node", "b", "holder"))
    least = members.groupBy("b").agg(F.min("holder").alias("class_id"))
    classed = members.select("node", "b").distinct().join(least, "b").select("node", "class_id")
    known = of_node.drop("others").join(shared_with, "node", "left").join(classes, "node", "full")
    known = written_once(known.join(classed, "node", "full"))
    all_of_it = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("stop")))
    none = F.array().cast("array<struct<start:int,stop:int>>")
    copy = F.coalesce(F.col("n") > 1, F.lit(False)) & (F.col("n_words") >= PASSAGE)
    later = copy & ~F.col("doc_id").eqNullSafe(F.col("rep"))
    nobody = F.array().cast(T.ArrayType(docs.schema["doc_id"].dataType))
    twin = F.when(copy, F.array(F.when(later, F.col("rep")).otherwise(F.col("last")))).otherwise(nobody)
    out = texts.join(small_or_shuffled(known, "passages"), "node", "left").select(
        "doc_id", "n_words",
        F.array_sort(F.array_compact(F.array_union(F.coalesce("shared_with", nobody), twin))).alias("shared_with"),
        F.when(copy, all_of_it).otherwise(F.coalesce("passages", none)).alias("passages"),
        F.when(later, F.col("n_words")).otherwise(F.coalesce("copied", F.lit(0))).alias("n_copied"),
        F.coalesce("class_id", F.when(copy, F.col("rep")), "doc_id").alias("class_id"),
    )
    size = F.aggregate("passages", F.lit(0).cast("long"), lambda acc, x: acc + x["stop"] - x["start"])
    return out.select("doc_id", "n_words", "passages", size.alias("n_repeated"), "n_copied", "shared_with", "class_id")


def op7_substring_dedup(spark, folder: str) -> DataFrame:
    """doc_id, n_words, n_repeated, n_copied, shared_with, passages (start:stop of words, comma-joined), class_id of
    every row of documents with a passage."""
    found = repeated_passages(table(spark, folder, "documents")).where("n_repeated > 0")
    listed = F.array_join(F.transform("passages", lambda x: F.concat_ws(":", x["start"], x["stop"])), ",")
    return found.select("doc_id", "n_words", "n_repeated", "n_copied", "shared_with", listed.alias("passages"), "class_id")
