"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

Words are found through an index of grams of variable length. A word gets a mark at either end. The
gram dictionary counts all grams of SHORTEST to LONGEST code points of all words in a table of
counters of fixed size; a gram that occurs often is not used itself but made longer, until it is
rare enough, LONGEST long or at the end of the word. So a word has one gram at each place, and the
gram depends on its own code points only.

One edit affects the grams that cover its place, for each word at most `bound` of them (the largest
number of grams over one place). A near word shares all others, so of the two words' grams, taken
from the rarest on, their first shared one is among the first bound + 1 of both. Lists hold words
under those grams, by length and, for words of equal length, by place. Within a list two words are
compared if neither lacks more of the other's grams than its bound, which the bits of their gram
sets tell, and then letter by letter. A pair is kept in the list of its first shared gram only.

A list longer than LIST words is cut into blocks by a hash of the word, and every two blocks are a list
of their own, so no list is one task's work.

A null or blank text has no words, repeated rows count as often as they occur, and a null id is an
empty text. Ties of the most frequent near word go to the smallest in code-point order. An empty table
gives an empty result. Columns other than those named are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.llm import words as W
from concord.llm.frames import picked, small_or_shuffled, table, written

SHORTEST, LONGEST = 3, 5
#: Shortest words for which one edit always leaves a gram: the first and the last gram do not meet.
LEAST_LENGTH = LONGEST + 1
#: Counters of the dictionary (16 MB), and those passed on together.
COUNTERS = 1 << 22
PART = 1 << 16
#: A gram that occurs more often is made longer; in large vocabularies twice the mean of the counters counts instead.
FREQUENT = 100
#: Words of a list that a task compares with each other.
LIST = 4096
#: Pairs looked at together, and code points of words decomposed together.
PAIRS = 1 << 20
POINTS = 1 << 20
#: Bytes of text whose words are counted together.
BLOCK = 1 << 22

_FACTORS = W.seeded(12, LONGEST) | np.uint64(1)
_START, _END = "\x01", "\x02"


# Words of texts -------------------------------------------------------------------------

#: The table of crc32, from its polynomial.
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)

# Fixed value: the bytes of the letters A-Z and a-z, and the first byte of U+00C0 to U+00FF.
_LEAD = 0xC3
_IN_RUN = np.zeros(256, bool)
_IN_RUN[[*range(65, 91), *range(97, 123), _LEAD]] = True


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[W.Words, np.ndarray]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF in a block of texts, and their code points."""
    lead = data == _LEAD
    marked = data.copy()
    marked[1:][lead[:-1]] = _LEAD
    found = W.split(marked, offsets, _IN_RUN)
    found.data = data
    leads = np.concatenate([[0], np.cumsum(lead)])
    return found, found.ends - found.starts - (leads[found.ends] - leads[found.starts])


def checksums(before: np.ndarray, lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of each run behind text whose crc32 is given."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    state = before[order] ^ np.uint32(0xFFFFFFFF)
    at, sizes = starts[order], sizes[order]
    long = int(np.searchsorted(-sizes, -256, "left"))
    for k in range(long):
        state[k] = zlib.crc32(lower[at[k] : at[k] + sizes[k]].tobytes(), int(before[order[k]])) ^ 0xFFFFFFFF
    for k in range(int(sizes[long]) if long < len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -k, "left"))
        here = state[long:n]
        state[long:n] = _CRC[(here ^ lower[at[long:n] + k]) & 255] ^ (here >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def word_counts(docs: DataFrame, shortest: int, least: int, altered: int | None = None) -> DataFrame:
    """(word, n): words of at least so many code points and occurrences in (doc_id, text).

    altered: where crc32 of `<doc_id>:<word>` is a multiple of it, the word loses the code point at
    that checksum modulo its length, in all its occurrences in the row.
    """

    def counted(ids: list[str], data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch | None:
        found, length = letter_runs(data, offsets)
        row = np.repeat(np.arange(len(ids)), found.counts)
        keep = length >= shortest
        if not keep.any():
            return None
        row, length, starts, ends = row[keep], length[keep], found.starts[keep], found.ends[keep]
        lower = W.LOWER[data]
        raw = lower.tobytes()
        changed: dict[bytes, int] = {}
        if altered:
            before = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
            crc = checksums(before[row], lower, starts, ends).astype(np.int64)
            hit = crc % altered == 0
            for a, z, h, n in zip(*(x[hit].tolist() for x in (starts, ends, crc, length))):
                if n > shortest:
                    word = raw[a:z].decode()
                    word = (word[: h % n] + word[h % n + 1 :]).encode()
                    changed[word] = changed.get(word, 0) + 1
            starts, ends = starts[~hit], ends[~hit]
        hashes = W.Words(lower, starts, ends, found.first).hashes()
        _, at, n = np.unique(hashes, return_index=True, return_counts=True)
        words = [raw[a:z] for a, z in zip(starts[at].tolist(), ends[at].tolist())] + list(changed)
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()).cast(pa.string()), pa.array(np.append(n, np.array(list(changed.values()), np.int64)), pa.int64())],
            names=["word", "n"],
        )

    def run(batches):
        for b in batches:
            for i, j, data, offsets in W.blocks(b["text"], BLOCK):
                if (out := counted(b["id"][i:j].to_pylist(), data, offsets)) is not None:
                    yield out

    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counts = named.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


# Grams ----------------------------------------------------------------------------------


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the list, matrix of the code points between marks) for words of one length."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        same = np.flatnonzero(sizes == size)
        step = max(1, POINTS // int(size + 2))
        for i in range(0, len(same), step):
            part = same[i : i + step]
            text = "".join(f"{_START}{words[k]}{_END}" for k in part)
            yield part, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(part), -1).astype(np.uint64)


def gram_hashes(points: np.ndarray, size: int) -> np.ndarray:
    n = points.shape[1] - size + 1
    sums = np.full((len(points), n), size * 0x51ED2701, np.uint64)
    for k in range(size):
        sums += (points[:, k : k + n] + np.uint64(1)) * _FACTORS[k]
    return W.mix(sums)


def gram_dictionary(words: DataFrame) -> np.ndarray:
    """Counters of all grams by hash. What passes the driver is of fixed size."""

    def run(batches):
        counts = np.zeros(COUNTERS, np.int32)
        for b in batches:
            for _, points in by_length(b["word"].to_pylist()):
                for size in range(SHORTEST, min(LONGEST, points.shape[1]) + 1):
                    where = (gram_hashes(points, size) & np.uint64(COUNTERS - 1)).astype(np.int64)
                    counts += np.bincount(where.ravel(), minlength=COUNTERS).astype(np.int32)
        full = [k for k in range(COUNTERS // PART) if counts[k * PART : (k + 1) * PART].any()]
        for k in full:
            yield pa.RecordBatch.from_pydict({"part": pa.array([k]), "counts": pa.array([counts[k * PART : (k + 1) * PART].tobytes()])})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(PART, np.int64)
        for x in pdf["counts"]:
            total += np.frombuffer(x, np.int32)
        total = np.minimum(total, np.iinfo(np.int32).max).astype(np.int32)
        return pd.DataFrame({"part": pdf["part"][:1], "counts": [total.tobytes()]})

    out = np.zeros(COUNTERS, np.int32)
    parts = words.select("word").mapInArrow(run, "part long, counts binary").groupBy("part").applyInPandas(added, "part long, counts binary")
    for part, counts in parts.collect():
        out[part * PART : (part + 1) * PART] = np.frombuffer(counts, np.int32)
    return out


@dataclass
class Grams:
    """Grams of words of one length, a row for each word, the rarest first."""

    hashes: np.ndarray
    places: np.ndarray
    sizes: np.ndarray
    bits: np.ndarray
    bound: np.ndarray


def decompose(points: np.ndarray, counters: np.ndarray, frequent: float) -> Grams:
    """The gram at each place of each word."""

    def count(hashes):
        return counters[(hashes & np.uint64(COUNTERS - 1)).astype(np.int64)]

    rows, n = points.shape
    hashes = gram_hashes(points, SHORTEST)
    sizes = np.full(hashes.shape, SHORTEST)
    counts = count(hashes)
    for size in range(SHORTEST + 1, min(LONGEST, n) + 1):
        longer = gram_hashes(points, size)
        m = longer.shape[1]
        grow = (sizes[:, :m] == size - 1) & (counts[:, :m] > frequent)
        hashes[:, :m] = np.where(grow, longer, hashes[:, :m])
        counts[:, :m] = np.where(grow, count(longer), counts[:, :m])
        sizes[:, :m] += grow
    places = np.broadcast_to(np.arange(hashes.shape[1]), hashes.shape)
    over = np.zeros((rows, n + 1), np.int64)
    over[:, : hashes.shape[1]] += 1
    for size in range(SHORTEST, LONGEST + 1):
        i, p = np.nonzero(sizes == size)
        over[i, p + size] -= 1  # one gram of a size ends at a place
    bound = np.cumsum(over, axis=1)[:, 1 : n - 1].max(axis=1)
    bits = np.bitwise_or.reduce(np.uint64(1) << (hashes >> np.uint64(58)), axis=1)
    # The order is one of grams: how often they occur, then their hash; equal grams of a word go by place.
    order = np.lexsort((places, hashes, counts))
    return Grams(*(np.take_along_axis(x, order, 1) for x in (hashes, places, sizes)), bits, bound)


#: Kinds of lists: words of equal length, the shorter and the longer of two lengths.
EQUAL, SHORT, LONG = range(3)


def postings(words: DataFrame, counters, frequent: float) -> DataFrame:
    """(list, kind, word, n, bits, bound, grams) of each word under each of its first grams.

    grams: place and size of the word's grams up to this one, in order, as 32-bit numbers.
    """
    names = ["list", "kind", "word", "n", "bits", "bound", "grams"]

    def run(batches):
        for b in batches:
            words, n = b["word"].to_pylist(), b["n"].to_numpy()
            for where, points in by_length(words):
                g = decompose(points, counters.value, frequent)
                rank = np.arange(g.hashes.shape[1])
                i, k = np.nonzero(rank <= g.bound[:, None])
                layout = (g.places * 8 + g.sizes).astype("<u4")
                raw, width = layout.tobytes(), 4 * layout.shape[1]
                at = (i * width).tolist()
                grams = pa.array([raw[a : a + 4 * z] for a, z in zip(at, (k + 1).tolist())], pa.binary())
                length = np.uint64(points.shape[1])
                taken, hashes = pa.array(where[i]), g.hashes[i, k]
                for kind in (EQUAL, SHORT, LONG):
                    salt = length - np.uint64(kind == LONG) + np.uint64(0 if kind == EQUAL else 1 << 40)
                    key = W.mix(hashes + W.mix(salt + (g.places[i, k].astype(np.uint64) << np.uint64(20) if kind == EQUAL else np.uint64(0))))
                    columns = [
                        pa.array(key.view(np.int64)), pa.array(np.full(len(i), kind, np.int32)), b["word"].take(taken), pa.array(n[where[i]], pa.int64()),
                        pa.array(g.bits[i].view(np.int64)), pa.array(g.bound[i].astype(np.int32)), grams,
                    ]
                    for at_row in range(0, len(i), 20_000):
                        yield pa.RecordBatch.from_arrays([c.slice(at_row, 20_000) for c in columns], names=names)

    return words.select("word", "n").mapInArrow(run, "list long, kind int, word string, n long, bits long, bound int, grams binary")


# Lists ----------------------------------------------------------------------------------


def cells(entries: DataFrame, limit: int) -> DataFrame:
    """The entries with the block of each (own) and the two blocks of their cell (low, high).

    Lists of up to `limit` words are one cell. A longer one, whose shorter and longer words count
    together, has a cell for every two of its blocks, and each of its words goes to those of its block.
    """
    size = written(entries.groupBy("list").agg(F.count("*").alias("size")).where(F.col("size") > limit))
    blocks = F.coalesce(F.ceil(F.col("size") / limit), F.lit(1)).cast("int")
    dealt = entries.join(small_or_shuffled(size), "list", "left").withColumn("blocks", blocks)
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("list", "kind", "word", "n", "bits", "bound", "grams", "own", other)
    return dealt.select(
        "list", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own",
        "kind", "word", "n", "bits", "bound", "grams",
    )


def pair_chunks(group: np.ndarray, kind: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows in blocks: every two of a group of equal words, every shorter and longer of the others.

    Rows are sorted by group, then kind.
    """
    n = len(group)
    stop = np.searchsorted(group, group, "right")
    start = np.arange(1, n + 1)
    firsts = np.searchsorted(2 * group + (kind == LONG), 2 * group + 1, "left")
    start = np.where(kind == SHORT, firsts, start)
    counts = np.where(kind == LONG, 0, stop - start)
    ends = np.cumsum(counts)
    i = 0
    while i < n:
        base = ends[i] - counts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
        some = counts[i:j]
        left = np.repeat(np.arange(i, j), some)
        yield left, np.repeat(start[i:j], some) + np.arange(len(left)) - np.repeat(np.cumsum(some) - some, some)
        i = j


def same_ends(points: np.ndarray, first: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many code points rows i and j have in common from the start, and from the end."""
    out = []
    for at_i, at_j, step in ((first[i], first[j], 1), (first[i] + size[i] - 1, first[j] + size[j] - 1, -1)):
        shared, most = np.zeros(len(i), np.int64), np.minimum(size[i], size[j])
        left, k = np.arange(len(i)), 0
        while len(left):
            left = left[most[left] > k]
            left = left[points[at_i[left] + step * k] == points[at_j[left] + step * k]]
            shared[left] += 1
            k += 1
        out.append(shared)
    return out[0], out[1]


def near_in_lists(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of near words of whole cells, each in the list of its first shared gram only."""
    keys = [rows[c].to_numpy() for c in ("list", "low", "high")]
    group = np.cumsum(np.concatenate([[0], np.any([np.diff(k) != 0 for k in keys], axis=0)]))
    kind, own = rows["kind"].to_numpy(), rows["own"].to_numpy()
    across = keys[1] != keys[2]
    bits, bound = rows["bits"].to_numpy().view(np.uint64), rows["bound"].to_numpy()
    left, right = [], []
    for i, j in pair_chunks(group, kind):
        lacks = (np.bitwise_count(bits[i] & ~bits[j]) <= bound[i]) & (np.bitwise_count(bits[j] & ~bits[i]) <= bound[j])
        lacks &= ~across[i] | (own[i] != own[j])
        left.append(i[lacks])
        right.append(j[lacks])
    i, j = W.concat(left, np.int64), W.concat(right, np.int64)
    words = rows["word"].to_pylist()
    size = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    first = np.cumsum(size) - size
    head, tail = same_ends(points, first, size, i, j)
    near = (head + tail >= np.maximum(size[i], size[j]) - 1) & ((size[i] != size[j]) | (head < size[i]))
    i, j, head, tail = i[near], j[near], head[near], tail[near]
    return _in_first_list(rows["grams"].combine_chunks(), i, j, size, head, tail)


def _in_first_list(grams: pa.Array, i, j, size, head, tail) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose list is that of their first shared gram, by the grams of i up to this one.

    Place 0 is the mark at the start. A gram is shared if it lies in what both words have in common
    before the edit, or behind it.
    """
    if isinstance(grams, pa.ChunkedArray):
        grams = grams.chunk(0)
    offsets = np.frombuffer(grams.buffers()[1], np.int32)[grams.offset : grams.offset + len(grams) + 1] // 4
    layout = np.frombuffer(grams.buffers()[2], "<u4") if grams.buffers()[2] is not None else np.zeros(0, "<u4")
    count = np.diff(offsets)
    earlier = count[i] - 1
    owner = np.repeat(np.arange(len(i)), earlier)
    at = np.repeat(offsets[:-1][i], earlier) + np.arange(len(owner)) - np.repeat(np.cumsum(earlier) - earlier, earlier)
    before = np.bincount(owner, weights=_shared(layout[at], owner, i, size, head, tail), minlength=len(i))
    # This gram is shared where the other word has it; one that fits either way counts as before the edit.
    last_i, last_j = layout[offsets[1:][i] - 1], layout[offsets[1:][j] - 1]
    pairs = np.arange(len(i))
    shift = (last_j >> 3).astype(np.int64) - (last_i >> 3).astype(np.int64)
    ahead = _before(last_i, pairs, head)
    here = np.where(ahead, shift == 0, _behind(last_i, pairs, i, size, tail) & (shift == size[j] - size[i]))
    keep = (before == 0) & here
    return i[keep], j[keep]


def _before(layout, owner, head):
    """Whether a gram ends within the start in common (with the mark)."""
    return (layout >> 3).astype(np.int64) + (layout & 7).astype(np.int64) <= head[owner] + 1


def _behind(layout, owner, i, size, tail):
    """Whether a gram starts within the end in common (with the mark)."""
    return (layout >> 3).astype(np.int64) >= size[i[owner]] + 1 - tail[owner]


def _shared(layout, owner, i, size, head, tail):
    return _before(layout, owner, head) | _behind(layout, owner, i, size, tail)


def near_words(words: DataFrame, limit: int = LIST) -> DataFrame:
    """(word, near, near_n) for every two near words of (word, n), in both directions, each once."""
    spark = words.sparkSession
    counters = gram_dictionary(words)
    frequent = max(FREQUENT, 2 * float(counters.mean()))
    sent = spark.sparkContext.broadcast(counters)  # COUNTERS numbers, whatever the size of the input
    entries = written(postings(words, sent, frequent))
    keys = ["list", "low", "high"]

    def run(batches):
        held = None
        for b in batches:
            here = pa.Table.from_batches([b])
            here = here if held is None else pa.concat_tables([held, here]).combine_chunks()
            last = [here[k][-1].as_py() for k in keys]
            same = np.all([here[k].to_numpy() == x for k, x in zip(keys, last)], axis=0)
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            held = here.slice(cut)
            if cut:
                yield from found(here.slice(0, cut))
        if held is not None:
            yield from found(held)

    def found(rows: pa.Table):
        i, j = near_in_lists(rows.combine_chunks())
        if len(i):
            words, n = rows["word"].combine_chunks(), rows["n"].to_numpy()
            a, z = np.append(i, j), np.append(j, i)
            out = pa.table({"word": words.take(pa.array(a)), "near": words.take(pa.array(z)), "near_n": pa.array(n[z])})
            yield from out.combine_chunks().to_batches()

    dealt = cells(entries, limit).repartition(*keys).sortWithinPartitions(*keys, "kind")
    return dealt.mapInArrow(run, "word string, near string, near_n long")


# Forms ----------------------------------------------------------------------------------


def spelling_forms(words: DataFrame, times: int = 10, limit: int = LIST) -> DataFrame:
    """words: a written table (word, n) of distinct words of LEAST_LENGTH code points or more.

    Returns word, n, n_near, form, form_n, root: the near word of largest n if it occurs `times` as
    often, and where following such forms ends.
    """
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near")))
    near = near_words(words, limit).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    is_form = -F.col("best.n") >= times * F.col("n")
    forms = written(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n"),
        )
    )
    steps = forms.where("form IS NOT NULL").select(F.col("word").alias("root"), F.col("form").alias("next"))
    moving, ended = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), []
    # A form occurs more often by a factor, so as many rounds as the counts have digits are enough.
    while True:
        moved = written(moving.join(steps, "root", "left"))
        ended.append(moved.where("next IS NULL").select("word", "root"))
        moving = moved.where("next IS NOT NULL").select("word", F.col("next").alias("root"))
        if moving.isEmpty():
            break
    roots = ended[0]
    for more in ended[1:]:
        roots = roots.unionByName(more)
    return forms.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame, shortest: int = 7, least: int = 2, times: int = 10, altered: int | None = None,
    id_column: str = "doc_id", text_column: str = "text", limit: int = LIST,
) -> DataFrame:
    """The words of documents with their near words, forms and roots."""
    if shortest < LEAST_LENGTH:
        raise ValueError(f"words need {LEAST_LENGTH} code points or more")
    if times < 2:
        raise ValueError("a form must occur more often than the word")
    words = written(word_counts(picked(docs, doc_id=id_column, text=text_column), shortest, least, altered))
    return spelling_forms(words, times, limit)


def op12_spelling(spark, folder: str) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of documents; one word in 31 of a row lacks a letter."""
    return spelling_variants(table(spark, folder, "documents"), altered=31).select("word", "form", "root", "n", "n_near", "form_n")


OP12_SQL = """
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) r(i))
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL
), bytes AS (
  SELECT run, n, hex(encode(id || ':' || run)) AS h FROM counted
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(h), 2), lambda k: 16 * (instr('0123456789ABCDEF', h[k]) - 1) + instr('0123456789ABCDEF', h[k + 1]) - 1)),
    lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256))) AS h
  FROM bytes, crc
), w AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2
), cut AS (
  SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM w)
), near AS (
  SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN w b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS form, max(n) AS form_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form, CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
  FROM w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, form AS root FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON walk.root = forms.word WHERE forms.form IS NOT NULL
), last AS (
  SELECT walk.word, walk.root FROM walk JOIN forms ON walk.root = forms.word WHERE forms.form IS NULL
)
SELECT word, form, coalesce(root, word) AS root, CAST(n AS BIGINT) AS n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM forms LEFT JOIN last USING (word)
"""
