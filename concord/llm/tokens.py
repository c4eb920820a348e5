"""Token counts that follow edits.

A byte-level BPE splits a text into pre-tokens by an expression and encodes each on its own, so a
text's count is the sum over its pre-tokens. A document keeps a segment tree over leaves of LEAF
pre-tokens with their characters and tokens. An edit finds its leaves by the sums of characters,
and only they are split and encoded again, with the text before as boundary context: from a leaf
that starts MARGIN characters or more ahead of the edit (the expression looks no further ahead), up
to a leaf that starts where a new pre-token ends. From there on the splits are the old ones, since
the expression never looks back. Then the sums above the leaves are updated.

Edits are (start, stop, text) in characters (code points), applied in order, each to the result of
those before; positions beyond the text are moved to its end, a stop before the start counts as the
start, null edits are none and a null text is empty. A null document is an empty one. Rows repeated
in full each get their counts; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.frames import fields, picked, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public expression that the vocabulary's pre-tokens are split by.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 64
#: Characters that the expression may look at beyond the end of a pre-token, and one more.
MARGIN = 3
#: Pre-tokens whose counts a worker remembers.
REMEMBERED = 300_000


class Counter(dict):
    """The number of tokens of a pre-token, remembered."""

    def __init__(self, vocabulary: bytes, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        n = self[piece] = len(self.encoding.encode_ordinary(piece))
        return n

    def tokens(self, pieces: list[str]) -> int:
        return sum(map(self.__getitem__, pieces))


_counters: dict[tuple[int, str], Counter] = {}


def counter(vocabulary: bytes, pattern: str) -> Counter:
    """One counter for each vocabulary of a worker."""
    key = (hash(vocabulary), pattern)
    if key not in _counters:
        _counters[key] = Counter(vocabulary, pattern)
    return _counters[key]


class TokenTree:
    """Sums of characters and tokens over the leaves of a text."""

    def __init__(self, texts: list[str], tokens: list[int], count: Counter):
        self.count = count
        self.recoded = 0
        self.set_leaves(texts, tokens)

    @classmethod
    def of(cls, text: str, count: Counter) -> TokenTree:
        texts, tokens = leaves(count.split(text), count)
        return cls(texts, tokens, count)

    @classmethod
    def stored(cls, text: str, chars: list[int], tokens: list[int], count: Counter) -> TokenTree:
        texts, at = [], 0
        for n in chars:
            texts.append(text[at : at + n])
            at += n
        return cls(texts, tokens, count)

    def set_leaves(self, texts: list[str], tokens: list[int]) -> None:
        self.size = 1 << max(0, len(texts) - 1).bit_length()
        spare = self.size - len(texts)
        self.texts = texts + [""] * spare
        self.chars = [0] * self.size + [len(t) for t in self.texts]
        self.sums = [0] * self.size + tokens + [0] * spare
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def length(self) -> int:
        return self.chars[1]

    @property
    def tokens(self) -> int:
        return self.sums[1]

    @property
    def text(self) -> str:
        return "".join(self.texts)

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one with any, for the end), and where it starts."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if place - start >= self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.size, start

    def set_leaf(self, leaf: int, text: str, tokens: int) -> None:
        node = leaf + self.size
        self.texts[leaf], self.chars[node], self.sums[node] = text, len(text), tokens
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def next_leaf(self, leaf: int) -> int:
        """The next leaf with text, or the number of leaves."""
        leaf += 1
        while leaf < self.size and not self.texts[leaf]:
            leaf += 1
        return leaf

    def edit(self, start: int, stop: int, text: str) -> None:
        start = min(max(start, 0), self.length)
        stop = min(max(stop, start), self.length)
        first, begin = self.leaf_at(max(0, start - MARGIN))
        last, last_begin = self.leaf_at(stop)
        old = "".join(self.texts[first : last + 1])
        new = old[: start - begin] + text + old[stop - begin :]
        after = self.next_leaf(last)
        while True:
            ahead, at = [], after
            while at < self.size and sum(map(len, ahead)) < MARGIN:
                ahead.append(self.texts[at])
                at = self.next_leaf(at)
            pieces, done = [], 0
            for piece in self.count.split(new + "".join(ahead)):
                if done >= len(new):
                    break
                pieces.append(piece)
                done += len(piece)
            if done == len(new):
                break
            new += self.texts[after]
            last, after = after, self.next_leaf(after)
        self.recoded += len(new)
        if len(pieces) > 8 * LEAF:
            texts, tokens = leaves(pieces, self.count)
            keep = [i for i in range(self.size) if self.texts[i] and not first <= i <= last]
            old_tokens = self.sums[self.size :]
            head, tail = [i for i in keep if i < first], [i for i in keep if i > last]
            self.set_leaves(
                [self.texts[i] for i in head] + texts + [self.texts[i] for i in tail],
                [old_tokens[i] for i in head] + tokens + [old_tokens[i] for i in tail],
            )
            return
        self.set_leaf(first, new, self.count.tokens(pieces))
        for leaf in range(first + 1, last + 1):
            if self.texts[leaf]:
                self.set_leaf(leaf, "", 0)


def leaves(pieces: list[str], count: Counter) -> tuple[list[str], list[int]]:
    """Texts and token counts of runs of LEAF pre-tokens."""
    groups = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
    return ["".join(g) for g in groups], [count.tokens(g) for g in groups]


def _vocabulary(spark: SparkSession, path: str):
    """The file is read once and sent to the workers; its size is that of the vocabulary."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def build_trees(docs: DataFrame, path: str = VOCABULARY, pattern: str = PRE_TOKENS) -> DataFrame:
    """The columns of docs (text among them), and leaf_chars and leaf_tokens: the tree of each text."""
    vocabulary = _vocabulary(docs.sparkSession, path)
    names = docs.columns
    arrays = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("leaf_chars", "leaf_tokens")]

    def run(batches):
        count = counter(vocabulary.value, pattern)
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                built = [leaves(count.split(x or ""), count) for x in part["text"].to_pylist()]
                columns = [
                    pa.array([list(map(len, t)) for t, _ in built], pa.list_(pa.int32())),
                    pa.array([n for _, n in built], pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*names, "leaf_chars", "leaf_tokens"])

    return docs.mapInArrow(run, T.StructType([*fields(docs, names), *arrays]))


def apply_edits(trees: DataFrame, path: str = VOCABULARY, pattern: str = PRE_TOKENS, text: bool = False) -> DataFrame:
    """trees: doc_id, text, leaf_chars, leaf_tokens, edits (array of start, stop, text).

    Returns doc_id, the counts before and after, the characters encoded again, and the edited tree
    (and the edited text if asked for).
    """
    vocabulary = _vocabulary(trees.sparkSession, path)
    lists = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [
            *fields(trees, ["doc_id"]),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_tokens_edited", T.LongType()),
            T.StructField("n_chars_edited", T.LongType()),
            T.StructField("n_chars_recoded", T.LongType()),
            T.StructField("leaf_chars", lists),
            T.StructField("leaf_tokens", lists),
            *([T.StructField("text", T.StringType())] if text else []),
        ]
    )

    def run(batches):
        count = counter(vocabulary.value, pattern)
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                rows = []
                for x, chars, tokens, edits in zip(*(part[c].to_pylist() for c in ("text", "leaf_chars", "leaf_tokens", "edits"))):
                    tree = TokenTree.stored(x or "", chars, tokens, count)
                    before = tree.tokens
                    for e in edits or []:
                        if e is not None:
                            tree.edit(e["start"] or 0, e["stop"] or 0, e["text"] or "")
                    used = [k for k, t in enumerate(tree.texts) if t] or [0]
                    rows.append(
                        (before, tree.tokens, tree.length, tree.recoded, [len(tree.texts[k]) for k in used],
                         [tree.sums[tree.size + k] for k in used], tree.text if text else None)
                    )
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * 2 + [pa.string()] * text
                columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *columns], names=schema.names)

    return trees.select("doc_id", "text", "leaf_chars", "leaf_tokens", "edits").mapInArrow(run, schema)


def op6_token_counts(spark, folder: str) -> DataFrame:
    """doc_id, n_tokens, n_tokens_edited, n_chars_edited, n_chars_recoded for every row of documents.

    Each document has three edits that its own row gives: its language's code replaces seven
    characters, forty are deleted and its source's name is put in, at places by a hash of the id.
    """
    docs = picked(table(spark, folder, "documents"), doc_id="doc_id", text="text", lang="lang", source="source")
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))

    def edit(n: int, length: int, text):
        start = F.pmod(F.xxhash64("doc_id", F.lit(n)), F.length("text") + 1).cast("int")
        return F.struct(start.alias("start"), (start + length).alias("stop"), F.coalesce(text, F.lit("")).alias("text"))

    edits = F.array(edit(1, 7, F.col("lang")), edit(2, 40, F.lit("")), edit(3, 0, F.concat_ws("", F.lit(" "), "source")))
    return apply_edits(build_trees(docs.select("doc_id", "text", edits.alias("edits")))).drop("leaf_chars", "leaf_tokens")
