"""Benchmark decontamination by winnowing.

Of every `WINDOW` consecutive word `GRAM`-grams the one with the smallest hash is a fingerprint,
chosen by the words alone, so a span of GRAM + WINDOW - 1 = 10 shared words has the same fingerprint
on both sides. Fingerprints of the documents that a Bloom filter of the benchmark's ones lets pass
are joined with them by hash; each hit carries the words around it and is extended in both
directions, which finds every shared window of 10 words and nothing else. Items of fewer words are
one window of their own length, found by the hash of all their words.

Words are runs of digits, letters and non-ASCII characters after lower-casing A-Z. A null text has
no words. Rows repeated in full each get the same result; an item that is repeated, or two items
with the same text, count once per id; an item without id has no place in the list of items but
its words are hit. Empty tables on either side give results with nothing hit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm import words as W
from concord.llm.bloom import Bloom
from concord.llm.frames import fields, picked, small_or_shuffled, table, written

GRAM = 5
WINDOW = 6
#: Words of a window, and words carried with a fingerprint: all windows that contain it.
SPAN = GRAM + WINDOW - 1
AROUND = SPAN - GRAM
CARRIED = GRAM + 2 * AROUND

HIT = T.StructType(
    [
        T.StructField("print", T.LongType()),
        T.StructField("place", T.IntegerType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("around", T.BinaryType()),
    ]
)
_HIT = pa.struct([("print", pa.int64()), ("place", pa.int32()), ("size", pa.int32()), ("around", pa.binary())])


def winnowed(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the fingerprints of all texts of a block (ascending), and the GRAM-gram hashes."""
    grams = W.grams(hashes, GRAM)
    n = len(grams) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), grams
    smallest, at = grams[:n].copy(), np.zeros(n, np.int64)
    for i in range(1, WINDOW):
        less = grams[i : i + n] < smallest
        smallest[less] = grams[i : i + n][less]
        at[less] = i
    inside = np.zeros(len(hashes) + 1, np.int64)  # windows that lie in one text
    long = np.diff(first) >= SPAN
    inside[first[:-1][long]] += 1
    np.add.at(inside, first[1:][long] - SPAN + 1, -1)
    valid = np.cumsum(inside)[:n] > 0
    chosen = np.zeros(len(grams), bool)
    chosen[(np.arange(n) + at)[valid]] = True
    return np.flatnonzero(chosen), grams


def carried(hashes: np.ndarray, places: np.ndarray, low: np.ndarray, high: np.ndarray, before: int, outside: int) -> np.ndarray:
    """CARRIED word hashes from `before` words ahead of each place; `outside` beyond the text."""
    where = places[:, None] + np.arange(-before, CARRIED - before)
    ok = (where >= low[:, None]) & (where < high[:, None])
    return np.where(ok, hashes[np.clip(where, 0, max(0, len(hashes) - 1))], np.uint64(outside))


def hits_of(words: W.Words, sizes: list[int], outside: int, short_only: bool = False):
    """(text number, print, place in the text, size, carried words) of a block of texts.

    sizes: lengths below SPAN for which every run of words is a print (items: only texts of that length).
    """
    hashes, first = words.hashes(), words.first
    counts = words.counts
    owner = np.repeat(np.arange(len(counts)), counts)
    out = []
    places, grams = winnowed(hashes, first)
    if len(places):
        own = owner[places]
        out.append((own, W.mix(grams[places] + np.uint64(SPAN)), places, SPAN, AROUND, first[own], first[own + 1]))
    for size in sizes:
        grams = W.grams(hashes, size)
        if short_only:
            places = first[:-1][counts == size]
        else:
            places = np.arange(len(grams))
            places = places[places + size <= first[owner[places] + 1]] if len(places) else places
        if len(places):
            own = owner[places]
            out.append((own, W.mix(grams[places] + np.uint64(size)), places, size, 0, places, places + size))
    for own, prints, places, size, before, low, high in out:
        yield own, prints, places - first[own], size, lambda keep, a=(places, low, high, before): carried(
            hashes, a[0][keep], a[1][keep], a[2][keep], a[3], outside
        )


def _hit_lists(words: W.Words, sizes: list[int], outside: int, short_only: bool, passes) -> pa.Array:
    """A list of hits for each text of the block, of those prints that `passes`."""
    owners, prints, places, lengths, around = [], [], [], [], []
    for own, hashes, place, size, context in hits_of(words, sizes, outside, short_only):
        keep = np.flatnonzero(passes(hashes)) if passes else np.arange(len(hashes))
        if len(keep):
            owners.append(own[keep])
            prints.append(hashes[keep])
            places.append(place[keep])
            lengths.append(np.full(len(keep), size))
            around.append(context(keep))
    n = len(words.counts)
    if not owners:
        return pa.array([[]] * n, pa.list_(_HIT))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    context = np.ascontiguousarray(np.concatenate(around)[order])
    struct = pa.StructArray.from_arrays(
        [
            pa.array(np.concatenate(prints)[order].view(np.int64)),
            pa.array(np.concatenate(places)[order].astype(np.int32)),
            pa.array(np.concatenate(lengths)[order].astype(np.int32)),
            pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * CARRIED), len(order), [None, pa.py_buffer(context)]).cast(pa.binary()),
        ],
        fields=list(_HIT),
    )
    offsets = np.zeros(n + 1, np.int32)
    np.cumsum(np.bincount(owner, minlength=n), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), struct)


def with_hits(texts: DataFrame, id_column: str, sizes: list[int], outside: int, short_only: bool, passes=None) -> DataFrame:
    """id, words (a hash of the word sequence), n_words, hits of each row."""
    schema = T.StructType(
        [
            *fields(texts, [id_column]),
            T.StructField("words", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("hits", T.ArrayType(HIT)),
        ]
    )

    def run(batches):
        for b in batches:
            for i, j, data, offsets in W.blocks(b["text"]):
                found = W.split(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        b[id_column].slice(i, j - i),
                        pa.array(W.sequence_hashes(found.hashes(), found.first).view(np.int64)),
                        pa.array(found.counts.astype(np.int64)),
                        _hit_lists(found, sizes, outside, short_only, passes),
                    ],
                    names=[id_column, "words", "n_words", "hits"],
                )

    return texts.select(id_column, "text").mapInArrow(run, schema)


def _extended(batches):
    """Spans of hit words of joined prints: [start, stop) where a whole window is shared."""
    for b in batches:
        if not b.num_rows:
            continue
        ours = np.frombuffer(b"".join(b["around"].to_pylist()), np.uint64).reshape(-1, CARRIED)
        theirs = np.frombuffer(b"".join(b["item_around"].to_pylist()), np.uint64).reshape(-1, CARRIED)
        same = ours == theirs
        place = b["place"].to_numpy().astype(np.int64)
        size = b["size"].to_numpy().astype(np.int64)
        left = np.cumprod(same[:, :AROUND][:, ::-1], axis=1).sum(axis=1)
        right = np.cumprod(same[:, AROUND + GRAM :], axis=1).sum(axis=1)
        long = size == SPAN
        good = np.where(
            long,
            same[:, AROUND : AROUND + GRAM].all(axis=1) & (left + right + GRAM >= SPAN),
            (same | (np.arange(CARRIED) >= size[:, None])).all(axis=1),
        )
        start = np.where(long, place - left, place)
        stop = np.where(long, place + GRAM + right, place + size)
        out = pa.RecordBatch.from_arrays(
            [b["doc_id"], b["words"], b["item_id"], pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))],
            names=["doc_id", "words", "item_id", "start", "stop"],
        )
        yield out.filter(pa.array(good))


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted ids as text), n_items, contaminated."""
    docs = picked(docs, doc_id=id_column, text=text_column)
    items = picked(benchmark, item_id=item_column, text=item_text_column)
    known = written(with_hits(items, "item_id", list(range(1, SPAN)), 1, True).select("item_id", F.explode("hits").alias("hit")).select("item_id", "hit.*"))
    sizes = sorted(r[0] for r in known.where(F.col("size") < SPAN).select("size").distinct().collect())
    known_prints = Bloom(known, "print")
    looked = written(with_hits(docs, "doc_id", sizes, 2, False, known_prints.maybe))

    hits = looked.select("doc_id", "words", F.explode("hits").alias("hit")).select("doc_id", "words", "hit.*")
    theirs = known.select("item_id", "print", "size", F.col("around").alias("item_around"))
    joined = hits.join(theirs, ["print", "size"])
    spans = joined.mapInArrow(
        _extended,
        T.StructType(
            [
                *fields(docs, ["doc_id"]),
                T.StructField("words", T.LongType()),
                *fields(items, ["item_id"]),
                T.StructField("start", T.IntegerType()),
                T.StructField("stop", T.IntegerType()),
            ]
        ),
    )
    by_doc = spans.groupBy("doc_id", "words").agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    start = F.struct(F.lit(0).alias("done"), F.lit(0).cast("long").alias("hit"))

    def add(acc, span):
        new = F.greatest(F.lit(0), span["stop"] - F.greatest(span["start"], acc["done"]))
        return F.struct(F.greatest(acc["done"], span["stop"]).alias("done"), (acc["hit"] + new).alias("hit"))

    counted = by_doc.select(
        F.col("doc_id").alias("id"), F.col("words").alias("key"), "items", F.aggregate("spans", start, add, lambda x: x["hit"]).alias("n_hit")
    )
    none = F.array().cast("array<string>")
    clean = looked.where(F.size("hits") == 0).select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"))
    rest = looked.where(F.size("hits") > 0)
    rest = rest.join(counted, rest["doc_id"].eqNullSafe(counted["id"]) & (rest["words"] == counted["key"]), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items")
    )
    return clean.unionByName(rest).select(
        "doc_id", "n_words", "n_hit", "items", F.size("items").cast("long").alias("n_items"), (F.col("n_hit") > 0).alias("contaminated")
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents without a hit word, all columns kept. Rows that share an id go if one of them is hit;
    a null id stays."""
    found = contamination(docs, benchmark, id_column=id_column, text_column=text_column)
    gone = written(found.where("contaminated").select(F.col("doc_id").alias("gone_id")).distinct())
    return docs.join(small_or_shuffled(gone), docs[id_column] == gone["gone_id"], "left_anti")


def op8_decontaminate(spark, folder: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of documents."""
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


OP8_SQL = r"""
WITH split AS (
  SELECT doc_id AS id, true AS is_doc, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)
  UNION ALL
  SELECT item_id, false, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM benchmark)
),
known AS (
  SELECT DISTINCT id AS item_id, size, list_aggregate(w[s:s + size - 1], 'string_agg', ' ') AS span
  FROM (SELECT id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM split WHERE NOT is_doc AND len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM known),
runs AS (
  SELECT id AS doc_id, size, s, list_aggregate(w[s:s + size - 1], 'string_agg', ' ') AS span
  FROM (SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM split, sizes WHERE is_doc AND len(w) >= size)
),
found AS (SELECT doc_id, s, size, item_id FROM runs JOIN known USING (size, span)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.id AS doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM split d LEFT JOIN words ON words.doc_id = d.id LEFT JOIN items ON items.doc_id = d.id
WHERE d.is_doc
"""
