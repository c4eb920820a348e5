"""N-gram Jaccard join by MinHash banding.

A text is the set of its runs of five words (a shorter text: its one run of all words); words are
runs of digits, letters and non-ASCII characters after lower-casing A-Z. Two texts are linked when
the Jaccard similarity of their sets is 0.8 or more. Bands of `ROWS` minima are as many as the
target recall needs for a pair at the threshold; documents that share a band hash are candidates.

Copies (the same words in the same order) are one node from the start, with a weight. Candidate
nodes are joined into clusters by narrow edges from each bucket's smallest node, so that no bucket
is expanded into pairs. The n-gram set of a candidate is then computed once and sent to its
cluster; a large cluster is cut into blocks, and every pair of blocks is compared in a task of its
own. Every pair of a cluster is verified on the full sets, whether it shares a band or not. Only
sums and one edge for each node leave a task.

Texts without words are linked to nothing. Null texts are empty. Rows repeated in full count as
documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm import words as W
from concord.llm.components import stars
from concord.llm.frames import fields, picked, small_or_shuffled, table, written

GRAM = 5
THRESHOLD = 0.8
RECALL = 0.999
ROWS = 8
#: Nodes and n-grams of a block of a large cluster.
BLOCK_NODES = 512
BLOCK_GRAMS = 1 << 20
#: From so many texts on, an n-gram is a column of the matrix whose product counts shared ones.
COMMON = 16


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Bands so that a pair at the threshold shares one with the probability `recall`."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def gram_lists(found: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram hashes of a block of texts, one after the other, and the number of each text."""
    hashes, counts = found.hashes(), found.counts
    n = np.maximum(counts - GRAM + 1, 0)
    grams = W.grams(hashes, GRAM)
    owner = np.repeat(np.arange(len(counts)), n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(found.first[:-1], n)
    return grams[place] if len(place) else np.zeros(0, np.uint64), n


def band_hashes(grams: np.ndarray, counts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One row of band hashes for each text with n-grams."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    short = (grams >> np.uint64(32)).astype(np.uint32)
    factors = (seeds := W.seeded(3, bands * rows)).astype(np.uint32) | np.uint32(1)
    masks = (seeds >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(starts), bands), np.uint64)
    if not len(starts):
        return out
    work = np.empty_like(short)
    for k in range(bands * rows):
        np.bitwise_xor(short, masks[k], out=work)
        np.multiply(work, factors[k], out=work)
        least = np.minimum.reduceat(work, starts).astype(np.uint64)
        band = k // rows
        out[:, band] = W.mix(out[:, band] * np.uint64(0x9E3779B97F4A7C15) + least + np.uint64(k + 1))
    return out


def nodes_of(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, node (null without words), n_words, bands of each row of (doc_id, text)."""
    schema = T.StructType(
        [
            *fields(docs, ["doc_id"]),
            T.StructField("node", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches):
        for b in batches:
            for i, j, data, offsets in W.blocks(b["text"]):
                found = W.split(data, offsets)
                grams, n = gram_lists(found)
                hashes = band_hashes(grams, n, bands, rows)
                nodes = W.sequence_hashes(found.hashes(), found.first).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        b["doc_id"].slice(i, j - i),
                        pa.array(nodes, mask=found.counts == 0),
                        pa.array(found.counts.astype(np.int64)),
                        W.list_column(hashes.reshape(-1).view(np.int64), np.where(n > 0, bands, 0), pa.int64()),
                    ],
                    names=["doc_id", "node", "n_words", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def candidate_edges(nodes: DataFrame) -> DataFrame:
    """(a, b): each node of a bucket with two nodes or more, and the bucket's smallest node."""
    banded = nodes.where(F.size("bands") > 0).select("node", F.explode("bands").alias("band"))
    buckets = written(
        banded.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("band", "low")
    )
    return banded.join(small_or_shuffled(buckets), "band").where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b"))


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of all pairwise intersections (the diagonal is left as it comes)."""
    n = len(sets)
    lengths = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), lengths)
    order = np.argsort(values := np.concatenate(sets), kind="stable")
    values, owner = values[order], owner[order]
    heads = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    times = np.diff(np.concatenate([heads, [len(values)]]))
    counts = np.zeros((n, n), np.int64)
    for size in range(2, COMMON):
        at = heads[times == size]
        if len(at):
            groups = owner[at[:, None] + np.arange(size)]
            a, b = np.triu_indices(size, 1)
            for k in range(0, len(at), 1 << 16):
                part = groups[k : k + (1 << 16)]
                counts += np.bincount((part[:, a] * n + part[:, b]).reshape(-1), minlength=n * n).reshape(n, n)
    counts += counts.T
    common = np.flatnonzero(times >= COMMON)
    for k in range(0, len(common), 2048):
        part = common[k : k + 2048]
        matrix = np.zeros((n, len(part)), np.float32)
        rows = np.concatenate([owner[heads[c] : heads[c] + times[c]] for c in part])
        matrix[rows, np.repeat(np.arange(len(part)), times[part])] = 1
        counts += (matrix @ matrix.T).astype(np.int64)
    return counts


def linked(sets: list[np.ndarray], blocks: np.ndarray, threshold: float) -> np.ndarray:
    """Matrix of the links of a task: within its block, or between its two blocks."""
    counts = shared_counts(sets)
    sizes = np.array([len(s) for s in sets])
    union = sizes[:, None] + sizes[None, :] - counts
    links = counts >= threshold * union - 1e-9
    if blocks.min() != blocks.max():
        links &= blocks[:, None] != blocks[None, :]
    np.fill_diagonal(links, False)
    return links


def labels(links: np.ndarray) -> np.ndarray:
    """The smallest member reached from each member."""
    label = np.arange(len(links))
    while True:
        near = np.where(links, label[None, :], len(links)).min(axis=1)
        new = np.minimum(label, near)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _set_rows(batches):
    """node, root, blocks, weight, grams of candidates; the text's own node decides between rows of one id."""
    for b in batches:
        for i, j, data, offsets in W.blocks(b["text"]):
            found = W.split(data, offsets)
            nodes = W.sequence_hashes(found.hashes(), found.first).view(np.int64)
            grams, n = gram_lists(found)
            stops = np.cumsum(n)
            keep = np.flatnonzero(nodes == b["node"].slice(i, j - i).to_numpy())
            sets = [np.unique(grams[stops[k] - n[k] : stops[k]]).tobytes() for k in keep]
            part = b.slice(i, j - i).take(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [part["node"], part["root"], part["blocks"], part["weight"], pa.array(sets, pa.binary())],
                names=["node", "root", "blocks", "weight", "grams"],
            )


def _verified(threshold: float):
    def run(batches):
        cell, rows = None, []

        def result():
            seen = {r[0]: r for r in rows}  # a repeated row is the same node
            nodes = np.array(sorted(seen), np.int64)
            if len(nodes) < 2:
                return None
            sets = [np.frombuffer(seen[x][4], np.uint64) for x in nodes]
            links = linked(sets, np.array([seen[x][3] for x in nodes]), threshold)
            weight = np.array([seen[x][2] for x in nodes], np.int64)
            any_link = links.any(axis=1)
            if not any_link.any():
                return None
            return pa.RecordBatch.from_pydict(
                {
                    "node": nodes[any_link],
                    "links": (links @ weight)[any_link],
                    "label": nodes[labels(links)][any_link],
                    "blocks": np.full(any_link.sum(), rows[0][1], np.int64),
                }
            )

        for b in batches:
            columns = [b[c].to_pylist() for c in ("cell", "node", "blocks", "weight", "block", "grams")]
            for now, *row in zip(*columns):
                if now != cell:
                    if len(rows) > 1 and (out := result()) is not None:
                        yield out
                    cell, rows = now, []
                rows.append(row)
        if len(rows) > 1 and (out := result()) is not None:
            yield out

    return run


def similarity_links(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its group), n_links (documents linked to it).

    A group is what links connect; a document's links are all others at or above the threshold,
    copies included.
    """
    docs = picked(docs, doc_id=id_column, text=text_column)
    nodes = written(nodes_of(docs, bands_for(threshold, recall, rows), rows))
    classes = written(
        nodes.where("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("weight"), F.max("n_words").alias("n_words")
        )
    )
    clusters = stars(candidate_edges(nodes))
    members = clusters.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        clusters.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
    members = written(classes.join(small_or_shuffled(written(members)), "node"))
    sizes = members.groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n_words") / BLOCK_GRAMS)).cast("long").alias("blocks")
    )
    wanted = small_or_shuffled(written(members.join(sizes, "root").select("node", "root", "rep", "blocks", "weight")))
    sets = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["rep"])).select("text", "node", "root", "blocks", "weight").mapInArrow(
        _set_rows, "node long, root long, blocks long, weight long, grams binary"
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    cells = (
        sets.withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other")).alias("cell"),
            "node", "blocks", "weight", "block", "grams",
        )
    )
    found = written(
        cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(
            _verified(threshold), "node long, links long, label long, blocks long"
        )
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    whole = found.where("blocks = 1").select("node", F.col("label").alias("root"))
    parts = found.where("blocks > 1")
    if not parts.isEmpty():
        joined = stars(parts.select(F.col("node").alias("a"), F.col("label").alias("b")))
        whole = whole.unionByName(joined.select(F.col("a").alias("node"), F.col("b").alias("root")))
        whole = whole.unionByName(joined.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    grouped = whole.join(classes.select("node", "rep"), "node")
    firsts = grouped.groupBy("root").agg(F.min("rep").alias("class_id"))
    groups = grouped.join(firsts, "root").select("node", F.col("class_id").alias("group_id"))
    known = written(
        classes.join(groups.join(links, "node"), "node", "left")
        .where((F.col("weight") > 1) | F.col("links").isNotNull())
        .select(
            "node",
            F.coalesce("group_id", "rep").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    )
    return (
        nodes.select("doc_id", "node")
        .join(small_or_shuffled(known), "node", "left")
        .select(
            "doc_id",
            F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        )
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with one of each group, the one with the smallest id; all columns kept.

    Rows that share an id stay or go together; a null id stays.
    """
    found = similarity_links(docs, threshold=threshold, id_column=id_column, text_column=text_column)
    gone = written(
        found.groupBy(F.col("doc_id").alias("gone_id")).agg(F.bool_and(F.col("doc_id") != F.col("class_id")).alias("gone"))
        .where("gone").select("gone_id")
    )
    return docs.join(small_or_shuffled(gone), docs[id_column] == gone["gone_id"], "left_anti")


def op4_ngram_jaccard(spark, folder: str) -> DataFrame:
    """doc_id, class_id, n_links for every row of documents."""
    return similarity_links(table(spark, folder, "documents"))


OP4_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, hash(list_aggregate(w[s:s + least(len(w), 5) - 1], 'string_agg', ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM split WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE shared * 10 >= 8 * (x.n + y.n - shared)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT reach.a AS doc_id, min(reach.b) AS class_id, (SELECT count(*) FROM links WHERE links.a = reach.a) AS n_links
FROM reach GROUP BY reach.a
"""
