"""Hard negatives by threshold joins.

Each anchor's positives are its first rows of the same label by inner product; a positive's negatives
are the first rows of other labels whose score lies in a window below the positive's. Both are found by
joins of anchors and rows with a score of at least a threshold, which is lowered for those anchors
whose windows are not full yet; the last threshold is the window's own lower end, or none.

A join with thresholds goes through an inverted index of a chunk of rows. Dimensions are ordered by
their energy, the largest last, in segments. A row's first segments are left out of the index as long
as the norm of that part, times the norm of the same part of every anchor, stays below the anchor's
threshold. Scores are added up from the last segment on; a pair goes once its score so far and the
product of both remaining norms fall short, and only pairs that are left get the segments that the
index leaves out. All numbers are whole, so scores are exact.

The anchors are a stated query set: they are taken in blocks of about BLOCK, each sent to the tasks
and joined with all rows, which stay where they are. A task passes on the first few rows of a window
only, so a vector that thousands of rows share costs no more than another.

Rows with a null label, vector or id, or a component that is null or not finite, take no part. Vectors
of different lengths end in zeros. Equal scores go by the smaller id, then by the row itself; a row
repeated in full is another row, also as an anchor. An empty table gives an empty result. Components
so large that inner products leave 53 bits are an error. Columns other than those named are not
looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.llm.frames import table, written

#: Anchors of a block, about; a block is what passes the driver and is sent to every task.
BLOCK = 16_384
#: Pairs whose scores a task adds up together, and candidates it holds before it keeps the first ones.
CHUNK = 1 << 20
HELD = 1 << 20
#: Dimensions of a segment.
SEGMENT = 8
#: Thresholds of positives, as a share of the largest score the norms allow; then none.
SHARES = (0.5, 0.3)
#: Lower ends of the negatives' windows in earlier rounds, as a share of the positive's score.
WINDOWS = (0.93,)
#: Share of pairs left over from which all pairs are added up on.
DENSE = 0.05
#: Relative error allowed to bounds, which are rounded.
MARGIN = 1e-9


@dataclass
class Vectors:
    """Vectors with their dimensions in the index's order, and the norms of their first segments."""

    x: np.ndarray
    norms: np.ndarray = field(init=False)

    def __post_init__(self):
        borders = range(0, self.x.shape[1] + SEGMENT, SEGMENT)
        squares = np.zeros((len(self.x), self.x.shape[1] + 1))
        np.cumsum(self.x.astype(float) ** 2, axis=1, out=squares[:, 1:])
        self.norms = np.sqrt(squares[:, [min(b, self.x.shape[1]) for b in borders]])

    @property
    def segments(self) -> int:
        return self.norms.shape[1] - 1

    def segment(self, rows, s: int) -> np.ndarray:
        return self.x[rows, s * SEGMENT : (s + 1) * SEGMENT]


def omitted(anchors: Vectors, rows: Vectors, least: np.ndarray) -> np.ndarray:
    """How many first segments of each row no anchor needs to find all pairs with its least score."""
    with np.errstate(divide="ignore", invalid="ignore"):
        reach = np.where(least[:, None] > 0, least[:, None] / anchors.norms, -np.inf).min(axis=0)
    covered = rows.norms * (1 + MARGIN) < reach
    return np.logical_and.accumulate(covered[:, 1:], axis=1).sum(axis=1)


def threshold_join(anchors: Vectors, rows: Vectors, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of every pair whose score is at least the anchor's least score."""
    skip, top = omitted(anchors, rows, least), rows.segments
    order = np.argsort(skip, kind="stable")
    order = order[: np.searchsorted(skip[order], top)]  # the others reach no anchor
    skip = skip[order]
    scores = np.zeros((len(anchors.x), len(order)))
    half = top // 2

    def add(s: int, n: int) -> None:
        scores[:, :n] += anchors.segment(slice(None), s) @ rows.segment(order[:n], s).T

    for s in range(top - 1, half - 1, -1):
        add(s, int(np.searchsorted(skip, s, "right")))
    level = np.maximum(skip, half)
    i, j = np.nonzero(scores + anchors.norms[:, level] * rows.norms[order, level] * (1 + MARGIN) >= least[:, None])
    if len(i) > DENSE * scores.size:
        for s in range(top):
            if s < half:
                add(s, len(order))
            elif (n := int(np.searchsorted(skip, s, "right"))) < len(order):
                scores[:, n:] += anchors.segment(slice(None), s) @ rows.segment(order[n:], s).T
        i, j = np.nonzero(scores >= least[:, None])
        return i, order[j], scores[i, j]
    found, level = scores[i, j], level[j]
    j = order[j]
    for s in range(top - 1, -1, -1):
        at = np.flatnonzero(level > s)
        if not len(at):
            continue
        found[at] += (anchors.segment(i[at], s) * rows.segment(j[at], s)).sum(axis=1)
        keep = found + anchors.norms[i, np.minimum(level, s)] * rows.norms[j, np.minimum(level, s)] * (1 + MARGIN) >= least[i]
        i, j, found, level = i[keep], j[keep], found[keep], level[keep]
    keep = found >= least[i]
    return i[keep], j[keep], found[keep]


@dataclass
class Space:
    """Length and order of the dimensions of a table's vectors."""

    order: np.ndarray

    @classmethod
    def of(cls, rows: DataFrame) -> Space:
        """Energy of each dimension, added up in tasks; as many rows as dimensions and tasks pass on."""

        def run(batches):
            energy, largest = np.zeros(0), 0.0
            for b in batches:
                x = padded(b["x"], None).astype(float)
                if x.shape[1] > len(energy):
                    energy = np.append(energy, np.zeros(x.shape[1] - len(energy)))
                energy[: x.shape[1]] += (x**2).sum(axis=0)
                largest = max(largest, float(np.abs(x).max(initial=0)))
            yield pa.RecordBatch.from_pydict(
                {"dimension": pa.array(np.arange(len(energy))), "energy": pa.array(energy), "largest": pa.array(np.full(len(energy), largest))}
            )

        sums = rows.select("x").mapInArrow(run, "dimension long, energy double, largest double")
        sums = sorted(sums.groupBy("dimension").agg(F.sum("energy"), F.max("largest")).collect())
        bound = max((x for _, _, x in sums), default=0.0) ** 2 * len(sums)
        if bound >= 2.0**53:
            raise ValueError("components are too large for whole inner products")
        order = np.argsort(np.array([e for _, e, _ in sums] or [0.0]), kind="stable")
        return cls(order.astype(np.int64))

    def vectors(self, x: np.ndarray) -> Vectors:
        return Vectors(np.ascontiguousarray(x[:, self.order]).astype(float))


def padded(column: pa.Array, length: int | None) -> np.ndarray:
    """A list column as rows of a matrix, ending in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    length = int(sizes.max(initial=0)) if length is None else length
    if len(sizes) and (sizes == length).all():
        return values.reshape(-1, length)
    out = np.zeros((len(sizes), length), np.int64)
    out[np.arange(length) < sizes[:, None]] = values
    return out


@dataclass
class Block:
    """What a round looks for: anchors, the windows of each, and their least scores."""

    space: Space
    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    vectors: Vectors
    same: bool
    #: For each anchor, the highest and lowest score of each window, in order; closed windows are empty.
    high: np.ndarray
    low: np.ndarray

    @property
    def least(self) -> np.ndarray:
        return np.where(self.low <= self.high, self.low, np.inf).min(axis=1)


def first_of_windows(block: Block, pairs: list[np.ndarray], keep: int) -> list[np.ndarray]:
    """Of (anchor, window, score, vec_id, row) columns the first rows of each window."""
    anchor, window, score, vec_id, row = pairs
    order = np.lexsort((row, vec_id, -score, window, anchor))
    key = (anchor * block.high.shape[1] + window)[order]
    heads = np.flatnonzero(np.concatenate([[True], np.diff(key) != 0])[: len(key)])
    rank = np.arange(len(key)) - np.repeat(heads, np.diff(np.append(heads, len(key))))
    order = order[rank < keep]
    return [c[order] for c in pairs]


def window_rows(rows: DataFrame, block, keep: int) -> DataFrame:
    """(anchor, window, score, vec_id, row): what each task has found for a block's windows."""
    names = ["anchor", "window", "score", "vec_id", "row"]

    def joined(b: Block, x: np.ndarray, label, vec_id, row, held):
        open_anchors = np.flatnonzero(b.least < np.inf)
        step = max(1, CHUNK // max(1, len(open_anchors)))
        for at in range(0, len(x), step):
            here = np.arange(at, min(at + step, len(x)))
            vectors = b.space.vectors(x[here])
            groups = [(open_anchors, np.arange(len(here)))]
            if b.same:  # only rows of an anchor's label meet it
                mine = b.label[open_anchors]
                groups = [(open_anchors[mine == v], np.flatnonzero(label[here] == v)) for v in np.intersect1d(mine, label[here])]
            for anchors, members in groups:
                some = Vectors(b.vectors.x[anchors])
                i, j, score = threshold_join(some, Vectors(vectors.x[members]), b.least[anchors])
                i, j, score = anchors[i], here[members[j]], score.astype(np.int64)
                fit = (b.row[i] != row[j]) & ((b.label[i] == label[j]) == b.same)
                i, j, score = i[fit], j[fit], score[fit]
                for w in range(b.high.shape[1]):
                    inside = np.flatnonzero((score <= b.high[i, w]) & (score >= b.low[i, w]))
                    k = j[inside]
                    held.append([i[inside], np.full(len(inside), w), score[inside], vec_id[k], row[k]])
            if sum(len(h[0]) for h in held) > HELD:
                held[:] = [first_of_windows(b, [np.concatenate(c) for c in zip(*held)], keep)]

    def run(batches):
        held: list[list[np.ndarray]] = []
        b = block.value
        for batch in batches:
            columns = [batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("label", "vec_id", "row")]
            joined(b, padded(batch["x"], len(b.space.order)), *columns, held)
        if held:
            out = first_of_windows(b, [np.concatenate(c) for c in zip(*held)], keep)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def merged(found: DataFrame, keep: int) -> DataFrame:
    """The first rows of each window over all tasks, with their rank and the number of them."""
    window = Window.partitionBy("anchor", "window")
    ranked = found.withColumn("rank", F.row_number().over(window.orderBy(F.desc("score"), "vec_id", "row"))).where(F.col("rank") <= keep)
    return written(ranked.withColumn("n", F.count("*").over(window)))


def _round(rows: DataFrame, block: Block, keep: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(block)
    found = merged(window_rows(rows, sent, keep), keep)
    sent.destroy()
    return found


def _positives(rows: DataFrame, space: Space, anchors, largest: float, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of each anchor's positives (as many rows as a block has anchors); none are nan and -1."""
    row, vec_id, label, vectors = anchors
    scores, ids = np.full((len(row), keep), np.nan), np.full((len(row), keep), -1, np.int64)
    left = np.ones(len(row), bool)
    for share in (*SHARES, None):
        low = np.full(len(row), -np.inf) if share is None else share * vectors.norms[:, -1] * largest
        high = np.where(left, np.inf, -np.inf)
        block = Block(space, row, vec_id, label, vectors, True, high[:, None], low[:, None])
        found = _round(rows, block, keep).where((F.col("n") == keep) | F.lit(share is None)).toPandas()
        i, k = found["anchor"].to_numpy(np.int64), found["rank"].to_numpy(np.int64) - 1
        scores[i, k], ids[i, k] = found["score"].to_numpy(float), found["vec_id"].to_numpy(np.int64)
        left[i] = False
        if not left.any():
            break
    return scores, ids


def _negatives(rows: DataFrame, space: Space, anchors, positives, low: int, high: int, keep: int) -> list[DataFrame]:
    """Tables of the first rows in the windows of each positive, by the round that filled them."""
    row, vec_id, label, vectors = anchors
    scores, ids = positives
    spark, whole = rows.sparkSession, np.nan_to_num(scores).astype(np.int64)
    left = ~np.isnan(scores) & (low * whole <= high * whole)
    least, most = -((-low * whole) // 100), (high * whole) // 100
    a, k = np.nonzero(left)
    named = spark.createDataFrame(
        pa.table({"anchor": pa.array(a), "window": pa.array(k), "anchor_id": pa.array(vec_id[a]), "positive_id": pa.array(ids[a, k]),
                  "positive_score": pa.array(whole[a, k])})
    )
    out = []
    for share in (*WINDOWS, None):
        if not left.any():
            break
        bottom = least if share is None else np.maximum(least, np.ceil(share * whole).astype(np.int64))
        block = Block(space, row, vec_id, label, vectors, False, np.where(left, most, -np.inf), bottom.astype(float))
        found = _round(rows, block, keep)
        if share is not None:
            found = found.where(F.col("n") == keep)
            full = found.where("rank = 1").select("anchor", "window").toPandas()
            left[full["anchor"].to_numpy(np.int64), full["window"].to_numpy(np.int64)] = False
        out.append(found.join(F.broadcast(named), ["anchor", "window"]))  # as many rows as a block has positives
    return out


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, low: int = 80, high: int = 100, positives: int = 5, negatives: int = 5, block: int = BLOCK
) -> DataFrame:
    """vectors: vec_id, label, x (whole numbers). Windows go from low to high percent of a positive's score.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    known = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").where(F.forall("x", lambda v: v.isNotNull()))
    known = known.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("x").cast("array<long>").alias("x"))
    rows = written(known.withColumn("row", F.monotonically_increasing_id()))
    space = Space.of(rows)
    spark = rows.sparkSession
    chosen = rows.where(is_anchor)
    blocks = chosen.count() // block + 1
    chosen = written(chosen.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).repartition("block").sortWithinPartitions("block"))
    squares = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    largest = float(rows.agg(F.sqrt(F.max(squares))).first()[0] or 0)
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for b in range(blocks):
        part = chosen.where(F.col("block") == b).select("row", "vec_id", "label", "x").orderBy("row").toArrow()
        if not part.num_rows:
            continue
        row, vec_id, label = (part[c].to_numpy() for c in ("row", "vec_id", "label"))
        anchors = (row, vec_id, label, space.vectors(padded(part["x"], len(space.order))))
        found = _positives(rows, space, anchors, largest, positives)
        for one in _negatives(rows, space, anchors, found, low, high, negatives):
            out = out.unionByName(
                one.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
            )
    return out


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * component) of each, null if one is null or not finite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(finite, F.transform(vector, lambda v: F.floor(v.cast("double") * scale)))


def op11_hard_negatives(spark, folder: str) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the anchors of embeddings."""
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = rows.select("vec_id", label.alias("label"), whole_numbers(F.col("embedding")).alias("x"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), TRUE)
), s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.x, b.x), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT a, b, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5
)
SELECT p.a AS anchor_id, p.b AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INTEGER) AS rank,
       s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) <= 5
"""
