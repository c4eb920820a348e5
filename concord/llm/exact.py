"""Exact de-duplication by two passes over a Bloom filter.

The first pass sets, for each text's digest, two bits in one block of a blocked filter and keeps
the bits that more than one row has set. The second pass looks every digest up: a row with an
unshared bit is certainly alone and passes straight through, only the others are shuffled. The
filter has a fixed largest size, so it can be sent to every task; with more rows than fit it, more
rows are shuffled and the result is the same.

Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Of equal texts
the row with the largest id stays; null ids count as smaller than all others. Rows that agree in
text and id are one row repeated: exactly one of them stays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.frames import fields, picked, written

#: Bits for each row, bits of a block, and the largest size of the whole filter in bytes.
BITS_PER_ROW = 16
BLOCK_BITS = 13
FILTER_BYTES = 1 << 26
#: Digests a task gathers before it passes their bits on.
GATHERED = 1 << 20


def digest(text: bytes) -> bytes:
    """SHA-256 of a UTF-8 text after lower-casing A-Z (which is all that bytes.lower changes)."""
    return hashlib.sha256(text.lower()).digest()


def _digests(column: pa.Array) -> list[bytes]:
    return [digest(x or b"") for x in column.cast(pa.binary()).to_pylist()]


def text_digests(docs: DataFrame) -> DataFrame:
    """doc_id and digest of each row of (doc_id, text)."""
    schema = T.StructType([*fields(docs, ["doc_id"]), T.StructField("digest", T.BinaryType())])

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(_digests(b["text"]), pa.binary())], names=["doc_id", "digest"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def places(digests: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each digest (rows of 32 bytes), as positions in the whole filter."""
    words = digests.view(np.uint64).reshape(-1, 4)
    low = np.uint64((1 << BLOCK_BITS) - 1)
    block = (words[:, 0] & np.uint64(blocks - 1)) << np.uint64(BLOCK_BITS)
    return block | (words[:, 1] & low), block | (words[:, 2] & low)


def filter_blocks(rows: int) -> int:
    """Number of blocks, a power of two, for so many rows."""
    wanted = max(1, rows * BITS_PER_ROW) >> BLOCK_BITS
    return min(1 << wanted.bit_length(), (FILTER_BYTES * 8) >> BLOCK_BITS)


def repeated_bits(digests: DataFrame, blocks: int) -> DataFrame:
    """(block, bits): the bits that more than one row has set, for blocks that have any."""

    def one_task(batches):
        held: list[np.ndarray] = []

        def passed_on():
            both = [places(d, blocks) for d in held]
            first = np.concatenate([a for a, _ in both])
            second = np.concatenate([b[b != a] for a, b in both])
            where, n = np.unique(np.concatenate([first, second]), return_counts=True)
            part = where >> np.uint64(BLOCK_BITS)
            cuts = np.flatnonzero(np.diff(part)) + 1
            low = (where & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.uint16)
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(part[np.concatenate([[0], cuts])].astype(np.int64)),
                    "once": pa.array([x[c == 1].tobytes() for x, c in zip(np.split(low, cuts), np.split(n, cuts))]),
                    "again": pa.array([x[c > 1].tobytes() for x, c in zip(np.split(low, cuts), np.split(n, cuts))]),
                },
                schema=pa.schema([("block", pa.int64()), ("once", pa.binary()), ("again", pa.binary())]),
            )

        size = 0
        for b in batches:
            if b.num_rows:
                held.append(np.frombuffer(b"".join(b["digest"].to_pylist()), np.uint8))
                size += b.num_rows
            if size >= GATHERED:
                yield passed_on()
                held.clear()
                size = 0
        if held:
            yield passed_on()

    def one_block(pdf: pd.DataFrame) -> pd.DataFrame:
        once = np.frombuffer(b"".join(pdf["once"]), np.uint16)
        again = np.frombuffer(b"".join(pdf["again"]), np.uint16)
        seen = np.bincount(once, minlength=1 << BLOCK_BITS)
        seen[again] = 2
        bits = np.packbits(seen > 1)
        return pd.DataFrame({"block": pdf["block"][:1], "bits": [bits.tobytes()]}).head(int(bits.any()))

    sparse = digests.select("digest").mapInArrow(one_task, "block long, once binary, again binary")
    return sparse.groupBy("block").applyInPandas(one_block, "block long, bits binary")


class RepeatFilter:
    """Tells whether the digest of a row may be that of another row as well."""

    def __init__(self, digests: DataFrame):
        """digests: a written table with a digest column. The filter (FILTER_BYTES at most) passes the driver."""
        self.blocks = filter_blocks(digests.count())
        whole = np.zeros((self.blocks, 1 << (BLOCK_BITS - 3)), np.uint8)
        for block, bits in repeated_bits(digests, self.blocks).collect():
            whole[block] = np.frombuffer(bits, np.uint8)
        self.bits = digests.sparkSession.sparkContext.broadcast(whole.reshape(-1))

    def possibly(self, digests: list[bytes]) -> np.ndarray:
        if not digests:
            return np.zeros(0, bool)
        bits = self.bits.value
        out = np.ones(len(digests), bool)
        for where in places(np.frombuffer(b"".join(digests), np.uint8), self.blocks):
            out &= (bits[(where >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (where & np.uint64(7)).astype(np.uint8))) & 1 == 1
        return out


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept.

    An empty table gives an empty one; columns other than the two named are not looked at.
    """
    digests = written(text_digests(picked(docs, doc_id=id_column, text=text_column)))
    found = RepeatFilter(digests)
    schema = T.StructType([*fields(digests, ["doc_id", "digest"]), T.StructField("maybe", T.BooleanType())])

    def look_up(batches):
        for b in batches:
            flags = found.possibly(b["digest"].to_pylist())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["digest"], pa.array(flags)], names=["doc_id", "digest", "maybe"])

    looked = digests.mapInArrow(look_up, schema)
    alone = looked.where(~F.col("maybe")).select(
        "doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    # Repeats of one row are counted before anything is gathered by text.
    rows = written(looked.where("maybe").groupBy("digest", "doc_id").agg(F.count("*").alias("repeats")))
    # Written as well, so that both sides of the join are plain shuffles and a hot digest can be split.
    groups = written(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("repeats").alias("group_size")))
    shared = (
        rows.join(groups, "digest")
        .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "repeats")))
        .select(
            "doc_id", "digest", "keep_id", "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        )
    )
    return alone.unionByName(shared)


def keep_exact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with one row of each group of equal texts, all columns kept.

    Rows that are certainly alone pass straight through. The others are reduced to one row for
    each text inside every task before they are shuffled, so no group of copies meets in a task.
    """
    found = RepeatFilter(written(text_digests(picked(docs, doc_id=id_column, text=text_column)).select("digest")))

    @F.arrow_udf("binary")
    def shared_digest(texts: pa.Array) -> pa.Array:
        digests = _digests(texts)
        return pa.array([d if m else None for d, m in zip(digests, found.possibly(digests))], pa.binary())

    mark = "shared_digest"
    while mark in docs.columns:
        mark += "_"
    marked = docs.withColumn(mark, shared_digest(docs[text_column]))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rank = F.struct(F.col(f"`{id_column}`"), F.xxhash64(*columns))
    best = (
        marked.where(F.col(mark).isNotNull())
        .groupBy(mark)
        .agg(F.max_by(F.struct(*columns), rank).alias("row"))
        .select("row.*")
    )
    return marked.where(F.col(mark).isNull()).select(*columns).unionByName(best)


def op9_exact_dedup(spark, folder: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of documents."""
    groups = exact_groups(spark.read.parquet(f"{folder}/documents.parquet"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP9_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
