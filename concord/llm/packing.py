"""Packing documents into sequences of a fixed length.

A document's ids, with the end mark, are cut into pieces of a whole sequence and a rest. Whole
pieces are sequences as they are and are not shuffled. The rests are dealt out at random into groups
of about GROUP tokens, and each group is packed by itself: first-fit decreasing, the first bin with
room found by a tournament tree of the bins' room. A group's bins with more than SLACK places left
are emptied again, their pieces laid end to end and cut into full sequences; what is left of them
makes sequences of powers of two, which need no padding.

A null text is an empty one: its end mark is its only id. Null and repeated document ids and rows
repeated in full keep their rows, each with pieces of its own; ties of length go by the number of
the piece. An empty table gives an empty result. A very long text is encoded as one block of a task
and leaves it in pieces. Columns other than the two named are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.frames import fields, picked, table, written
from concord.llm.pretokens import encoder

SEQUENCE = 2048
END = 1
#: Tokens of a group, which a task holds at once.
GROUP = 1 << 20
#: Places that may be left in a sequence.
SLACK = 8
#: Bytes of ids that pass from a task together.
PASSED = 1 << 22


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Tournament:
    """The room of each bin at the leaves, the larger of two rooms at each node above them."""

    def __init__(self, bins: int, room: int):
        self.size = 1 << max(0, bins - 1).bit_length()
        self.room = [room] * (2 * self.size)

    def first_fit(self, length: int) -> int:
        """Take the room in the first bin that has it."""
        room, node = self.room, 1
        while node < self.size:
            node *= 2
            if room[node] < length:
                node += 1
        room[node] -= length
        leaf = node - self.size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return leaf


@dataclass
class Slot:
    """A run of an item's tokens and its place."""

    item: int
    start: int
    length: int
    sequence: int
    offset: int


def pack(lengths: list[int], sequence: int = SEQUENCE, slack: int = SLACK) -> list[Slot]:
    """Where each of the items, none longer than a sequence, goes; ties keep their order."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    tree = Tournament(len(lengths), sequence)
    bins: list[list[int]] = []
    for i in order:
        b = tree.first_fit(lengths[i])
        if b == len(bins):
            bins.append([])
        bins[b].append(i)
    slots, emptied, n = [], [], 0
    for members in bins:
        filled = sum(lengths[i] for i in members)
        if sequence - filled > slack and filled & (filled - 1):
            emptied += members
            continue
        offset = 0
        for i in members:
            slots.append(Slot(i, 0, lengths[i], n, offset))
            offset += lengths[i]
        n += 1
    return slots + laid_out(emptied, lengths, n, sequence)


def laid_out(items: list[int], lengths: list[int], n: int, sequence: int) -> list[Slot]:
    """The items end to end, cut into full sequences from number n on, the rest into powers of two."""
    left = sum(lengths[i] for i in items)
    slots, room, offset = [], 0, 0
    n -= 1
    for i in items:
        start = 0
        while start < lengths[i]:
            if not room:
                room = sequence if left >= sequence else 1 << (left.bit_length() - 1)
                n, offset = n + 1, 0
            length = min(room, lengths[i] - start)
            slots.append(Slot(i, start, length, n, offset))
            start, offset, room, left = start + length, offset + length, room - length, left - length
    return slots


def token_pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE, end: int = END) -> DataFrame:
    """doc_id, start, ids (four bytes each, little-endian), doc_tokens of each piece of (doc_id, text)."""
    content = docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    schema = T.StructType(
        [*fields(docs, ["doc_id"]), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType()),
         T.StructField("doc_tokens", T.LongType())]
    )
    last = np.array([end], "<u4")

    def run(batches):
        encode = encoder(content.value)
        for b in batches:
            of, starts, ids, totals, size = [], [], [], [], 0

            def passed():
                columns = [b["doc_id"].take(pa.array(of, pa.int64())), pa.array(starts, pa.int64()), pa.array(ids, pa.binary()), pa.array(totals, pa.int64())]
                return pa.RecordBatch.from_arrays(columns, names=schema.names)

            for row, found in enumerate(encode.texts(b["text"])):
                whole = np.append(found, last).astype("<u4")
                for start in range(0, len(whole), sequence):
                    of.append(row)
                    starts.append(start)
                    ids.append(whole[start : start + sequence].tobytes())
                    totals.append(len(whole))
                    size += len(ids[-1])
                    if size >= PASSED:
                        yield passed()
                        of, starts, ids, totals, size = [], [], [], [], 0
            if of:
                yield passed()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _packed(group: pa.Table, sequence: int) -> pa.Table:
    """The pieces of a group cut and placed."""
    group = group.sort_by("piece").combine_chunks()
    ids = group["ids"].to_pylist()
    slots = pack([len(x) // 4 for x in ids], sequence)
    item = pa.array([s.item for s in slots], pa.int64())
    first = group["group"][0].as_py() << 31
    return pa.table(
        {
            "doc_id": group["doc_id"].take(item),
            "start": pa.array(np.array([s.start for s in slots]) + group["start"].take(item).to_numpy(), pa.int64()),
            "ids": pa.array([ids[s.item][4 * s.start : 4 * (s.start + s.length)] for s in slots], pa.binary()),
            "doc_tokens": group["doc_tokens"].take(item),
            "sequence_id": pa.array([2 * (first + s.sequence) for s in slots], pa.int64()),
            "offset": pa.array([s.offset for s in slots], pa.int64()),
        }
    )


def pack_documents(
    docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, group: int = GROUP,
    id_column: str = "doc_id", text_column: str = "text", end: int = END,
) -> DataFrame:
    """One row per piece: doc_id, start, ids, doc_tokens, sequence_id, offset.

    The ids are written once; only rests shorter than a sequence are shuffled, by random groups.
    """
    cut = token_pieces(picked(docs, doc_id=id_column, text=text_column), path or vocabulary(), sequence, end)
    pieces = written(cut.withColumn("piece", F.monotonically_increasing_id()).withColumn("length", (F.octet_length("ids") / 4).cast("long")))
    whole = F.col("length") == sequence
    tokens = pieces.where(~whole).agg(F.sum("length")).first()[0] or 0
    groups = int(tokens // group) + 1
    schema = T.StructType(
        [*fields(pieces, ["doc_id", "start", "ids", "doc_tokens"]), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    rests = pieces.where(~whole).withColumn("group", F.pmod(F.xxhash64("piece", F.lit(13)), F.lit(groups)))
    packed = rests.groupBy("group").applyInArrow(lambda rows: _packed(rows, sequence), schema)
    full = pieces.where(whole).select(
        "doc_id", "start", "ids", "doc_tokens", (2 * F.col("piece") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return full.unionByName(packed)


def op13_packing(spark, folder: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece of documents."""
    packed = pack_documents(table(spark, folder, "documents"))
    length = (F.octet_length("ids") / 4).cast("long")
    return packed.select(
        "doc_id", "start", length.alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
