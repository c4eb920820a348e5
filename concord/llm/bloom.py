"""Bloom filters of fixed largest size over 64-bit hashes, built by Spark tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK_BITS = 13
#: Largest size of a filter in bytes. With more hashes than fit, more values pass; none is lost.
LARGEST = 1 << 24
BITS_PER_VALUE = 16


def _blocks(values: int, largest: int) -> int:
    wanted = max(1, values * BITS_PER_VALUE) >> BLOCK_BITS
    return min(1 << wanted.bit_length(), (largest * 8) >> BLOCK_BITS)


def _places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << BLOCK_BITS) - 1)
    block = ((hashes >> np.uint64(32)) & np.uint64(blocks - 1)) << np.uint64(BLOCK_BITS)
    return block | (hashes & low), block | ((hashes >> np.uint64(BLOCK_BITS)) & low)


class Bloom:
    def __init__(self, hashes: DataFrame, column: str):
        """hashes: a written table. What passes the driver is the filter itself, LARGEST bytes at most."""
        blocks = _blocks(hashes.count(), LARGEST)

        def set_bits(batches):
            seen: dict[int, np.ndarray] = {}
            for b in batches:
                values = b[column].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                for where in _places(values, blocks):
                    where = np.unique(where)
                    part = (where >> np.uint64(BLOCK_BITS)).astype(np.int64)
                    for block in np.unique(part):
                        bits = seen.setdefault(int(block), np.zeros(1 << BLOCK_BITS, bool))
                        bits[(where[part == block] & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)] = True
            if seen:
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array(list(seen), pa.int64()), "bits": pa.array([np.packbits(x).tobytes() for x in seen.values()])}
                )

        def merged(pdf: pd.DataFrame) -> pd.DataFrame:
            bits = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in pdf["bits"]])
            return pd.DataFrame({"block": pdf["block"][:1], "bits": [bits.tobytes()]})

        schema = "block long, bits binary"
        whole = np.zeros((blocks, 1 << (BLOCK_BITS - 3)), np.uint8)
        for block, bits in hashes.select(column).mapInArrow(set_bits, schema).groupBy("block").applyInPandas(merged, schema).collect():
            whole[block] = np.frombuffer(bits, np.uint8)
        self.blocks = blocks
        self.bits = hashes.sparkSession.sparkContext.broadcast(whole.reshape(-1))

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        """True for every hash of the table, and for a few others."""
        bits = self.bits.value
        out = np.ones(len(hashes), bool)
        for where in _places(hashes, self.blocks):
            out &= (bits[(where >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (where & np.uint64(7)).astype(np.uint8))) & 1 == 1
        return out
