"""A bit map of long keys, made by aggregation: keeps rows that can't meet a partner from being moved."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Powers of two of a map's bits. Past the largest more keys pass than need to; none is lost.
SMALLEST, LARGEST = 16, 27


def spread(keys: np.ndarray, bits: int) -> np.ndarray:
    """The place of every key in a map of ``2 ** bits`` bits."""
    return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


class KeyBits:
    """Holds all keys of a long column, and some others. The map has 16 bits a key, between the two sizes."""

    def __init__(self, keys: DataFrame, column: str):
        self.bits = bits = min(max((16 * keys.count()).bit_length(), SMALLEST), LARGEST)

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = spread(batch.column(0).to_numpy(), bits).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at >> 15), pa.array(at & 32767)], names=["at", "bit"])

        rows = keys.select(column).mapInArrow(placed, "at long, bit long").groupBy("at").agg(F.bitmap_construct_agg("bit").alias("bits"))
        self.map = np.zeros(1 << (bits - 3), np.uint8)
        for r in rows.toLocalIterator():  # as many bytes as the map has
            self.map[r["at"] << 12 : (r["at"] + 1) << 12] = np.frombuffer(bytes(r["bits"]), np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = spread(keys, self.bits)
        return (self.map[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
