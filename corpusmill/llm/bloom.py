"""Bloom filters that tell which rows a join can't need, before they are shuffled."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusmill.llm.common import mix

BITS = 20, 27  # as powers of two; about ten bits for each key


class Bloom:
    """A Bloom filter of integers, packed."""

    def __init__(self, size: int) -> None:
        self.size = min(BITS[1], max(BITS[0], (10 * size).bit_length()))
        self.bits = np.zeros(1 << (self.size - 3), np.uint8)

    def cells(self, ids: np.ndarray) -> np.ndarray:
        """Three cells for each id."""
        x = mix(ids.astype(np.int64).view(np.uint64))
        y = mix(x + np.uint64(1)) | np.uint64(1)
        with np.errstate(over="ignore"):
            return np.stack([(x + np.uint64(i) * y) >> np.uint64(64 - self.size) for i in range(3)]).astype(np.int64)

    def has(self, ids: np.ndarray) -> np.ndarray:
        at = self.cells(ids)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(0)

    def packed(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's part of the filter."""
        bits = np.zeros(1 << self.size, bool)
        for batch in batches:
            bits[self.cells(batch.column(0).to_numpy()).reshape(-1)] = True
        yield pa.record_batch([pa.array([zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)], pa.binary())], names=["bits"])


def bloom(keys: DataFrame) -> Bloom:
    """A filter of one column of integers: about ten bits for each, up to 2**27 bits, beyond which more others pass it."""
    keys = keys.checkpoint()
    out, empty = Bloom(keys.count()), Bloom(0)
    empty.size = out.size
    for r in keys.coalesce(8).mapInArrow(empty.packed, "bits binary").toLocalIterator():
        out.bits |= np.frombuffer(zlib.decompress(bytes(r.bits)), np.uint8)
    return out
