"""Shared helpers of the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.scratch import drop, new_path, shared_dir, written  # noqa: F401  (used by the operators)
from corpusmill.sources.tables import read_table

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of an Arrow batch by bytes, where texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


_caches: dict[str, Callable[[], None]] = {}


def cache(owner: str, clear: Callable[[], None]) -> None:
    """Register how to clear what an operator keeps in a Python worker between its tasks."""
    _caches[owner] = clear


def claim(owner: str) -> None:
    """At the start of a task: other operators' caches go, and freed memory goes back to the system, as workers serve one
    operator after another and an executor's memory holds all of its workers."""
    for name, clear in _caches.items():
        if name != owner:
            clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that an operator needs, so that no other column's name can clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BASE = 0x9FB21C651E98DF25  # odd: it has an inverse modulo 2**64
_CHUNK = 1 << 18
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and _BASE ** -i modulo 2**64 for i < n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, _CHUNK + 1)
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers.append(np.multiply.accumulate(x))
    return _powers[0][:n], _powers[1][:n]


def word_hashes(texts: list[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all texts' words (WORD), one text behind the other, and where each text ends among them.

    Works on UTF-8 bytes: white space and A-Z are single bytes.  Polynomials of the bytes come from running sums, chunk by
    chunk; a chunk ends at white space."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    stop = np.cumsum([len(r) + 1 for r in raw]) if raw else np.empty(0, np.int64)
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8) if raw else np.empty(0, np.uint8)
    if lower:
        data = data + (((data - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5))
    blank = (data == 32) | ((data - np.uint8(9)) < 5)
    hashes, starts = [], []
    at = 0
    while at < len(data):
        end = min(at + _CHUNK, len(data))
        if end < len(data):
            back = np.flatnonzero(blank[at:end])
            end = at + int(back[-1]) + 1 if len(back) else end + int(np.argmax(blank[end:])) + 1
        b = blank[at:end]
        edge = np.flatnonzero(b[1:] != b[:-1]) + 1
        edge = np.r_[0, edge] if not b[0] else edge
        begin, close = edge[::2], edge[1::2]  # the last byte is white space, so words end
        up, down = powers(end - at + 1)
        sums = np.zeros(end - at + 1, np.uint64)
        np.cumsum((data[at:end].astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        hashes.append(mix((sums[close] - sums[begin]) * down[begin]))
        starts.append(begin + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), stop)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words (or of the whole shorter sequence; none for no words), not made distinct."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    m = min(k, n)
    with np.errstate(over="ignore"):
        h = np.zeros(n - m + 1, np.uint64)
        for i in range(m):
            h = mix(h + words[i : n - m + 1 + i] + np.uint64(0x9E3779B97F4A7C15))
        if m < k:
            h = mix(h + np.uint64(m))
    return h
