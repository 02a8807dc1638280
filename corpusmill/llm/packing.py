"""Packing: order-preserving dynamic programming over window cuts.

Documents are range-partitioned by doc_id and each partition's id stream is cut into windows of at most `window` ids.
Cuts fall on document or sentence ends (spans without either get evenly spaced forced cuts).  The cost of a plan is the
padding of its windows plus a penalty for each cut that splits a document; with
f(i) = min over j of f(j) + window - (p_i - p_j) + penalty_i, the minimum over the sliding range p_j >= p_i - window of
f(j) + p_j comes from a monotone queue.  Windows whose length is a power of two need no padding and are extra transitions."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import documents, id_text, partitions, small_batches
from corpusmill.llm.tokens import default_path, with_ends, word_bpe

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def cut_points(ids: np.ndarray, ends: np.ndarray, ends_sentence: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cuts of a stream (0 and its end among them) and each one's class: 0 document, 1 sentence, 2 forced.
    ends: the positions just behind each document."""
    n = len(ids)
    kind = np.full(n + 1, 9, np.int8)
    kind[1:][ends_sentence[np.minimum(ids, len(ends_sentence) - 1)]] = 1
    kind[ends] = 0
    kind[0] = kind[n] = 0
    at = np.flatnonzero(kind < 9)
    wide = np.flatnonzero(np.diff(at) > gap)
    for i in wide:
        kind[at[i] + gap : at[i + 1] : gap] = 2
    at = np.flatnonzero(kind < 9)
    return at, kind[at]


def plan(at: np.ndarray, kind: np.ndarray, window: int, penalties: tuple[float, float, float], short: float) -> list[int]:
    """Positions of the cheapest cuts, first and last included.  Ties take the longest window."""
    m = len(at)
    p = at.tolist()
    pen = np.asarray(penalties, float)[kind].tolist()
    exact: dict[int, list[int]] = {}
    size = 1
    while size <= window:
        j = np.searchsorted(at, at - size)
        for i in np.flatnonzero((at >= size) & (at[np.minimum(j, m - 1)] == at - size)).tolist():
            exact.setdefault(i, []).append(int(j[i]))
        size *= 2
    f, g, back = [0.0] * m, [0.0] * m, [0] * m
    queue: deque[int] = deque([0])
    for i in range(1, m):
        here = p[i]
        while p[queue[0]] < here - window:
            queue.popleft()
        j = queue[0]
        best = g[j] + window - here
        if i in exact:
            for x in exact[i]:
                if (c := f[x] + (short if here - p[x] < window else 0)) < best:
                    best, j = c, x
        f[i] = best + pen[i]
        g[i] = f[i] + here
        back[i] = j
        while queue and g[queue[-1]] > g[i]:
            queue.pop()
        queue.append(i)
    cuts, i = [p[-1]], m - 1
    while i:
        i = back[i]
        cuts.append(p[i])
    return cuts[::-1]


def packer(path: str, window: int, gap: int, penalties: tuple[float, float, float], short: float, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        made = 0
        ids = np.empty(0, "<u4")
        rows: list[int | None] = []  # doc_id
        first, lengths, full = (np.empty(0, np.int64) for _ in range(3))  # first id of it here, ids here, all its ids

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal made, ids, rows, first, lengths, full
            ends = np.cumsum(lengths)
            cuts = plan(*cut_points(ids, ends, bpe.ends_sentence, gap), window, penalties, short)
            if not last and len(cuts) > 2:
                cuts.pop()  # the last window goes on with what follows
            stop = cuts[-1]
            starts = ends - lengths
            edges = np.union1d(np.asarray(cuts), starts[starts < stop])
            a, b = edges[:-1], edges[1:]
            doc = np.searchsorted(ends, a, side="right")
            seq = np.searchsorted(np.asarray(cuts), a, side="right") - 1
            own = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(a), [None, pa.py_buffer(4 * edges), pa.py_buffer(ids[:stop])])
            columns = [rows[i] for i in doc.tolist()], first[doc] + a - starts[doc], b - a, own.cast(pa.binary()), full[doc], base + made + seq, a - np.asarray(cuts)[seq]
            out = pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in PIECES.split(", ")])
            made += len(cuts) - 1
            done = int(np.searchsorted(ends, stop, side="right"))
            skip = np.maximum(0, stop - starts[done:])
            ids, rows, first, lengths, full = ids[stop:], rows[done:], first[done:] + skip, lengths[done:] - skip, full[done:]
            return out

        for batch in batches:
            new, ends = with_ends(*bpe.encode_all(batch.column(1)))
            n = np.diff(np.r_[0, ends])
            ids, rows = np.r_[ids, new], rows + batch.column(0).to_pylist()
            first, lengths, full = np.r_[first, np.zeros(len(n), np.int64)], np.r_[lengths, n], np.r_[full, n]
            if len(ids) >= block:
                yield flush(False)
        if rows:
            yield flush(True)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 4096,
    gap: int = 256,
    penalties: tuple[float, float, float] = (0.0, 4.0, 16.0),
    short: float = 24.0,
    block: int = 400_000,
) -> DataFrame:
    """Pieces of documents in sequences of at most `window` ids, in ascending id order.

    Each document is its ids and the end id.  A null or empty text is the end id alone.  Rows that repeat an id are
    packed each on its own, null ids first; an empty table gives no pieces.  Other columns are ignored.  `ids` are
    little-endian unsigned 32-bit integers.  penalties: cost in padding ids of a cut behind a document, behind a
    sentence and elsewhere; short: cost of a sequence that is a smaller power of two.  sequence_id is unique and
    ascending, not gapless: the partition's number stands in its upper bits."""
    spark = docs.sparkSession
    small_batches(spark)
    ordered = id_text(docs, id_col, text_col).repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(packer(tokenizer or default_path(), window, gap, penalties, short, block), PIECES)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir)).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
