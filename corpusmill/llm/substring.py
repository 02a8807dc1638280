"""Substring dedup: compacted de Bruijn graph of long token k-mers.

A window of `window` consecutive words is an edge between two nodes of window - 1 words.  Edges next to each other that
share their leftmost least m-mer (their minimizer) form one piece of a nonbranching path.  Minimizers depend on content
alone, so a passage that repeats is cut into the same pieces wherever it stands, but for its two ends.  Then

1. pieces are compacted by Spark: one row for each distinct (minimizer, content hash) with its count;
2. a piece that occurs twice repeats with all of its edges;
3. a piece that occurs once can share edges only with pieces of the same minimizer.  Where a minimizer has several
   distinct pieces, the path branches: its pieces open into single edges, which are counted;
4. the source coordinates (document, word position) of all repeated edges become spans, laid over the words again.

Minimizer and content hash make a key of 128 bits, by which edges are told apart.  About one row for fifteen words is
shuffled, and of the texts those with open pieces and those that lose words; a filter clears the others."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.bloom import bloom
from corpusmill.llm.common import WORD, claim, documents, drop, mix, small_batches, word_hashes, written

PIECES = "mh long, sk long, k1 long, k2 long, at long"
EDGES = "mh long, wh long, k1 long, k2 long, pos long"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
_B = 0xD6E8FEB86659FD93  # odd: it has an inverse modulo 2**64
_INDEX_BITS = 28
_STRETCH = 2 << 20  # bytes of texts whose words are held at once

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_B ** i and _B ** -i modulo 2**64 for i < n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers[:] = []
        for base in (_B, pow(_B, -1, 1 << 64)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers.append(np.multiply.accumulate(x))
    return _powers[0][:n], _powers[1][:n]


class Rolling:
    """Hash of any run of words in constant time."""

    def __init__(self, words: np.ndarray) -> None:
        up, self.down = powers(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.down[start])


def pieces_of(words: np.ndarray, ends: np.ndarray, window: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """minimizer, content hash, document, first word (in the whole stream) and number of edges of each piece.

    words: hashes of all documents' words, one behind the other; ends: where each document ends."""
    n = len(words)
    none = np.empty(0, np.int64)
    if n < window:
        return none, none, none, none, none
    rolling = Rolling(words)
    grams = rolling(np.arange(n - m + 1), m)
    low = np.uint64((1 << _INDEX_BITS) - 1)
    x = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    span, reach = window - m + 1, 1
    while 2 * reach <= span:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    if span > reach:
        x = np.minimum(x[: len(x) - (span - reach)], x[span - reach :])
    doc = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))[: n - window + 1]
    valid = np.flatnonzero(np.arange(n - window + 1) + window <= ends[doc])
    if not len(valid):
        return none, none, none, none, none
    least = (x[valid] & low).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (np.diff(valid) != 1) | (np.diff(least) != 0)])
    edges = np.diff(np.r_[first, len(valid)])
    start = valid[first]
    return grams[least[first]].view(np.int64), rolling(start, window - 1 + edges).view(np.int64), doc[start], start, edges


def emit_pieces(window: int, m: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring")
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy())
            for part in range(0, int(size[-1] if len(size) else 0) + 1, _STRETCH):
                # stretches of rows, so that little more than the texts is held
                a, b = np.searchsorted(size, [part, part + _STRETCH])
                if a < b:
                    yield pieces_batch(batch.slice(a, b - a), window, m)

    return run


def pieces_batch(batch: pa.RecordBatch, window: int, m: int) -> pa.RecordBatch:
    words, ends = word_hashes(batch.column(2).to_pylist())
    mh, sk, doc, start, edges = pieces_of(words, ends, window, m)
    k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    begins = np.r_[0, ends[:-1]] if len(ends) else ends
    return pa.record_batch([pa.array(v, pa.int64()) for v in (mh, sk, k1[doc], k2[doc], ((start - begins[doc]) << 6) | edges)], names=[c.split()[0] for c in PIECES.split(", ")])


def emit_edges(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring")
        held: list[list[np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            cols = [pa.array(np.concatenate([x[i] for x in held]), pa.int64()) for i in range(5)]
            held.clear()
            return pa.record_batch(cols, names=[c.split()[0] for c in EDGES.split(", ")])

        for batch in batches:
            for k1, k2, text, listed in zip(*(batch.column(i) for i in range(4)), strict=True):
                k1, k2, listed = k1.as_py(), k2.as_py(), listed.as_py()
                rolling = Rolling(word_hashes([text.as_py()])[0])
                at = np.array([x["at"] for x in listed], np.int64)
                start, n = at >> 6, at & 63
                pos = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
                mh = np.repeat(np.array([x["mh"] for x in listed], np.int64), n)
                held.append([mh, rolling(pos, window).view(np.int64), np.full(len(pos), k1), np.full(len(pos), k2), pos])
                if sum(len(x[0]) for x in held[-64:]) >= 1 << 16 or len(held) >= 64:
                    yield flush()
        if held:
            yield flush()

    return run


def laid_out(rows: Iterable[tuple[int | None, str | None, list[int] | None, list[int] | None]], window: int, with_text: bool) -> pa.RecordBatch:
    """RESULT of rows (doc_id, text, pieces, edges) that are repeated."""
    out = []
    for doc_id, text, pieces, edges in rows:
        words = WORD.findall(text) if text else []
        if pieces or edges:
            steps = np.zeros(len(words) + 1, np.int64)
            if pieces:
                at = np.array(pieces, np.int64)
                np.add.at(steps, at >> 6, 1)
                np.add.at(steps, (at >> 6) + (at & 63) + window - 1, -1)
            if edges:
                pos = np.array(edges, np.int64)
                np.add.at(steps, pos, 1)
                np.add.at(steps, pos + window, -1)
            keep = np.cumsum(steps[:-1]) == 0
            kept = " ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])
            removed = len(words) - int(keep.sum())
        else:
            kept, removed = " ".join(words), 0
        out.append((doc_id, len(words), removed, hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest(), kept if with_text else None))
    cols = list(zip(*out, strict=True)) or [[]] * 5
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string()] * 2, strict=True)], names=[c.split()[0] for c in RESULT.split(", ")])


def lay_out(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield laid_out(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True), window, with_text)

    return run


def lay_out_clear(wanted, window: int, with_text: bool):
    """RESULT of the rows (doc_id, text, k1, k2, doc) that the filter clears: they lose nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~wanted.value.has(batch.column(4).to_numpy())))
            yield laid_out(((d, t, None, None) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)), window, with_text)

    return run


def held(wanted):
    """The rows that the filter holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(wanted.value.has(batch.column(4).to_numpy())))

    return run


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 35, m: int = 8, with_text: bool = True) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and kept (its remaining words, one space between; null without with_text).

    A word goes if a window that covers it also starts anywhere else, in the same document or in another one.  Null and
    empty texts have no words; texts shorter than a window lose nothing.  Rows that repeat are occurrences like any
    other, so both lose their windows.  Rows with a null id are kept apart by their text.  Other columns are ignored."""
    spark = docs.sparkSession
    small_batches(spark)
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).select("doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k1"), F.xxhash64("text").alias("k2"))
    keyed = keyed.withColumn("doc", F.xxhash64("k1", "k2"))

    def rows_of(keys: DataFrame):
        """A filter of documents (k1, k2), and the rows that it holds."""
        wanted = spark.sparkContext.broadcast(bloom(keys.select(F.xxhash64("k1", "k2").alias("doc"))))
        return wanted, keyed.mapInArrow(held(wanted), keyed.schema)

    pieces = written(keyed.select("k1", "k2", "text").mapInArrow(emit_pieces(window, m), PIECES), "pieces")
    compact = pieces.groupBy("mh", "sk").agg(F.count("*").alias("n"))
    branches = compact.groupBy("mh").agg(F.count("*").alias("paths")).filter("paths > 1").select("mh", F.lit(True).alias("branch"))
    marked = compact.join(branches, "mh", "left").filter("n > 1 or branch").select("mh", "sk", (F.col("n") > 1).alias("twice"), F.coalesce("branch", F.lit(False)).alias("branch"))
    # written, so that what it is joined with can be split where a key is hot
    marked = written(marked, "paths")
    found = written(pieces.join(marked, ["mh", "sk"]).select("k1", "k2", "at", "mh", "twice", "branch"), "found")
    drop(pieces)
    drop(marked)
    open_ = found.filter("branch").groupBy("k1", "k2").agg(F.collect_set(F.struct("at", "mh")).alias("listed"))
    # counts come from all rows: repeated rows share k1 and k2 and are one row in open_
    copies = rows_of(found.filter("branch").select("k1", "k2").distinct())[1].select("k1", "k2", "text")
    edges = written(copies.join(open_, ["k1", "k2"]).select("k1", "k2", "text", "listed").mapInArrow(emit_edges(window), EDGES), "edges")
    repeated = written(edges.groupBy("mh", "wh").agg(F.count("*").alias("n")).filter("n > 1").select("mh", "wh"), "repeated")
    single = edges.join(repeated, ["mh", "wh"]).groupBy("k1", "k2").agg(F.collect_set("pos").alias("edges"))
    whole = found.filter("twice").groupBy("k1", "k2").agg(F.collect_set("at").alias("pieces"))
    spans = written(whole.join(single, ["k1", "k2"], "full"), "spans")
    drop(edges)
    wanted, rest = rows_of(spans)
    rest = rest.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "pieces", "edges").mapInArrow(lay_out(window, with_text), RESULT)
    return keyed.mapInArrow(lay_out_clear(wanted, window, with_text), RESULT).union(rest)


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
