"""LM scoring: cross-entropy difference of matched target and background bigram models over one vocabulary.

Both models have the same order, vocabulary (all words of the corpus, told apart by 64-bit hashes, and a document's end) and
smoothing: a bigram's counts are drawn to the model's word frequencies, and these to those of the corpus.  The background
counts all documents, the target those that the labels mark as good.  Every document is scored without its own counts in
either model, so that a target document gains nothing from having been counted.

Tables grow with the corpus and are never in one place:

1. documents are gathered into chunks of about `chunk_bytes` of text and written, as numbers of the chunk's own words;
2. each chunk asks for the counts of its distinct words and bigrams, once however often they occur in it: keys are dealt by
   their upper bits to slices, whose number grows with the tokens.  A task adds up one slice at a time and answers each
   chunk in the order of its keys, so that answers need none;
3. chunks meet their answers, and each document's losses are added up in one place and in one order.

A document's score is the mean over its words and its end of the target's loss less the background's, in bits: lower is
more like the target."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import claim, documents, id_text, mix, partitions, small_batches, word_hashes, written

FIRST_SLICES, SLICE_BITS = 10, 22
CHUNKS = "chunk long, n_tokens long, n_target long, payload binary"
ASKED = "slice long, chunk long, payload binary"
ANSWERED = "chunk long, slice long, n_words long, payload binary"
SCORED = "doc_id long, n_tokens long, target_bits double, background_bits double"
#: Weight of a word's frequency in its bigrams, and of the corpus's word frequencies in a model's, in counts; added to each word's count.
BACK_OFF, SHARED, ADD = 4.0, 1000.0, 0.1
_END, _START = np.uint64(0x51ED270B76A2D1C3), np.uint64(0xA24BAED4963EE407)


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def planes(numbers: np.ndarray, width: int) -> bytes:
    """The lowest bytes of numbers, byte by byte, so that like bytes lie together."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // max(1, width), 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    return out.view("<u8").reshape(-1)


def width_of(numbers: np.ndarray) -> int:
    return max(1, (int(numbers.max()).bit_length() + 7) // 8) if len(numbers) else 1


def packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length, each in as many bytes as its largest number needs."""
    widths = [width_of(c) for c in columns]
    return bytes(widths) + b"".join(planes(c, w) for c, w in zip(columns, widths, strict=True))


def unpacked(blob: bytes, count: int) -> list[np.ndarray]:
    widths, at, out = blob[:count], count, []
    rows = (len(blob) - count) // sum(widths)
    for w in widths:
        out.append(from_planes(blob[at : at + rows * w], w))
        at += rows * w
    return out


class Chunk:
    """Some documents: ids, whether each counts for the target, words of each, and all words as places in `vocabulary`,
    the hashes of the distinct words from frequent to rare."""

    def __init__(self, ids: list[int | None], good: np.ndarray, n: np.ndarray, vocabulary: np.ndarray, words: np.ndarray) -> None:
        self.ids, self.good, self.n, self.vocabulary, self.words = ids, good, n, vocabulary, words

    @classmethod
    def of(cls, ids: list[int | None], good: np.ndarray, texts: list[str | None]) -> Chunk:
        h, ends = word_hashes(texts, lower=True)
        vocabulary, place, times = np.unique(h, return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        return cls(ids, good, np.diff(np.r_[0, ends]), vocabulary[order], number[place])

    def payload(self) -> bytes:
        head = np.array([len(self.ids), len(self.vocabulary)], "<u8").tobytes()
        flags = np.array([i is not None for i in self.ids], np.uint8) | (self.good.astype(np.uint8) << 1)
        ids = np.array([i or 0 for i in self.ids], "<i8")
        return head + ids.tobytes() + flags.tobytes() + self.n.astype("<u4").tobytes() + self.vocabulary.astype("<u8").tobytes() + zlib.compress(packed(self.words), 1)

    @classmethod
    def read(cls, blob: bytes) -> Chunk:
        docs, size = np.frombuffer(blob, "<u8", 2).tolist()
        at = 16
        parts = []
        for kind, count in (("<i8", docs), ("u1", docs), ("<u4", docs), ("<u8", size)):
            parts.append(np.frombuffer(blob, kind, count, at))
            at += parts[-1].nbytes
        ids, flags, n, vocabulary = parts
        return cls([i if f & 1 else None for i, f in zip(ids.tolist(), flags.tolist(), strict=True)], flags > 1, n.astype(np.int64), vocabulary, unpacked(zlib.decompress(blob[at:]), 1)[0].astype(np.int64))

    def steps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, word before and word of each step; every document with words ends in a step to the end, which is the
        place behind the vocabulary, as is the start before the first word."""
        some = np.flatnonzero(self.n)
        n = self.n[some] + 1
        ends = np.cumsum(n) - 1
        word = np.full(int(n.sum()), len(self.vocabulary), np.int64)
        own = np.ones(len(word), bool)
        own[ends] = False
        word[own] = self.words
        before = np.r_[len(self.vocabulary), word[:-1]] if len(word) else word
        return np.repeat(some, n), before, word

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of the distinct words (odd) and bigrams (even), where each word of the vocabulary and the end stand
        among them, and where each step's bigram does."""
        _, before, word = self.steps()
        hashes = np.r_[self.vocabulary, _END]
        one = mix(hashes) | np.uint64(1)
        with np.errstate(over="ignore"):
            first = mix(np.r_[self.vocabulary, _START]) * np.uint64(0x9E3779B97F4A7C15)
            two = mix(first[before] + hashes[word]) & ~np.uint64(1)
        keys, place = np.unique(np.r_[one, two], return_inverse=True)
        return keys, place[: len(one)], place[len(one) :]

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys with their counts in all documents of the chunk and in those of the target."""
        keys, one, two = self.keys()
        doc, _, word = self.steps()
        good = self.good[doc]
        return keys, *(np.bincount(one[word[x]], minlength=len(keys)) + np.bincount(two[x], minlength=len(keys)) for x in (slice(None), good))

    def scores(self, answers: list[np.ndarray], totals: tuple[int, int], vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each document in the target and the background, its own counts left out."""
        _, one, two = self.keys()
        doc, before, word = self.steps()
        size = len(self.vocabulary) + 1
        own_word, own_pair, own_before = (self.own(doc, x, width) for x, width in ((word, size), (two, len(answers[0])), (before, size)))
        n = (self.n + 1)[doc]
        out, shared = [], np.empty(0)
        for counts, total, mine in zip(answers, totals, (np.ones(len(doc)), self.good[doc].astype(float)), strict=True):
            c_word, c_before, c_pair = counts[one][word] - mine * own_word, counts[one][before] - mine * own_before, counts[two] - mine * own_pair
            rest = total - mine * n
            if not out:
                shared = (c_word + ADD) / (rest + ADD * vocabulary)
            frequency = (c_word + SHARED * shared) / (rest + SHARED)
            bits = -np.log2((c_pair + BACK_OFF * frequency) / (c_before + BACK_OFF))
            out.append(np.bincount(doc, weights=bits, minlength=len(self.n)))
        return out[1], out[0]

    @staticmethod
    def own(doc: np.ndarray, what: np.ndarray, width: int) -> np.ndarray:
        """How often each step's thing occurs in its document."""
        _, place, times = np.unique(doc * width + what, return_inverse=True, return_counts=True)
        return times[place]


def gathered(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("lm_score")
        number = TaskContext.get().partitionId() << 32
        held: list[list] = [[], [], []]
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held, size
            good = np.array(held[2], bool)
            chunk = Chunk.of(held[0], good, held[1])
            number, held, size = number + 1, [[], [], []], 0
            n = chunk.n + (chunk.n > 0)
            return pa.record_batch([pa.array([number - 1]), pa.array([int(n.sum())]), pa.array([int(n[good].sum())]), pa.array([chunk.payload()], pa.binary())], names=names(CHUNKS))

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for column, x in zip(held, row, strict=True):
                    column.append(x)
                size += len(row[1] or "") + 16
                if size >= chunk_bytes:
                    yield flush()
        if held[0]:
            yield flush()

    return run


def slices(total: int) -> int:
    """Slices for a corpus of so many tokens: 2**FIRST_SLICES at first, then one for every 2**SLICE_BITS tokens or fewer."""
    return 1 << max(FIRST_SLICES, (total >> SLICE_BITS).bit_length())


def asked(count: int):
    shift = np.uint64(65 - count.bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys, every, good = Chunk.read(blob.as_py()).counts()
                part = (keys >> shift).astype(np.int64)
                cut = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)]), len(part)]
                for a in range(0, len(cut) - 1, 256):
                    bounds = cut[a : a + 257].tolist()
                    blobs = [packed(keys[i:j], every[i:j], good[i:j]) for i, j in zip(bounds, bounds[1:], strict=False)]
                    yield pa.record_batch([pa.array(part[cut[a : a + len(blobs)]]), pa.array(np.full(len(blobs), chunk)), pa.array(blobs, pa.binary())], names=names(ASKED))

    return run


def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by slice.  A row for each chunk that asks, then one (chunk -1) with the slice's distinct words."""
    now, chunks, parts = None, [], []

    def flush() -> pa.RecordBatch:
        sizes = [len(p[0]) for p in parts]
        keys, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        sums = [np.bincount(place, weights=np.concatenate([p[i] for p in parts]), minlength=len(keys)).astype(np.int64)[place] for i in (1, 2)]
        ends = np.cumsum(sizes).tolist()
        blobs = [packed(*(s[e - n : e] for s in sums)) for n, e in zip(sizes, ends, strict=True)]
        rows = len(blobs) + 1
        return pa.record_batch([pa.array([*chunks, -1]), pa.array(np.full(rows, now)), pa.array([0] * len(blobs) + [int((keys & np.uint64(1)).sum())]), pa.array([*blobs, None], pa.binary())], names=names(ANSWERED))

    for batch in batches:
        for part, chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if part != now:
                if parts:
                    yield flush()
                now, chunks, parts = part, [], []
            chunks.append(chunk)
            parts.append(unpacked(blob.as_py(), 3))
    if parts:
        yield flush()


def scored(totals: tuple[int, int], vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by chunk, the chunk itself before its answers, which come by slice."""
        chunk: Chunk | None = None
        answers: list[list[np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            both = [np.concatenate([a[i] for a in answers]).astype(float) if answers else np.empty(0) for i in (0, 1)]
            bits = chunk.scores(both, totals, vocabulary)
            means = [pa.array(np.round(b / (chunk.n + 1), 6), mask=chunk.n == 0) for b in bits]
            return pa.record_batch([pa.array(chunk.ids, pa.int64()), pa.array(chunk.n), *means], names=names(SCORED))

        for batch in batches:
            for part, blob in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                if part < 0:
                    if chunk:
                        yield flush()
                    chunk, answers = Chunk.read(blob.as_py()), []
                else:
                    answers.append(unpacked(blob.as_py(), 2))
        if chunk:
            yield flush()

    return run


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 5 << 20, most_broadcast: int = 2_000_000) -> DataFrame:
    """doc_id, n_tokens, target_bits, background_bits, difference per row of docs; target_ids has a column doc_id.

    Words are runs of other than white space with A-Z lower-cased.  Texts without words (null, empty) have n_tokens 0 and null
    figures.  Rows that repeat count and are scored like others, each without its own counts only; rows with a null id are
    background only; without any target row the target model is the corpus's word frequencies; an empty table gives no
    rows; other columns are ignored.  Target ids are broadcast up to `most_broadcast` of them and joined beyond."""
    spark = docs.sparkSession
    small_batches(spark)
    ids = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct().withColumn("good", F.lit(True))
    ids = F.broadcast(ids) if ids.count() <= most_broadcast else ids
    flagged = id_text(docs, id_col, text_col).join(ids, "doc_id", "left").select("doc_id", "text", F.coalesce("good", F.lit(False)))
    chunks = written(flagged.mapInArrow(gathered(chunk_bytes), CHUNKS), "chunks")
    total, target = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_target"), F.lit(0))).first()
    dealt = chunks.select("chunk", "payload").mapInArrow(asked(slices(total)), ASKED).repartition(partitions(spark), "slice").sortWithinPartitions("slice", "chunk")
    answers = written(dealt.mapInArrow(answered, ANSWERED), "answers")
    vocabulary = answers.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    rows = chunks.select("chunk", F.lit(-1).cast("long").alias("slice"), "payload").union(answers.filter("chunk >= 0").select("chunk", "slice", "payload"))
    rows = rows.repartition(partitions(spark), "chunk").sortWithinPartitions("chunk", "slice")
    found = rows.mapInArrow(scored((total, target), vocabulary), SCORED)
    return found.withColumn("difference", F.round(F.col("target_bits") - F.col("background_bits"), 6))


def op6_lm_score(spark, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return cross_entropy_difference(documents(spark, sf_dir), labels.filter("quality = 1"))
