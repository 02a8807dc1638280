"""Token-ID files: Re-Pair grammar compression per shard.

A shard file is a block of documents in ascending doc_id order, as one row of a Parquet table in the shared folder (only
Spark's writers reach every store).  Its payload, all integers little-endian:

    magic "RPG2" | u32 terminals, documents, rules, symbols
    i64 doc_id and u8 has_id per document | u32 ids per document | u32 symbols per document
    u32 left, u32 right per rule | u32 expansion length per rule | u32 symbols

Symbols below `terminals` are token ids, the others are rules, whose parts are earlier symbols.  No rule spans two documents.
Pairs are replaced in rounds until none occurs twice without overlap: a round counts all pairs that can repeat and replaces
each occurrence of a pair that is more frequent than the pairs it overlaps with, which may be many pairs at once.  A pair that
occurs once can't become frequent again, so later rounds look at the others and at what stands beside new symbols only.
The expansion lengths give any id of any document without decoding what is before it (`decode_range`)."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import documents, id_text, new_path, partitions, small_batches
from corpusmill.llm.tokens import default_path, with_ends, word_bpe

SHARDS = "part int, block int, start_in_part long, n_docs long, n_tokens long, payload binary"
DECODED = "part int, doc_id long, start_in_part long, n_tokens long, ids binary"
_HEAD = struct.Struct("<4sIIII")


def sorted_pairs(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order with their places; one sort of plain numbers where both fit into 63 bits."""
    width = int(at.max()).bit_length()
    if int(key.max()).bit_length() + width <= 63:
        both = np.sort((key << width) | at)
        return both >> width, both & ((1 << width) - 1)
    order = np.argsort(key, kind="stable")
    return key[order], at[order]


def second_of_run(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of the places of pairs of one symbol with itself, those that overlap the one before: every second of a run."""
    at = np.sort(at)
    first = np.r_[True, after[at[:-1]] != at[1:]]
    run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - run) % 2 == 1]


def repair(ids: np.ndarray, last: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Replace repeated pairs by rules until none is left.  last: whether an id ends its document.  Returns symbols, their
    `last` and the rules (n x 2) of each round."""
    n, symbols, rules = len(ids), terminals, []
    # narrow arrays stay in the cache
    kind = np.int32 if terminals + n < 1 << 31 else np.int64
    symbol = np.r_[ids, 0].astype(kind)
    # linked list; place n stands for no neighbour
    after, before = np.arange(1, n + 2, dtype=kind), np.arange(-1, n, dtype=kind)
    ends = np.flatnonzero(last)
    after[ends] = after[n] = n
    before[0] = n
    before[ends[:-1] + 1] = n
    alive = np.ones(n + 1, bool)
    alive[n] = False
    rank = np.zeros(n + 1, np.int64)
    active = np.flatnonzero(after[:n] < n)
    while len(active):
        width = symbols.bit_length()
        key, at = (symbol[active].astype(np.int64) << width) | symbol[after[active]], active
        if rules:
            # a table of counts tells most of the pairs that occur once
            bits = max(8, len(at).bit_length() + 1)
            slot = ((key * np.int64(-7046029254386353131)) >> np.int64(64 - bits)) & np.int64((1 << bits) - 1)
            several = (np.bincount(slot, minlength=1 << bits) > 1)[slot]
            if not several.any():
                break
            key, at = key[several], at[several]
        key, at = sorted_pairs(key, at)
        new = np.r_[True, key[1:] != key[:-1]]
        start = np.flatnonzero(new)
        count = np.diff(np.r_[start, len(key)])
        pair, which = key[start], np.repeat(np.arange(len(start)), count)
        repeats = np.repeat(count > 1, count)
        at, which = at[repeats], which[repeats]
        if not len(at):
            break
        own = (pair >> width) == (pair & ((1 << width) - 1))
        shadowed = np.empty(0, np.int64)
        if own[which].any():
            shadowed = second_of_run(at[own[which]], after)
            rank[at] = which
            count = count - np.bincount(rank[shadowed], minlength=len(count))
        rank[at] = np.where(count[which] > 1, (count[which] << 32) | (which + 1), 0)
        rank[shadowed] = 0
        mine = rank[at]
        if not mine.any():
            rank[at] = 0
            break
        chosen = (mine > rank[before[at]]) & (mine > rank[after[at]])
        rank[at] = 0
        spot, of = at[chosen], which[chosen]
        made = np.bincount(of, minlength=len(count)) > 1
        spot, of = spot[made[of]], of[made[of]]
        made = np.flatnonzero(made)
        made = made[np.argsort(-count[made], kind="stable")]
        number = np.zeros(len(count), np.int64)
        number[made] = symbols + np.arange(len(made))
        rules.append(np.stack([pair[made] >> width, pair[made] & ((1 << width) - 1)], 1))
        symbols += len(made)
        gone = after[spot]
        symbol[spot] = number[of]
        after[spot] = after[gone]
        before[after[gone]] = spot
        alive[gone] = False
        look = np.zeros(n + 1, bool)
        look[at] = look[spot] = look[before[spot]] = True
        active = np.flatnonzero(look & alive)
        active = active[after[active] < n]
    left = np.flatnonzero(alive)
    return symbol[left], after[left] == n, rules


def encode_shard(doc_ids: list[int | None], ids: np.ndarray, lengths: np.ndarray, terminals: int) -> bytes:
    """A payload; ids: of all documents, each of at least one id."""
    last = np.zeros(len(ids), bool)
    last[np.cumsum(lengths) - 1] = True
    seq, last, rules = repair(ids, last, terminals)
    spans = np.ones(terminals, np.int64)
    for r in rules:
        spans = np.r_[spans, spans[r[:, 0]] + spans[r[:, 1]]]
    pairs = np.concatenate(rules) if rules else np.empty((0, 2), np.int64)
    return b"".join(
        [
            _HEAD.pack(b"RPG2", terminals, len(lengths), len(pairs), len(seq)),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is not None for d in doc_ids], "u1").tobytes(),
            lengths.astype("<u4").tobytes(),
            np.diff(np.r_[-1, np.flatnonzero(last)]).astype("<u4").tobytes(),
            pairs.astype("<u4").tobytes(),
            spans[terminals:].astype("<u4").tobytes(),
            seq.astype("<u4").tobytes(),
        ]
    )


class Shard:
    """A payload's tables; documents are expanded on demand."""

    def __init__(self, payload: bytes) -> None:
        magic, self.terminals, n, r, s = _HEAD.unpack_from(payload)
        if magic != b"RPG2":
            raise ValueError("not a shard file")
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, count, at)
            at += out.nbytes
            return out

        ids, known = take("<i8", n), take("u1", n)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known, strict=True)]
        self.lengths, per_doc = take("<u4", n).astype(np.int64), take("<u4", n).astype(np.int64)
        self.rules, self.spans, self.symbols = take("<u4", 2 * r).reshape(r, 2), take("<u4", r), take("<u4", s)
        self.bounds = np.r_[0, np.cumsum(per_doc)]

    def span(self, symbols: np.ndarray) -> np.ndarray:
        """Expansion lengths."""
        out = np.ones(len(symbols), np.int64)
        rule = symbols >= self.terminals
        out[rule] = self.spans[symbols[rule] - self.terminals]
        return out

    def decode_all(self) -> np.ndarray:
        """All ids.  Rules are expanded once each, round by round: a round's rules hold earlier symbols only."""
        t, r = self.terminals, len(self.rules)
        n = np.r_[np.ones(t, np.int64), self.spans]
        starts = np.r_[0, np.cumsum(n)]
        flat = np.empty(starts[-1], "<u4")
        flat[:t] = np.arange(t)
        later = self.rules.max(1) if r else np.empty(0)

        def laid(symbols: np.ndarray) -> np.ndarray:
            m = n[symbols]
            end = np.cumsum(m)
            return flat[np.repeat(starts[symbols] - (end - m), m) + np.arange(end[-1])]

        a = 0
        while a < r:
            more = np.flatnonzero(later[a:] >= t + a)
            b = a + int(more[0]) if len(more) else r
            flat[starts[t + a] : starts[t + b]] = laid(self.rules[a:b].reshape(-1))
            a = b
        return laid(self.symbols) if len(self.symbols) else np.empty(0, "<u4")

    def decode_range(self, doc: int, start: int, stop: int) -> np.ndarray:
        """ids start:stop of the document at this place in the shard.  Only symbols that overlap them are opened."""
        symbols = self.symbols[self.bounds[doc] : self.bounds[doc + 1]]
        ends = np.cumsum(self.span(symbols))
        start, stop = max(0, start), min(stop, int(ends[-1]))
        if start >= stop:
            return np.empty(0, "<u4")
        i, j = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop - 1, side="right")
        at = int(ends[i - 1]) if i else 0
        symbols = symbols[i : j + 1]
        while (rule := symbols >= self.terminals).any():
            wide = np.repeat(symbols, 1 + rule)
            right = np.cumsum(1 + rule)[rule] - 1
            wide[right - 1], wide[right] = self.rules[symbols[rule] - self.terminals].T
            ends = at + np.cumsum(self.span(wide))
            i, j = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop - 1, side="right")
            at = int(ends[i - 1]) if i else at
            symbols = wide[i : j + 1]
        return symbols[start - at : stop - at].astype("<u4")


def shard_writer(path: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path, 800_000, 8 << 20)
        part, number, start = TaskContext.get().partitionId() if TaskContext.get() else 0, 0, 0
        ids, lengths, names = np.empty(0, "<u4"), np.empty(0, np.int64), []

        def shard(docs: int) -> pa.RecordBatch:
            """The first documents of those that are held."""
            nonlocal number, start, ids, lengths, names
            n = int(lengths[:docs].sum())
            row = [part, number, start, docs, n, encode_shard(names[:docs], ids[:n], lengths[:docs], bpe.size)]
            number, start, ids, lengths, names = number + 1, start + n, ids[n:], lengths[docs:], names[docs:]
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()], strict=True)], names=[c.split()[0] for c in SHARDS.split(", ")])

        for batch in batches:
            new, ends = with_ends(*bpe.encode_all(batch.column(1)))
            ids, lengths, names = np.r_[ids, new], np.r_[lengths, np.diff(np.r_[0, ends])], names + batch.column(0).to_pylist()
            while len(ids) >= block:
                yield shard(int(np.searchsorted(np.cumsum(lengths), block)) + 1)
        if names:
            yield shard(len(names))

    return run


def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            shard = Shard(batch.column(5)[i].as_py())
            data = pa.py_buffer(shard.decode_all())
            ends = np.cumsum(shard.lengths)
            starts = ends - shard.lengths
            part, first = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
            ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(4 * np.r_[0, ends]), data])
            yield pa.record_batch(
                [pa.array(np.full(len(ends), part, np.int32)), pa.array(shard.doc_ids, pa.int64()), pa.array(starts + first), pa.array(shard.lengths), ids.cast(pa.binary())],
                names=[c.split()[0] for c in DECODED.split(", ")],
            )


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", block: int = 500_000) -> None:
    """Write the shard files of docs below path, in ascending id order.

    A null or empty text is its end id alone.  Rows that repeat an id are written each on its own, null ids first; an
    empty table gives an empty table of shards.  Other columns are ignored."""
    spark = docs.sparkSession
    small_batches(spark)
    ordered = id_text(docs, id_col, text_col).repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(shard_writer(tokenizer or default_path(), block), SHARDS).write.option("compression", "zstd").parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit), from the files alone.

    Only one total per partition meets in one place; it is broadcast, a row for each partition of the writer."""
    shards = spark.read.schema(SHARDS).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    first = totals.selectExpr("part", "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0) as first")
    small_batches(spark)
    rows = shards.mapInArrow(decode, DECODED)
    return rows.join(F.broadcast(first), "part").select("doc_id", (F.col("first") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")


def op7_token_files(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    write_tokens(documents(spark, sf_dir), path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
