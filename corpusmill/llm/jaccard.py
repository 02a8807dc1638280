"""N-gram Jaccard join with adaptive multi-match prefixes.

Two sets that are similar enough share at least L shingles among the first |x| - overlap + L of each, in any order that
is the same for all documents.  Shingles are ordered from rare to frequent by a count sketch of bounded size over all
documents (any order is right; a good one is fast).  Each document picks its own L: the longer prefix is worth its
postings where the estimated candidates, which must then share L prefix shingles, cost more.  A pair must share the
lesser of its two Ls.

1. one pass: set sizes, 64-bit set signatures, the sketch; equal sets become one node;
2. prefix index of distinct sets, with a parity bitmap of each set: the bits that differ are a lower bound of the
   symmetric difference, so it discards pairs without losing any;
3. a few rounds contract large groups of near copies without listing their pairs: each posting list that holds several
   components is led by one of its sets, another in each round; each set is verified against `partners` of the leads of its
   lists, and what links joins components.  Where most pairs of a group link, such random partners join nearly all of it;
4. pairs of sets that share prefix shingles and are in different components are filtered, counted and verified, all of
   them.  Lists of a group of near copies hold much the same sets, so a pair would be met in each of them: lists led by the
   same set make one block where that leaves fewer pairs, and a block's pairs are met once, in tiles of bounded size.

Verification is exact, over the shingle sets of the whole texts (64-bit hashes of shingles)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.bloom import bloom
from corpusmill.llm.common import claim, documents, drop, id_text, mix, partitions, small_batches, word_hashes, written
from corpusmill.operators.graph import components

CELL_BITS = 20, 24  # of the sketch: 2**20 counters, more from four million documents on
CHUNKS = 16
BITMAP = 128  # bytes
FIRST = "doc_id long, n long, s long, bits array<long>, chunk int, payload binary"
INDEX = "token long, s long, need int"
TILE = 64, 1024  # sets in a piece of a block: a sixteenth of the block within these bounds; a tile is a pair of pieces
TILED = ("kind", "block", "tile", "alone", "piece", "s", "root", "need", "n", "bits")
MET = "a long, b long, c int, need int"
_MULTIPLIERS = np.random.default_rng(5).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

def shingle_sets(texts: list[str | None], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's shingles, one text behind the other, and where each text ends."""
    words, ends = word_hashes(texts, lower=True)
    n = np.diff(np.r_[0, ends])
    short = np.flatnonzero((n > 0) & (n < k))
    many = np.maximum(n - k + 1, 0)
    many[short] = 1
    stop = np.cumsum(many)
    begin, first = stop - many, ends - n
    out = np.empty(int(stop[-1]) if len(stop) else 0, np.uint64)
    if len(words) >= k:
        h = np.zeros(len(words) - k + 1, np.uint64)
        for i in range(k):
            h += words[i : len(words) - k + 1 + i] * _MULTIPLIERS[i]
        h = mix(h)
        doc = np.repeat(np.arange(len(n)), n)[: len(h)]
        inside = np.arange(len(h)) + k <= ends[doc]
        place = np.ones(len(out), bool)
        place[begin[short]] = False
        out[place] = h[inside]
    for i in short.tolist():
        out[begin[i]] = mix((words[first[i] : ends[i]] * _MULTIPLIERS[: n[i]]).sum(keepdims=True) + np.uint64(n[i]))[0]
    for a, b in zip(begin.tolist(), stop.tolist(), strict=True):
        out[a:b].sort()
    doc = np.repeat(np.arange(len(n)), many)
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[new], np.cumsum(np.bincount(doc[new], minlength=len(n)))


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    return shingle_sets([text], k)[0]


def signatures(shingles: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for each set; equal sets have equal ones."""
    sums = np.r_[np.uint64(0), np.cumsum(mix(shingles), dtype=np.uint64)]
    begin = np.r_[0, ends[:-1]] if len(ends) else ends
    return mix(sums[ends] - sums[begin] + (ends - begin).astype(np.uint64)).view(np.int64)


def bitmaps(shingles: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """Parity of each set's members in each of 8 * BITMAP classes."""
    width, out = 8 * BITMAP, []
    for a in range(0, len(ends), 256):
        e = ends[a : a + 256]
        lo = int(ends[a - 1]) if a else 0
        doc = np.repeat(np.arange(len(e)), np.diff(np.r_[lo, e]))
        odd = np.bincount(doc * width + (shingles[lo : e[-1]] % np.uint64(width)).astype(np.int64), minlength=len(e) * width) & 1
        out += np.packbits(odd.astype(bool).reshape(len(e), width), axis=1).view(np.int64).tolist()
    return out


def sketch_bits(docs: int) -> int:
    """Four counters for each document, within CELL_BITS."""
    return min(CELL_BITS[1], max(CELL_BITS[0], (4 * docs).bit_length()))


def first_pass(k: int, cell_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard")
        counts = np.zeros(1 << cell_bits, np.int64)
        names = [c.split()[0] for c in FIRST.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary()]
        for batch in batches:
            sets, ends = shingle_sets(batch.column(1).to_pylist(), k)
            counts += np.bincount((sets >> np.uint64(64 - cell_bits)).astype(np.int64), minlength=len(counts))
            none = [None] * len(ends)
            cols = [batch.column(0), np.diff(np.r_[0, ends]), signatures(sets, ends), bitmaps(sets, ends), none, none]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)
        if counts.any():
            parts = counts.astype("<u4").reshape(CHUNKS, -1)
            cols = [[None] * CHUNKS, [None] * CHUNKS, [None] * CHUNKS, [None] * CHUNKS, range(CHUNKS), [zlib.compress(p.tobytes(), 1) for p in parts]]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    return run


def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of one task's chunks of the sketch."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(zlib.decompress(payload), "<u4" if len(batch.schema.names) == 2 else "<i8")
            sums[chunk] = sums.get(chunk, 0) + x.astype(np.int64)
    yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([zlib.compress(x.astype("<i8").tobytes(), 1) for x in sums.values()], pa.binary())], names=["chunk", "payload"])


def sketch(first: DataFrame, cell_bits: int) -> np.ndarray:
    """Documents counted per cell."""
    rows = first.filter("chunk is not null").select("chunk", "payload").repartition(CHUNKS, "chunk").mapInArrow(added_up, "chunk int, payload binary").collect()
    out = np.zeros((CHUNKS, (1 << cell_bits) // CHUNKS), np.int64)
    for r in rows:
        out[r.chunk] += np.frombuffer(zlib.decompress(bytes(r.payload)), "<i8")
    return out.reshape(-1)


def levels(counts: np.ndarray) -> np.ndarray:
    """Counts as 8-bit steps of a power of 2 ** (1/6)."""
    return np.minimum(255, np.round(6 * np.log2(1 + counts))).astype(np.uint8)


def least_overlap(n: int, percent: int) -> int:
    """Least overlap of a set of n with any set that it can be linked with."""
    return -(-percent * n // 100)


def prefix(shingles: np.ndarray, level: np.ndarray, cost: np.ndarray, percent: int, most: int) -> tuple[np.ndarray, int]:
    """The shingles to index and the L chosen for one sorted set.  level: of each shingle; cost: of each level."""
    n = len(shingles)
    order = np.argsort(level, kind="stable")
    base = n - least_overlap(n, percent)  # prefix length less L
    lists = np.cumsum(cost[level[order[: base + most]]]).tolist()
    best, need = None, 1
    for x in range(1, min(most, n - base) + 1):
        total = lists[base + x - 1] * (1 + 8 / x)
        if best is None or total < best:
            best, need = total, x
    return shingles[order[: base + need]], need


def index(ranks, k: int, percent: int, most: int, cell_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard")
        level, cost = ranks.value
        for batch in batches:
            sets, ends = shingle_sets(batch.column(1).to_pylist(), k)
            marks = level[(sets >> np.uint64(64 - cell_bits)).astype(np.int64)]
            seen: dict[int, tuple[np.ndarray, int]] = {}
            begin = 0
            for s, end in zip(signatures(sets, ends).tolist(), ends.tolist(), strict=True):
                if end > begin and s not in seen:
                    seen[s] = prefix(sets[begin:end], marks[begin:end], cost, percent, most)
                begin = end
            sizes = [len(p) for p, _ in seen.values()]
            cols = [
                np.concatenate([p for p, _ in seen.values()]).view(np.int64) if seen else np.empty(0, np.int64),
                np.repeat(np.array(list(seen), np.int64), sizes),
                np.repeat(np.array([x for _, x in seen.values()], np.int32), sizes),
            ]
            yield pa.record_batch([pa.array(c) for c in cols], names=[c.split()[0] for c in INDEX.split(", ")])

    return run


def shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings, sorted by token and set, of tokens that several sets have, once each.

    Lists stream by: one row is held back, however long a list is."""
    held: tuple[int, int, int] | None = None  # the last row, if it is the first of its list
    token, last = None, None
    for batch in batches:
        t, s, need = (batch.column(i).to_numpy() for i in range(3))
        if not len(t):
            continue
        new = np.r_[token is None or t[0] != token, t[1:] != t[:-1]]
        repeat = ~new & np.r_[last is not None and s[0] == last, s[1:] == s[:-1]]
        t, s, need, new = t[~repeat], s[~repeat], need[~repeat], new[~repeat]
        if not len(t):
            continue
        goes_on = not new[0]
        keep = ~(new & np.r_[new[1:], False])
        if new[-1]:  # whether its list goes on is not known yet
            keep[-1] = False
        out = [x[keep] for x in (t, s, need)]
        if held and goes_on:
            out = [np.r_[np.int64(h), x] for h, x in zip(held, out, strict=True)]
        held = (int(t[-1]), int(s[-1]), int(need[-1])) if new[-1] else None
        token, last = t[-1], s[-1]
        yield pa.record_batch([pa.array(x.astype(np.int32 if i == 2 else np.int64)) for i, x in enumerate(out)], names=[c.split()[0] for c in INDEX.split(", ")])


def texts_of(wanted, k: int):
    """s, text of the rows whose key may be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard")
        for batch in batches:
            batch = batch.filter(pa.array(wanted.value.has(batch.column(0).to_numpy())))
            yield pa.record_batch([pa.array(signatures(*shingle_sets(batch.column(1).to_pylist(), k))), batch.column(1)], names=["s", "text"])

    return run


def possible(percent: int) -> Column:
    """Whether bitmaps and sizes (bitsa, bitsb, na, nb) let two sets link: with at least d members in one of them only, the
    intersection is at most (na + nb - d) / 2 and the union the rest."""
    d = sum((F.bit_count(F.col("bitsa")[i].bitwiseXOR(F.col("bitsb")[i])) for i in range(1, BITMAP // 8)), F.bit_count(F.col("bitsa")[0].bitwiseXOR(F.col("bitsb")[0])))
    total = F.col("na") + F.col("nb")
    return (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (100 * (total - d) >= percent * (total + d))


def tiles(rows: DataFrame, parts: int) -> DataFrame:
    """TILED, a tile's rows one behind the other by component; rows: kind, block, size (sets in the block), s, root, need, n, bits.

    A block's sets are dealt over pieces, and any two pieces, or one alone, make a tile: two sets meet in one tile."""
    pieces = F.ceil(F.col("size") / F.greatest(F.lit(TILE[0]), F.least(F.lit(TILE[1]), F.col("size") / 16))).cast("long")
    rows = rows.withColumn("pieces", pieces).withColumn("piece", F.pmod(F.xxhash64("s", "block"), "pieces"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    rows = rows.withColumn("tile", F.least("piece", "other") * F.col("pieces") + F.greatest("piece", "other")).withColumn("alone", F.col("piece") == F.col("other"))
    # a set is in its own piece's tile once, alone; in a tile of two pieces, sets of one piece don't meet
    return rows.select(*TILED).repartition(parts, "kind", "block", "tile").sortWithinPartitions("kind", "block", "tile", "root")


def meeting(percent: int, most: int):
    """MET: pairs of a tile's sets that are in different components and may link; c: the lists they meet in, or most for a
    block of several lists, which doesn't tell them apart."""

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        kind, block, tile, alone, piece, s, root, need, n = (rows.column(c).to_numpy() for c in TILED[:-1])
        bits = rows.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(s), -1)  # counted without a sign
        new = np.r_[True, (block[1:] != block[:-1]) | (tile[1:] != tile[:-1]) | (kind[1:] != kind[:-1])]
        other = new | np.r_[True, root[1:] != root[:-1]]
        end, own = (np.r_[np.flatnonzero(x)[1:], len(s)][np.cumsum(x) - 1] for x in (new, other))
        i, step = np.arange(len(s)), 0
        while True:  # each set with the first behind its component, then with the second, ...
            i = i[own[i] + step < end[i]]
            if not len(i):
                return
            j = own[i] + step
            step += 1
            ok = ((piece[i] != piece[j]) | alone[i]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            u, v = i[ok], j[ok]
            d, total = np.bitwise_count(bits[u] ^ bits[v]).sum(axis=1, dtype=np.int64), n[u] + n[v]
            ok = 100 * (total - d) >= percent * (total + d)
            if ok.any():
                u, v = u[ok], v[ok]
                cols = [np.minimum(s[u], s[v]), np.maximum(s[u], s[v]), np.where(kind[u] == 1, most, 1).astype(np.int32), np.minimum(need[u], need[v])]
                yield pa.record_batch([pa.array(c) for c in cols], names=[c.split()[0] for c in MET.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard")
        held: list[pa.RecordBatch] = []  # the last tile, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([*held, batch])
            same = np.logical_and.reduce([x == x[-1] for x in (rows.column(c).to_numpy() for c in ("kind", "block", "tile"))])
            last = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if last:
                yield from pairs(rows.slice(0, last))
            held = rows.slice(last).to_batches()
        if held:
            yield from pairs(pa.Table.from_batches(held))

    return run


def linked(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, held = [], None, None
            others, ends = shingle_sets(batch.column(3).to_pylist(), k)
            begin = 0
            for a, x, end in zip(batch.column(0).to_pylist(), batch.column(2), ends.tolist(), strict=True):
                if a != last:
                    last, held = a, shingle_set(x.as_py(), k)
                other = others[begin:end]
                both = len(np.intersect1d(held, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(held) + len(other) - both))
                begin = end
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, most: int = 4, contractions: int = 3, partners: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id per row of docs.

    Links: 100 * |intersection| >= percent * |union| of the sets of k-word shingles (a text of fewer words is one shingle).
    component_id is the least doc_id that links reach, the row itself included.  Texts without words (null, empty) have
    no shingles and link with nothing.  Rows that repeat are linked like others; a null doc_id takes part and doesn't
    count as least (null if alone).  An empty table gives no rows; other columns are ignored.  Sets are told apart by 64-bit
    signatures and hashes."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = id_text(docs, id_col, text_col)
    bits = sketch_bits(docs.count())
    first = written(docs.mapInArrow(first_pass(k, bits), FIRST), "sets")
    rows = first.filter("chunk is null").select("doc_id", "n", "s")
    counts = sketch(first, bits)
    level = levels(counts)
    usual = float(np.median(counts))
    cost = np.maximum(1.0, 2 ** (np.arange(256) / 6) - 2 * usual)
    ranks = spark.sparkContext.broadcast((level, cost))
    postings = docs.mapInArrow(index(ranks, k, percent, most, bits), INDEX)
    shared = postings.repartition(partitions(spark), "token").sortWithinPartitions("token", "s").mapInArrow(shared_only, INDEX)
    shared = written(shared, "postings")
    no_id = F.lit(-(1 << 63))
    # copies meet in partial aggregations, before anything is dealt by their signature
    sets = first.filter("n > 0").groupBy("s").agg(F.min(F.coalesce("doc_id", no_id)).alias("key"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    sets = written(sets.join(shared.select("s").distinct(), "s", "left_semi"), "bitmaps")

    def bounded(pairs: DataFrame) -> DataFrame:
        a, b = (sets.select(F.col("s").alias(x), F.col("n").alias("n" + x), F.col("bits").alias("bits" + x)) for x in "ab")
        return pairs.select("a", "b").join(a, "a").join(b, "b").filter(possible(percent)).select("a", "b")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs that link, written; pairs: (a, b), written too.  Of each pair one text is shuffled, next to one of each set."""
        # texts of the pairs' sets, found by the id of one row of each; the filter keeps other texts out of the shuffle
        ends = pairs.select(F.col("a").alias("s")).union(pairs.select(F.col("b").alias("s"))).distinct()
        keys = sets.join(ends, "s").select("key")
        texts = docs.select(F.coalesce("doc_id", no_id).alias("key"), "text").mapInArrow(texts_of(spark.sparkContext.broadcast(bloom(keys)), k), "s long, text string")
        texts = written(texts.join(ends, "s").dropDuplicates(["s"]), "texts")
        a, b = (texts.select(F.col("s").alias(x), F.col("text").alias("text" + x)) for x in "ab")
        out = written(pairs.join(b, "b").join(a, "a").select("a", "b", "texta", "textb").mapInArrow(linked(k, percent), "u long, v long"), "links")
        drop(texts)
        return out

    def by_component(lists: DataFrame, roots: DataFrame | None, turn: int | None = None) -> tuple[DataFrame, DataFrame]:
        """Postings with their component, and the lists that hold several with a set that leads them: another for each list and
        turn, or without turn the same for lists of much the same sets."""
        root = lists.withColumn("root", F.col("s")) if roots is None else lists.join(roots, "s", "left").withColumn("root", F.coalesce("root", "s"))
        lead = F.min(F.struct(F.xxhash64("s") if turn is None else F.xxhash64("token", "s", F.lit(turn)), "root", "s")).alias("lead")
        several = root.groupBy("token").agg(lead, F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size")).filter("lo != hi")
        return root, several.select("token", F.col("lead.root").alias("lead_root"), F.col("lead.s").alias("lead"), "size")

    lists, links, tried, roots = shared, None, None, None
    for turn in range(contractions):
        grouped, several = by_component(lists, roots, turn)
        led = grouped.join(several, "token")
        if roots is not None:
            # components only grow, so lists of one component are done with
            led = written(led, "lists")
            if lists is not shared:
                drop(lists)
            lists = led.select("token", "s", "need")
            lists.written_at = led.written_at
        led = led.filter("root != lead_root").groupBy("s", "lead").agg(F.count("*").alias("c"))
        # of the leads of its lists, those that share most, one of each class
        pick = led.groupBy("s", F.pmod(F.xxhash64("lead", F.lit(turn)), F.lit(partners)).alias("class")).agg(F.max_by("lead", F.struct("c", "lead")).alias("lead"))
        pick = pick.select(F.least("s", "lead").alias("a"), F.greatest("s", "lead").alias("b")).distinct()
        pick = bounded(pick if tried is None else pick.join(tried, ["a", "b"], "left_anti")).checkpoint()
        tried = pick if tried is None else tried.union(pick)
        found = verified(pick)
        links = found if links is None else links.union(found)
        roots = components(links).withColumnRenamed("node", "s")
        if 50 * found.count() <= pick.count():
            break  # few of the pairs that are left will link
    grouped, several = by_component(lists, roots)
    mixed = written(grouped.join(several, "token").select("token", "s", "need", "root", "lead", "size"), "mixed")
    members = mixed.groupBy("lead", "s").agg(F.min("need").alias("need"), F.first("root").alias("root"))
    listed = mixed.groupBy("lead").agg(F.sum("size").alias("listed"))  # of each list the square of its size
    whole = members.groupBy("lead").agg(F.count("*").alias("size")).join(listed, "lead").filter("2 * size * size <= listed").select("lead", "size").checkpoint()
    blocks = members.join(whole, "lead").select(F.lit(1).alias("kind"), F.col("lead").alias("block"), "size", "s", "root", "need")
    blocks = blocks.union(mixed.join(whole, "lead", "left_anti").select(F.lit(0).alias("kind"), F.col("token").alias("block"), "size", "s", "root", "need"))
    crossing = tiles(blocks.join(sets.select("s", "n", "bits"), "s"), partitions(spark)).mapInArrow(meeting(percent, most), MET)
    crossing = crossing.groupBy("a", "b").agg(F.sum("c").alias("c"), F.min("need").alias("need")).filter("c >= need")
    roots = components(links.union(verified(crossing.select("a", "b").checkpoint()))).withColumnRenamed("node", "s")

    known = rows.filter("n > 0").groupBy("s").agg(F.min("doc_id").alias("least")).join(roots, "s", "left").withColumn("root", F.coalesce("root", "s"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    by_set = written(known.join(least, "root").select("s", "component_id"), "components")
    for done in {id(x): x for x in (shared, lists, sets, mixed)}.values():
        drop(done)
    return rows.join(by_set, "s", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op5_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
