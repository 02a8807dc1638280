"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Windows come in size classes; each gets a 64-bit SimHash of its weighted k-word shingles, by sums that roll over the
document.  The smallest class has windows of one shingle, whose SimHash is the shingle's hash: of every item, shingles of
more than 1 - threshold of its weight are indexed, the rarest first.  A window that has none of them holds less than the
threshold of the item's weight, so no window of the threshold's similarity is missed, whatever was edited; documents without
any of them are done.  In the others windows of as many words as an item (rounded down to a grid of sizes) are looked up
too: an item stands in the index with the first and the last window of its size class, and of half its size.  These
fingerprints are cut into radius + 1 blocks; two that differ in at most `radius` bits agree in a block, so block tables
give all items within the radius.  They add no match that the smallest class lacks.

Candidates are verified by the weighted Jaccard similarity of the item's shingles and those of each item-sized window of the
document that can reach the threshold (windows over a document's edge are cut there): a shingle weighs as many as its
letters, once for each occurrence.

The items go to the executors in blocks of about `block_bytes` of text, one at a time; each block is one pass over the
documents."""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import claim, documents, id_text, mix, powers, shingle_hashes, small_batches, written

MATCHES = "doc_id long, item_id long, start long, n_words long, similarity double"
_GROUP, _STRETCH = 200_000, 32_768  # letters of texts that are looked up at once, words whose lanes are held at once
_word: list[np.ndarray] = []


def word_letters() -> np.ndarray:
    """Whether each code point belongs to a word (\\w)."""
    if not _word:
        _word.append(np.zeros(0x110000, bool))
        for m in re.finditer(r"\w+", "".join(map(chr, range(0x110000)))):
            _word[0][m.start() : m.end()] = True
    return _word[0]


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes and letters of the lower-cased words of all texts, one text behind the other, and where each ends."""
    low = [t.lower() for t in texts]
    letters = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    inside = word_letters()[letters]
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    begin, close = edge[::2], edge[1::2]
    if not len(begin):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    # polynomials from running sums; a word's own ones don't depend on where it stands
    sums = np.zeros(len(letters) + 1, np.uint64)
    up, down = powers(len(letters) + 1)
    np.cumsum((letters + np.uint64(1)) * up[:-1], out=sums[1:])
    ends = np.cumsum([len(t) + 1 for t in low])
    return mix((sums[close] - sums[begin]) * down[begin]), close - begin, np.searchsorted(begin, ends)


def weights(letters: np.ndarray, k: int) -> np.ndarray:
    """Letters of each run of k words."""
    c = np.r_[0, np.cumsum(letters)]
    return c[k:] - c[:-k]


def lanes(shingles: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Running sums of +-weight in 64 lanes (columns)."""
    out = np.zeros((64, len(shingles) + 1), np.int64)
    for i, row in enumerate(np.unpackbits(shingles.view(np.uint8).reshape(-1, 8).T.copy(), axis=0, bitorder="little")):
        np.cumsum(np.where(row, weight, -weight), out=out[i, 1:])
    return out.T.copy()


def prints(sums: np.ndarray, shingles_in: int) -> np.ndarray:
    """SimHash of every window of so many shingles."""
    return np.packbits((sums[shingles_in:] - sums[:-shingles_in]) > 0, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def grid(size: int, step: float = 1.4) -> int:
    """The largest size class up to size."""
    c = best = 6
    while c <= size:
        best = c
        c = max(c + 1, int(c * step))
    return min(best, size)


def similarity(a: Counter, b: Counter, weight: dict[int, int]) -> float:
    low = sum(min(n, b[s]) * weight[s] for s, n in a.items() if s in b)
    high = sum(n * weight[s] for s, n in a.items()) + sum(n * weight[s] for s, n in b.items()) - low
    return low / high if high else 0.0


class Index:
    """Items of one block, of one shingle size."""

    def __init__(self, items: list[tuple[int | None, np.ndarray, np.ndarray]], k: int, radius: int, threshold: float = 0.8) -> None:
        self.k, self.radius = k, radius
        self.items = [(i, len(letters)) for i, _, letters in items]
        self.bags, self.first, self.weight = [], [], {}
        found: dict[int, list[tuple[int, int, int]]] = {}  # class -> (print, item, place in it)
        for i, (_, hashes, letters) in enumerate(items):
            h, w = shingle_hashes(hashes, k), weights(letters, k)
            self.bags.append(Counter(h.tolist()))
            self.first.append(np.unique(h, return_index=True)[1])
            self.weight.update(zip(h.tolist(), w.tolist(), strict=True))
            sums, m = lanes(h, w), len(letters)
            for c in {grid(m), grid(m // 2)} if m // 2 >= max(8, k) else {grid(m)}:
                p = prints(sums, c - k + 1)
                found.setdefault(c, []).extend({(int(p[at]), i, at) for at in (0, m - c)})
        edges = [64 * i // (radius + 1) for i in range(radius + 2)]
        self.blocks = [(np.uint64(a), np.uint64((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
        self.classes = {}
        for c, rows in sorted(found.items()):
            p = np.array([r[0] for r in rows], np.uint64)
            tables = []
            for shift, mask in self.blocks:
                v = ((p >> shift) & mask).astype(np.int64)
                order = np.argsort(v, kind="stable")
                tables.append((np.bincount(v, minlength=int(mask) + 1), np.r_[0, np.cumsum(np.bincount(v, minlength=int(mask) + 1))], order))
            self.classes[c] = (p, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), tables)
        self._single(threshold)

    def _single(self, threshold: float) -> None:
        """All shingles of the items, and which items each of them is looked up for."""
        self.keys = np.array(sorted(self.weight), np.uint64)
        place = {x: n for n, x in enumerate(self.keys.tolist())}
        self.letters = np.array([self.weight[x] for x in self.keys.tolist()], np.int64)
        self.own = [np.array(sorted(place[x] for x in bag), np.int64) for bag in self.bags]
        self.total = [sum(n * self.weight[x] for x, n in bag.items()) for bag in self.bags]
        shared, pairs = Counter(x for bag in self.bags for x in bag), []
        for i, bag in enumerate(self.bags):
            left = self.total[i]
            for x in sorted(bag, key=lambda x: (shared[x], -bag[x] * self.weight[x], x)):
                if left < threshold * self.total[i] * (1 - 1e-9):
                    break
                left -= bag[x] * self.weight[x]
                pairs.append((place[x], i))
        pairs.sort()
        self.start = np.searchsorted([x for x, _ in pairs], np.arange(len(self.keys) + 1))
        self.looked_up = np.array([i for _, i in pairs], np.int64)
        self.bits = np.uint64(max(16, (16 * len(self.keys)).bit_length()))
        self.filter = np.zeros(1 << int(self.bits), bool)
        self.filter[self.keys >> (np.uint64(64) - self.bits)] = True

    def known(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the shingles that items have, and their places in keys."""
        at = np.flatnonzero(self.filter[shingles >> (np.uint64(64) - self.bits)])
        key = np.minimum(np.searchsorted(self.keys, shingles[at]), len(self.keys) - 1)
        same = self.keys[key] == shingles[at]
        return at[same], key[same]

    def single(self, doc: np.ndarray, key: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) of the shingles by which items are looked up."""
        n = self.start[key + 1] - self.start[key]
        item = self.looked_up[np.repeat(self.start[key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        return set(zip(np.repeat(doc, n).tolist(), item.tolist(), strict=True))

    def candidates(self, fingerprints: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, row of the class) of all that are within the radius."""
        p, _, _, tables = self.classes[c]
        out = []
        for (shift, mask), (count, start, order) in zip(self.blocks, tables, strict=True):
            v = ((fingerprints >> shift) & mask).astype(np.int64)
            at = np.flatnonzero(count[v])
            n = count[v[at]]
            window = np.repeat(at, n)
            row = order[np.repeat(start[v[at]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            near = np.bitwise_count(fingerprints[window] ^ p[row]) <= self.radius
            out.append(np.stack([window[near], row[near]], 1))
        pairs = np.unique(np.concatenate(out), axis=0)
        return pairs[:, 0], pairs[:, 1]


class Matcher:
    def __init__(self, items: list[tuple[int | None, str | None]], k: int = 5, radius: int = 3, threshold: float = 0.8) -> None:
        self.threshold = threshold
        by_k: dict[int, list] = {}
        for i, text in items:
            hashes, letters, _ = tokens([text or ""])
            if len(hashes):
                by_k.setdefault(min(k, len(hashes)), []).append((i, hashes, letters))
        self.indexes = [Index(v, size, radius, threshold) for size, v in sorted(by_k.items())]

    def matches(self, texts: list[str | None]) -> list[dict[int, tuple[float, int, int]]]:
        """Per text: (index, item) -> similarity, first word, words, of the best window."""
        out: list[dict] = [{} for _ in texts]
        group: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            if t:
                group.append(i)
                size += len(t)
            if size >= _GROUP:
                self._group(group, texts, out)
                group, size = [], 0
        self._group(group, texts, out)
        return out

    def _group(self, group: list[int], texts: list[str | None], out: list[dict]) -> None:
        hashes, letters, ends = tokens([texts[i] for i in group])
        if not len(hashes):
            return
        doc = np.repeat(np.arange(len(group)), np.diff(np.r_[0, ends]))
        for which, ix in enumerate(self.indexes):
            k = ix.k
            if len(hashes) < k:
                continue
            h = shingle_hashes(hashes, k)
            at, key = ix.known(h)
            inside = at + k <= ends[doc[at]]
            at, key = at[inside], key[inside]
            pairs = ix.single(doc[at], key)
            if not pairs:
                continue
            some = np.flatnonzero(np.isin(doc, [d for d, _ in pairs]))
            pairs |= self._windows(ix, hashes[some], letters[some], doc[some])
            w = weights(letters, k)
            for d, item in sorted(pairs):
                first, last = (int(ends[d - 1]) if d else 0), int(ends[d])
                mine = slice(*np.searchsorted(at, (first, last)))
                if mine.start < mine.stop and (best := self._best(ix, item, h[first : last - k + 1], w[first : last - k + 1], at[mine] - first, key[mine])):
                    out[group[d]][(which, item)] = best

    def _windows(self, ix: Index, hashes: np.ndarray, letters: np.ndarray, doc: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) of larger windows within the radius, stretch by stretch."""
        k, out = ix.k, set()
        most = max(ix.classes, default=0)
        for a in range(0, len(hashes), _STRETCH):
            h, n, d = (x[a : a + _STRETCH + most] for x in (hashes, letters, doc))
            if len(h) < k:
                break
            sums = lanes(shingle_hashes(h, k), weights(n, k))
            for c in ix.classes:
                valid = np.flatnonzero(d[: len(h) - c + 1] == d[c - 1 :]) if len(h) >= c else []
                if len(valid):
                    window, row = ix.candidates(prints(sums, c - k + 1)[valid], c)
                    out.update(zip(d[valid[window]].tolist(), ix.classes[c][1][row].tolist(), strict=True))
        return out

    def _best(self, ix: Index, item: int, h: np.ndarray, w: np.ndarray, at: np.ndarray, key: np.ndarray) -> tuple[float, int, int] | None:
        """Similarity, first word and words of the best window of a document, given its shingles and where items' stand."""
        own, total = ix.own[item], ix.total[item]
        where = np.minimum(np.searchsorted(own, key), len(own) - 1)
        at, key = at[own[where] == key], key[own[where] == key]
        if not len(at) or ix.letters[key].sum() < self.threshold * total * (1 - 1e-9):
            return None
        m = ix.items[item][1]
        n = m - ix.k + 1
        # starts from low on; what lies outside the document weighs nothing
        low, size = int(at[0]) - n + 1, int(at[-1] - at[0]) + n
        common, every = np.zeros(size + n, np.int64), np.zeros(size + n, np.int64)
        common[at - low] = ix.letters[key]
        a, b = max(low, 0), min(low + size + n, len(h))
        every[a - low : b - low] = w[a:b]
        common, every = (np.r_[0, np.cumsum(x)] for x in (common, every))
        most = np.minimum(common[n : n + size] - common[:size], total)
        bound = most / (total + every[n : n + size] - every[:size] - most)
        starts = np.flatnonzero(bound >= self.threshold)
        # how many shingles stand at a start's distance from their first place in the item
        votes = np.bincount(np.clip(at - ix.first[item][np.searchsorted(own, key)] - low, -1, size) + 1, minlength=size + 2)[starts + 1]
        best: tuple[float, int, int] | None = None
        for i in np.lexsort((starts, -votes, -bound[starts])).tolist():
            if best and (best[0] == 1.0 or bound[starts[i]] < best[0]):
                break
            a, b = max(int(starts[i]) + low, 0), min(int(starts[i]) + low + n, len(h))
            s = h[a:b].tolist()
            weight = dict(zip(s, w[a:b].tolist(), strict=True)) | {x: ix.weight[x] for x in ix.bags[item]}
            if (j := similarity(ix.bags[item], Counter(s), weight)) >= self.threshold and (not best or (j, int(votes[i]), -int(starts[i])) > best):
                best = (j, int(votes[i]), -int(starts[i]))
        if not best:
            return None
        a = low - best[2]
        return best[0], max(a, 0), min(a + m, len(h) + ix.k - 1) - max(a, 0)


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """Items block by block, in id order; the driver holds one block."""
    block, size = [], 0
    for r in benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).orderBy("i", "t").toLocalIterator():
        block.append((r.i, r.t))
        size += len(r.t or "")
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def find(matcher):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("decontaminate")
        m: Matcher = matcher.value
        for batch in batches:
            rows = [
                (d, m.indexes[which].items[item][0], start, n, j)
                for d, got in zip(batch.column(0).to_pylist(), m.matches(batch.column(1).to_pylist()), strict=True)
                for (which, item), (j, start, n) in sorted(got.items())
            ]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.float64()], strict=True)], names=[c.split()[0] for c in MATCHES.split(", ")])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = 5, radius: int = 3, threshold: float = 0.8, block_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, item_id, start, n_words, similarity: the best window of each document for each item that it holds.

    Words are runs of letters, digits and underscores, lower-cased; start and n_words count them.  An item of fewer than
    k words is one shingle.  Null and empty texts and items match nothing; rows that repeat are matched each on its own,
    with null ids too; an empty table on either side gives no rows.  Other columns are ignored.  Of equal windows the one
    where most shingles stand as in the item counts, then the first."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = id_text(docs, id_col, text_col)
    parts, matcher = [], None
    for block in item_blocks(benchmark, item_id, item_text, block_bytes):
        if matcher:  # one block is live at a time
            parts[-1] = written(parts[-1], "matches")
            matcher.unpersist()
        matcher = spark.sparkContext.broadcast(Matcher(block, k, radius, threshold))
        parts.append(docs.mapInArrow(find(matcher), MATCHES))
    return functools.reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], MATCHES)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = 5, radius: int = 3, threshold: float = 0.8, block_bytes: int = 16 << 20) -> DataFrame:
    """docs without the rows whose text holds an item; all columns stay.  No shuffle: each row is decided where it is read."""
    spark = docs.sparkSession
    small_batches(spark)
    place, matcher = docs.columns.index(text_col), None
    for block in item_blocks(benchmark, item_id, item_text, block_bytes):
        if matcher:
            docs = written(docs, "clear")
            matcher.unpersist()
        matcher = spark.sparkContext.broadcast(Matcher(block, k, radius, threshold))

        def keep(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            claim("decontaminate")
            for batch in batches:
                yield batch.filter(pa.array([not got for got in matcher.value.matches(batch.column(place).to_pylist())], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
