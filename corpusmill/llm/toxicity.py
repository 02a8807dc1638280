"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows.

The lexicon is a list of insults plus stems that the labelled rows show (below).  Its trie is walked together with the
Levenshtein automaton of each word: a state is a set of (trie node, edits so far), made deterministic as words need it
and kept, so that most words end in the dead state after two or three letters.  An insult matches whole words within an
edit distance that grows with its length, a stem beginnings of words.  How many edits a stem allows depends on how rare the
words are that so match: one where clean rows hardly hold any, none otherwise.  A word within an edit distance that clean
rows use too is a word of its own, not a misspelling.

A hit counts as quoted if its context window holds a quotation mark around it or a word of reporting, and as addressed
if the window holds a second-person word.  A logistic model over the counts gives the score; no hit lowers it.

Fitting takes at most `fit_rows` labelled rows of either label (those of least hash of doc_id) to the driver; everything
else covers all rows.  A stem is learned if so many toxic and so few other rows hold it, or hold it twice, that chance would
hardly show one such among all candidates.  Weights are drawn towards fixed ones, which also serve where there are no labels."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import claim, documents, small_batches

# fixed values
INSULTS = """arsehole asshole bastard bitch clown coward cretin degenerate dimwit disgusting dumbass fool freak garbage
idiot imbecile jerk liar loser lunatic moron parasite pathetic pig psycho retard scum slut stupid subhuman trash
vermin whore worthless abschaum arschloch dummkopf idiotisch schwein connard salaud ordure imbécile estúpido
idiota basura cabrón pendejo""".split()
REPORTING = set("said says called calls quoted quote quotes word term phrase wrote writes saying dit dijo sagte".split())
ADDRESS = set("you your youre yourself u ur du dich tu te vous usted eres".split())
LEET = str.maketrans("013457@$", "oieastas")
#: Plain and quoted: insults, near insults, stems; hits addressed to someone; repeated stems beyond the first, and by length.
PRIOR = np.array([-3.0, 3.0, 0.3, 2.5, 0.3, 2.0, 0.3, 0.3, 1.0, 0.0])
LEAST = np.array([-np.inf, 1.0, 0.0, 1.0, 0.0, 0.5, 0.0, 0.0, 0.0, 0.0])
MARKS = "\"“”„«»‘’'"

_TOKEN = re.compile(r"[\w@$]+")
SCORED = "score double, predicted int, hits int, quoted int"
INSULT, NEAR_INSULT, STEM, NEAR_STEM, OFTEN = range(1, 6)
_RUN = re.compile(r"(.)\1+")


def allowed(word: str) -> int:
    """Edits that an insult may have."""
    return 0 if len(word) < 5 else 1 if len(word) < 9 else 2


class Lexicon:
    """Trie of insults (whole words) and stems (beginnings) under a lazily determinised Levenshtein automaton.

    entries: (word, edits allowed, kind: INSULT, STEM, or OFTEN for a stem that counts where it is repeated); usual: words
    that are no misspellings."""

    most_states, most_words = 50_000, 150_000

    def __init__(self, entries: list[tuple[str, int, int]], usual: frozenset[str] = frozenset()) -> None:
        self.entries, self.usual = entries, usual
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.deepest = max((edits for _, edits, _ in entries), default=0)
        for i, (word, _, _) in enumerate(entries):
            self.ends[self._add(word)].append(i)
        self._reset()
        self.words: dict[str, int] = {}
        self.before: dict[str, int] = {}

    def _add(self, word: str) -> int:
        node = 0
        for c in word:
            if c not in self.children[node]:
                self.children[node][c] = len(self.children)
                self.children.append({})
                self.ends.append([])
            node = self.children[node][c]
        return node

    def _closed(self, state: dict[int, int]) -> dict[int, int]:
        """With the lexicon's letters skipped."""
        todo = list(state.items())
        while todo:
            node, e = todo.pop()
            if e < self.deepest:
                for child in self.children[node].values():
                    if state.get(child, 99) > e + 1:
                        state[child] = e + 1
                        todo.append((child, e + 1))
        return state

    def _number(self, state: dict[int, int]) -> int:
        key = frozenset(state.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(state)
            self.steps.append({})
            found = [(i, e) for n, e in state.items() for i in self.ends[n] if e <= self.entries[i][1]]
            self.whole.append([x for x in found if self.entries[x[0]][2] == INSULT])
            self.begun.append([x for x in found if self.entries[x[0]][2] != INSULT])
        return self.ids[key]

    def _reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.steps: list[dict[str, int]] = []
        self.whole: list[list[tuple[int, int]]] = []
        self.begun: list[list[tuple[int, int]]] = []
        self.dead = self._number({})
        self.start = self._number(self._closed({0: 0}))

    def _step(self, at: int, c: str) -> int:
        out: dict[int, int] = {}
        for node, e in self.sets[at].items():
            if (child := self.children[node].get(c)) is not None and out.get(child, 99) > e:
                out[child] = e
            if e < self.deepest:
                if out.get(node, 99) > e + 1:
                    out[node] = e + 1
                for child in self.children[node].values():
                    if out.get(child, 99) > e + 1:
                        out[child] = e + 1
        to = self.steps[at][c] = self._number(self._closed(out))
        return to

    def found(self, word: str) -> list[tuple[int, int]]:
        """(entry, edits) of all entries that match."""
        if len(self.sets) > self.most_states:
            self._reset()
        at, out = self.start, []
        for c in word:
            at = self.steps[at].get(c, -1) if c in self.steps[at] else self._step(at, c)
            if at == self.dead:
                return out
            if self.begun[at]:
                out = out + self.begun[at]
        return out + self.whole[at]

    def kind(self, word: str) -> int:
        """0 or the kind of the best match: an insult before a stem, as it is before one with edits."""
        best = 0
        for i, e in self.found(word):
            k = self.entries[i][2]
            if e:
                k = 0 if word in self.usual else NEAR_INSULT if k == INSULT else NEAR_STEM if k == STEM else 0
            best = min(best or k, k or best)
        return best

    def of(self, token: str) -> int:
        if (k := self.words.get(token)) is None:
            if (k := self.before.get(token)) is None:
                k = self.kind(token) or self.other_ways(token)
            if len(self.words) > self.most_words // 2:  # frequent words come over from the half before
                self.before, self.words = self.words, {}
            self.words[token] = k
        return k

    def other_ways(self, token: str) -> int:
        """NEAR_INSULT for an insult with signs for letters or repeated letters, else 0."""
        if token in self.usual:
            return 0
        if not token.isalpha() and any(c.isalpha() for c in token) and (plain := token.rstrip("@$_").translate(LEET)) != token and self.kind(plain) in (INSULT, NEAR_INSULT):
            return NEAR_INSULT
        return NEAR_INSULT if _RUN.search(token) and self.kind(_RUN.sub(r"\1", token)) in (INSULT, NEAR_INSULT) else 0


#: Place of a plain hit of each kind among the counts; the quoted one is next to it.
_PLACE = {INSULT: 0, NEAR_INSULT: 2, STEM: 4, NEAR_STEM: 4}


class Model:
    def __init__(self, stems: list[tuple[str, int, int]] = (), weights: np.ndarray = PRIOR, usual: frozenset[str] = frozenset(), context: int = 8) -> None:
        self.stems, self.weights, self.usual, self.context = list(stems), weights, usual, context
        self._lexicon: Lexicon | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_lexicon": None}

    @property
    def lexicon(self) -> Lexicon:
        self._lexicon = self._lexicon or Lexicon([(w, allowed(w), INSULT) for w in INSULTS] + self.stems, self.usual)
        return self._lexicon

    def counts(self, text: str | None) -> list[int]:
        """Insults plain and quoted, near insults so, stems so, hits that are addressed, repeated stems, words."""
        n = [0] * 9
        if not text:
            return n
        low = text.lower()
        of = self.lexicon.of
        tokens = _TOKEN.findall(low)
        n[8] = len(tokens)
        kinds = {w: k for w in set(tokens) if (k := of(w))}
        hits = [(i, kinds[w]) for i, w in enumerate(tokens) if w in kinds] if kinds else []
        n[7] = sum(k == OFTEN for _, k in hits)
        if n[7] == len(hits):
            return n
        spans = [m.span() for m in _TOKEN.finditer(low)] if any(m in low for m in MARKS) else []
        for i, k in hits:
            if k != OFTEN:
                a, b = max(0, i - self.context), min(len(tokens), i + self.context + 1)
                around = tokens[a:b]
                quoted = not REPORTING.isdisjoint(around) or bool(spans) and between(low[spans[a][0] : spans[i][0]], low[spans[i][1] : spans[b - 1][1] + 1])
                n[_PLACE[k] + quoted] += 1
                n[6] += not ADDRESS.isdisjoint(around)
        return n

    def features(self, counts: list[int]) -> np.ndarray:
        """1, then logs of 1 + counts; repeated stems beyond the first, and so for a hundred words."""
        again = max(0, counts[7] - 1)
        return np.r_[1.0, np.log1p(counts[:7]), math.log1p(again), math.log1p(100 * again / max(1, counts[8]))]

    def score(self, counts: list[int]) -> float:
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(self.features(counts) @ self.weights))))))


def between(before: str, after: str) -> bool:
    """Whether what stands between these two stands in quotation marks."""
    return any(before.count(x) % 2 and x in after for x in "\"'") or any(before.rfind(x) > before.rfind(y) and y in after for x, y in ("“”", "„“", "«»", "‘’"))


def unlikely(pos: int, neg: int, rate: float) -> float:
    """log of the chance that at least pos of pos + neg rows are toxic."""
    n = pos + neg
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate) + (n - i) * math.log1p(-rate) for i in range(pos, n + 1)]
    top = max(logs)
    return top + math.log(sum(math.exp(x - top) for x in logs))


def families(sets: Iterable[set[str]], bands: int = 8, width: int = 3) -> list[int]:
    """Places of one row of each group of near copies, by min-hash bands; copies must not count as evidence twice."""
    seen: set[tuple] = set()
    out = []
    salts = np.random.default_rng(1).integers(1, 1 << 62, bands * width, dtype=np.uint64) | np.uint64(1)
    for i, words in enumerate(sets):
        h = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
        low = (h[:, None] * salts ^ (h[:, None] >> np.uint64(29))).min(0) if len(h) else np.zeros(bands * width, np.uint64)
        keys = {(b, *low[b * width : (b + 1) * width].tolist()) for b in range(bands)}
        if seen.isdisjoint(keys):
            out.append(i)
        seen |= keys
    return out


def learned(rows: list[tuple[str | None, int]], least: int = 4, longest: int = 8, precision: float = 0.9, twice: float = 0.75) -> tuple[list[tuple[str, int, int]], frozenset[str]]:
    """Stems of words that toxic rows hold and others don't, or hold twice where others don't, with the edits that they
    allow; and the words near an insult or stem that clean rows use.  Near copies of a row count once."""
    known = Lexicon([(w, allowed(w), INSULT) for w in INSULTS])
    tokens = lambda x: _TOKEN.findall((x or "").lower())
    rows = [rows[i] for i in families(set(tokens(x)) for x, _ in rows)]
    clean: set[str] = set()
    for x, t in rows:
        if not t:
            clean.update(tokens(x))
    near = frozenset(w for w in clean if len(w) > 3 and known.of(w) == NEAR_INSULT)
    n_pos = sum(t for _, t in rows)
    if not n_pos or n_pos == len(rows):
        return [], near
    rate = n_pos / len(rows)

    def begun(x: str | None) -> Counter:
        """How often words begin with each stem."""
        own: Counter = Counter()
        for w, times in Counter(tokens(x)).items():
            for k in range(least, min(longest, len(w)) + 1):
                own[w[:k]] += times
        return own

    # the stems of toxic rows first; of other rows only these are counted
    tallies: dict[tuple[int, bool], Counter] = {(t, many): Counter() for t in (0, 1) for many in (False, True)}
    for toxic in (1, 0):
        worth = {p for p, n in tallies[1, False].items() if n >= 4}
        for x, t in rows:
            if t == toxic:
                own = begun(x)
                tallies[t, False].update(own.keys() if toxic else own.keys() & worth)
                tallies[t, True].update(p for p, times in own.items() if times > 1 and (toxic or p in worth))
        if toxic:
            tallies[1, False] = Counter({p: n for p, n in tallies[1, False].items() if n >= 4})
            tallies[1, True] = Counter({p: n for p, n in tallies[1, True].items() if n >= 4})
    found = []
    for many, share, kind in ((False, precision, STEM), (True, twice, OFTEN)):
        pos, neg = tallies[1, many], tallies[0, many]
        often = [p for p, n in pos.items() if n >= 4]
        bar = math.log(0.05 / max(1, len(often)))
        for p in often:
            if pos[p] >= share * (pos[p] + neg[p]) and not known.kind(p) and (chance := unlikely(pos[p], neg[p], rate)) < bar:
                found.append((chance, len(p), p, kind))
    out: list[tuple[str, int, int]] = []
    for _, _, p, kind in sorted(found):
        if not any(p.startswith(x) or x.startswith(p) for x, _, _ in out):
            out.append((p, 0, kind))
    # edits by rarity: one for a stem whose near forms hardly any clean row holds
    tried = Lexicon([(p, 1, STEM) for p, _, kind in out if kind == STEM and len(p) >= 6])
    hits = Counter(tried.entries[i][0] for w in clean for i, e in tried.found(w) if e)
    out = [(p, int(kind == STEM and len(p) >= 6 and hits[p] <= 0.002 * len(rows)), kind) for p, _, kind in out]
    near |= frozenset(w for w in clean if len(w) > 3 and any(e for _, e in tried.found(w)))
    return out, near


def fit_weights(x: np.ndarray, y: np.ndarray, w: np.ndarray, pull: float = 0.02, steps: int = 60) -> np.ndarray:
    """Logistic regression by Newton's method, drawn to PRIOR; no weight below LEAST."""
    b = PRIOR.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (w * (p - y)) + pull * (b - PRIOR)
        free = (b > LEAST) | (grad < 0)
        curve = (x * (w * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(b))
        step = np.zeros(len(b))
        step[free] = np.linalg.solve(curve[np.ix_(free, free)], grad[free])
        b = np.maximum(LEAST, b - np.clip(step, -2, 2))
        if np.abs(step).max() < 1e-6:
            break
    return b


def fitted(rows: list[tuple[str | None, int]], totals: dict[int, int]) -> Model:
    """A model from labelled rows; totals: all rows of each label, of which these are some."""
    stems, usual = learned(rows)
    model = Model(stems, usual=usual)
    if rows:
        y = np.array([t for _, t in rows], float)
        share = {k: totals.get(k, 0) / max(1, sum(t == k for _, t in rows)) for k in (0, 1)}
        w = np.where(y == 1, share[1], share[0])
        model.weights = fit_weights(np.stack([model.features(model.counts(x)) for x, _ in rows]), y, w * len(w) / w.sum())
    return model


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = 3000) -> Model:
    """A model from labelled rows; labels (doc_id, toxic 0/1, the larger where they differ; nulls don't count)."""
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("y")).filter("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))
    totals = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rows: list[tuple[str, int]] = []
    for y in (0, 1):
        picked = known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(fit_rows)
        texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).join(F.broadcast(picked), "id")
        rows += [(r.t, y) for r in texts.groupBy("id").agg(F.max("t").alias("t")).orderBy("id").collect()]
    return fitted(rows, totals)


def train_labels(labels: DataFrame) -> DataFrame:
    """Rows that a model may learn from: crc32 of doc_id as text, modulo 3, is not 1."""
    return labels.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)


def scores(model, place: int, threshold: float, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        for batch in batches:
            m: Model = model.value
            counts = [m.counts(t) for t in batch.column(place).to_pylist()]
            s = [m.score(c) for c in counts]
            extra = [pa.array(s, pa.float64()), pa.array([int(v >= threshold) for v in s], pa.int32()), pa.array([sum(c[:6]) + c[7] for c in counts], pa.int32()), pa.array([c[1] + c[3] + c[5] for c in counts], pa.int32())]
            yield pa.record_batch([*(batch.column(i) for i in range(batch.num_columns) if i != place), *extra], names=names)

    return run


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted, hits, quoted per row.

    Null and empty texts get the score of no hits.  Rows that repeat are scored alike; null ids stay null; an empty
    table gives no rows; other columns are ignored, so their names can't clash."""
    spark = docs.sparkSession
    small_batches(spark)
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id", "score", "predicted", "hits", "quoted"]
    return two.mapInArrow(scores(spark.sparkContext.broadcast(model), 1, threshold, names), f"doc_id long, {SCORED}")


def drop_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """docs without the rows that score the threshold or more; all columns stay.  Each row is decided where it is read."""
    spark = docs.sparkSession
    small_batches(spark)
    place, shared = docs.columns.index(text_col), spark.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        for batch in batches:
            m = shared.value
            yield batch.filter(pa.array([m.score(m.counts(t)) < threshold for t in batch.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, train_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    out = score(docs, model)
    return out.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"), "score", "predicted", "hits", "quoted")
