"""PII: detected entities get keyed surrogates of the same type, gender, script and format.

A surrogate is a function of the key, the type, the entity and a number of tries, so an entity has the same one in all
documents (coreference) and a pass over the texts needs no join.  A name's type follows from the name alone, whatever
title stands before it.  Digits and letters go through a keyed permutation of all strings of their format (a Feistel network
over the alphabet), so distinct entities of a format get distinct surrogates.  Given names go through a permutation of their
gender's list; other names keep their last letter, which often shows the gender, and get vowels for vowels and consonants
for consonants of their script.  A name that is found once in a document is replaced wherever the document has it.

Collision checks over the whole corpus find the rest: entities whose surrogate is another's too (the least entity keeps
it), is itself an entity of the corpus, or is the entity itself.  They get another try until none collides.  After ROUNDS tries
an entity's format counts as full and is widened by a character more in each try (given names get a second one, letters of no
alphabet become Latin ones); addresses and cards have formats that don't fill.  Retried entities are
normally few and are broadcast up to `most_broadcast` of them; beyond that they are joined to their documents."""

from __future__ import annotations

import bisect
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusmill.llm.common import claim, documents, id_text, small_batches, written

# fixed values
MALE = "Adam Alan Anton Carl Daniel David Erik Felix Frank Georg Hans Henri Hugo Ivan Jack James Jean John Jorge José Juan Karl Leon Louis Luis Marc Martin Michael Pablo Paul Peter Pierre Robert Thomas Victor William".split()
FEMALE = "Alice Amélie Ana Anna Carla Carmen Claire Clara Elena Elisa Emma Eva Greta Helen Ida Ines Jane Julia Laura Léa Lena Linda Lucía Maria Marie Marta Mary Nina Olga Paula Petra Rosa Sara Sofia Susan Teresa".split()
MALE_TITLES = "Mr Herr Monsieur Señor Sr Don Sir".split()
FEMALE_TITLES = "Mrs Ms Miss Frau Madame Mme Mlle Señora Sra Doña".split()
TITLES = "Dr Prof".split()
ALPHABETS = [
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "áàâäãåéèêëíìîïóòôöõúùûüçñ",
    "ÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÇÑ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψω",
    "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
]

VOWELS = set("aeiouyáàâäãåéèêëíìîïóòôöõúùûüаеиоуыэюяαεηιουω")
#: Vowels and consonants of each alphabet of letters.
NAME_ALPHABETS = [x for a in ALPHABETS if a[0].isalpha() for x in ("".join(c for c in a if c.lower() in VOWELS), "".join(c for c in a if c.lower() not in VOWELS)) if x]

#: Key of the registered queries, which run over invented tables.
TABLES_KEY = b"invented tables"
ROUNDS, WIDER = 20, 30  # tries within an entity's format, then in wider ones

_EMAIL = re.compile(r"(?<![\w.+-])[\w+-][\w.+-]*@[\w-]+(?:\.[\w-]+)+")
_NUMBER = re.compile(
    r"(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w.]*\d))"
    r"|(?P<card>(?<![\w.+-])\d{4}([ -]?)\d{4}\3\d{4}\3\d{1,7}(?![\w-]*\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?|\(\d{2,4}\)[ .-]?|\d{3}[ .-](?=\d{3}[ .-]))\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\w-]*\d))"
)
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_KEY = re.compile(r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)|(?<!\w)(?:ghp|gho|sk|pk|xox[bp])[_-][A-Za-z0-9_-]{16,}")
_SECRET = re.compile(r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?([^\s\"',;]{6,})")
_HEX = re.compile(r"(?<!\w)(?=[0-9a-f]*\d)(?=[0-9a-f]*[a-f])[0-9a-f]{32,}(?!\w)")
_LETTER = r"[^\W\d_]"
_CAPITAL = re.compile(r"\b[A-Z][\w'’-]*")
_PART = re.compile(rf"{_LETTER}[\w'’-]*")
_AFTER_TITLE = re.compile(rf"\.?[ \t]+({_LETTER}[\w'’-]*)(?:[ \t]+({_LETTER}[\w'’-]*))?")
_AFTER_NAME = re.compile(rf"[ \t]+({_LETTER}[\w'’-]*)")
_GIVEN = {n: "m" for n in MALE} | {n: "f" for n in FEMALE}
_TITLES = {*MALE_TITLES, *FEMALE_TITLES, *TITLES}
_DIGIT = re.compile(r"\d")


def number(key: bytes, *parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), key=key, digest_size=16).digest(), "big")


def permuted(key: bytes, tweak: str, symbols: list[int], radix: int) -> list[int]:
    """A keyed permutation of the strings of this length over the alphabet."""
    n = len(symbols)
    a, b = n // 2, n - n // 2
    left = functools.reduce(lambda v, s: v * radix + s, symbols[:a], 0)
    right = functools.reduce(lambda v, s: v * radix + s, symbols[a:], 0)
    for r in range(8):
        left = (left + number(key, tweak, n, radix, r, "l", right)) % radix**a
        right = (right + number(key, tweak, n, radix, r, "r", left)) % radix**b
    out = []
    for v, size in ((right, b), (left, a)):
        part = []
        for _ in range(size):
            part.append(v % radix)
            v //= radix
        out = part[::-1] + out
    return out


def same_format(key: bytes, tweak: str, text: str, alphabets: list[str] = ALPHABETS) -> str:
    """text with the characters of each alphabet permuted among the strings of its format; others stay."""
    chars = list(text)
    form = "".join(next((str(i) for i, a in enumerate(alphabets) if c in a), c) for c in text)
    for i, alphabet in enumerate(alphabets):
        at = [j for j, c in enumerate(chars) if form[j] == str(i) and text[j] in alphabet]
        if at:
            for j, s in zip(at, permuted(key, f"{tweak}|{form}|{i}", [alphabet.index(text[j]) for j in at], len(alphabet)), strict=True):
                chars[j] = alphabet[s]
    return "".join(chars)


def luhn(digits: str) -> int:
    """Check digit behind these digits."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
    return -total % 10


def is_card(text: str) -> bool:
    """Whether the check digit fits: most other long numbers fail here."""
    digits = [c for c in text if c.isdigit()]
    return luhn("".join(digits[:-1])) == int(digits[-1])


def wider(text: str, more: int, lower: bool) -> str:
    """text with so many characters more, of its last one's kind, and Latin letters for those of no alphabet."""
    chars = [c if not c.isalnum() or any(c in a for a in ALPHABETS) else "A" if c.isupper() else "a" for c in text]
    at = next((i for i in range(len(chars) - 1, -1, -1) if chars[i].isalnum()), -1)
    last = chars[at] if at >= 0 else "a"
    return "".join([*chars[: at + 1], *[last.lower() if lower else last] * more, *chars[at + 1 :]])


def surrogate(key: bytes, kind: str, entity: str, tries: int) -> str:
    tweak = f"{kind}|{tries}"
    if tries > ROUNDS and kind not in ("ip", "card"):
        # a hash of the entity: not a permutation, so later tries part those that meet
        tweak += f"|{entity}"
        if kind in ("m", "f") and entity in (names := MALE if kind == "m" else FEMALE):
            one, two = sorted((n for n in names if n != entity), key=lambda n: number(key, tweak, n))[:2]
            return f"{one}-{two}"
        local, at, domain = entity.rpartition("@") if kind == "email" else (entity, "", "")
        entity = wider(local, tries - ROUNDS, kind in ("m", "f", "n")) + at + domain
    if kind == "ip":
        value = int.from_bytes(bytes(map(int, entity.split("."))), "big")
        return ".".join(map(str, bytes(permuted(key, tweak, list(value.to_bytes(4, "big")), 256))))
    if kind == "card":
        digits = [c for c in entity if c.isdigit()]
        body = "".join(digits[:1]) + same_format(key, tweak, "".join(digits[1:-1]))
        new = iter(body + str(luhn(body)))
        return "".join(next(new) if c.isdigit() else c for c in entity)
    if kind == "phone":
        head = re.match(r"\+\d{1,3}(?=\D)|", entity)[0]
        return head + same_format(key, tweak + head, entity[len(head) :])
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        name, _, rest = domain.partition(".")
        return f"{same_format(key, tweak, local)}@{same_format(key, tweak, name)}.{rest}" if not rest.startswith("example.") else f"{same_format(key, tweak, local)}@{domain}"
    if kind == "iban":
        return entity[:2] + same_format(key, tweak + entity[:2], entity[2:])
    if kind == "hex":
        return same_format(key, tweak, entity, ["0123456789abcdef"])
    if kind == "key":
        head = re.match(r"AKIA|ASIA|[a-z]+[_-]", entity)[0]
        return head + same_format(key, tweak + head, entity[len(head) :], ["ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"] if head.isupper() else ALPHABETS)
    if kind in ("m", "f") and entity in (names := MALE if kind == "m" else FEMALE):
        order = sorted(names, key=lambda n: number(key, tweak, n))
        return order[(order.index(entity) + 1) % len(order)]
    if kind in ("m", "f", "n"):
        end = entity[-1] if len(entity) > 2 else ""
        return same_format(key, tweak + end, entity[: len(entity) - len(end)], NAME_ALPHABETS) + end
    return same_format(key, tweak, entity)


def entities(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities of a text, in order, not overlapping; of two that overlap the one found first in this list of kinds."""
    if not text:
        return []
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        found += [(*m.span(), "email") for m in _EMAIL.finditer(text)]
    if "=" in text or ":" in text:
        for m in _SECRET.finditer(text):
            s = m[1]
            found.append((*m.span(1), "hex" if re.fullmatch(r"[0-9a-f]+", s) else "secret"))
    if _DIGIT.search(text):
        found += [(*m.span(), "key") for m in _KEY.finditer(text)]
        found += [(*m.span(), "iban") for m in _IBAN.finditer(text)]
        found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
        found += [(*m.span(), m.lastgroup) for m in _NUMBER.finditer(text) if m.lastgroup != "card" or is_card(m[0])]
    names: set[str] = set()
    for m in _CAPITAL.finditer(text):
        w = bare(m[0])
        if w in _TITLES and w == m[0] and (after := _AFTER_TITLE.match(text, m.end())):
            parts = [bare(p) for p in after.groups("") if p and p[0].isupper()]
            if after[1][0].isupper():
                names.update(parts)
        elif w in _GIVEN and w == m[0] and (after := _AFTER_NAME.match(text, m.end())) and after[1][0].isupper() and len(after[1]) > 1 and bare(after[1]) != w:
            names |= {w, bare(after[1])}
    if names := names - _TITLES:
        for m in _PART.finditer(text):
            if (w := bare(m[0])) in names:
                found.append((m.start(), m.start() + len(w), _GIVEN.get(w, "n")))
    # of two that overlap the earlier kind stays: those taken lie apart, so only their neighbours are compared
    starts: list[int] = []
    taken: dict[int, tuple[int, int, str]] = {}
    for a, b, kind in found:
        i = bisect.bisect_left(starts, b)
        if not i or taken[starts[i - 1]][1] <= a:
            bisect.insort(starts, a)
            taken[a] = (a, b, kind)
    return [taken[a] for a in starts]


def bare(name: str) -> str:
    """A name without an apostrophe and s, or signs, behind it."""
    return (name[:-2] if name.endswith(("'s", "’s")) else name).rstrip("'’-")


def replaced(key: bytes, text: str, tries: dict[tuple[str, str], int]) -> tuple[str, int]:
    parts, at, n = [], 0, 0
    for a, b, kind in entities(text):
        entity = text[a:b]
        parts += [text[at:a], surrogate(key, kind, entity, tries.get((kind, entity), 0))]
        at, n = b, n + 1
    return ("".join(parts) + text[at:], n) if n else (text, 0)


def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (kind, entity) of each batch."""
    claim("pii")
    for batch in batches:
        rows = sorted({(kind, t[a:b]) for t in batch.column(0).to_pylist() if t for a, b, kind in entities(t)})
        yield pa.record_batch([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["kind", "entity"])


def with_surrogates(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, names, tries = (batch.column(i).to_pylist() for i in range(3))
            new = [surrogate(key, k, e, n) for k, e, n in zip(kinds, names, tries, strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(new, pa.string())], names=["kind", "entity", "tries", "new"])

    return run


def retried(found: DataFrame, key: bytes, rounds: int = ROUNDS + WIDER) -> DataFrame:
    """kind, entity, tries > 0 of the entities whose first surrogate collides.  Two kinds never share a surrogate either,
    except that a name's kinds (m, f, n) are told apart by their lists."""
    real = found.select(F.col("entity").alias("new")).distinct()
    state = found.withColumn("tries", F.lit(0)).mapInArrow(with_surrogates(key), "kind string, entity string, tries int, new string").checkpoint()
    for _ in range(rounds):
        first = state.groupBy("new").agg(F.min(F.struct("entity", "kind")).alias("keeper"), F.count("*").alias("n")).filter("n > 1").drop("n")
        taken = state.join(first, "new").filter((F.col("keeper.entity") != F.col("entity")) | (F.col("keeper.kind") != F.col("kind"))).select("kind", "entity")
        also = state.filter(~F.col("kind").isin("m", "f")).join(real, "new", "left_semi").select("kind", "entity").union(state.filter("new = entity").select("kind", "entity"))
        losers = taken.union(also).distinct().withColumn("lost", F.lit(True))
        again = state.join(losers, ["kind", "entity"], "left").filter("lost").select("kind", "entity", (F.col("tries") + 1).alias("tries")).mapInArrow(with_surrogates(key), "kind string, entity string, tries int, new string")
        moved = again.checkpoint()
        if moved.isEmpty():
            break
        state = state.join(losers, ["kind", "entity"], "left_anti").union(moved).checkpoint()
    else:
        raise RuntimeError(f"surrogates still collide after {rounds} rounds")
    return state.filter("tries > 0").select("kind", "entity", "tries")


def fresh(columns: list[str], name: str) -> str:
    """name with underscores before it until no column has it."""
    low = {c.lower() for c in columns}
    while name.lower() in low:
        name = "_" + name
    return name


def pseudonymised(docs: DataFrame, key: bytes, *, text_col: str = "text", most_broadcast: int = 200_000) -> DataFrame:
    """docs with the entities in text_col replaced and a last column n_replaced; all other columns stay as they are.

    key: the secret that surrogates follow from.  Null texts stay null and empty ones empty, with n_replaced 0.  Rows that
    repeat get the same replacements; an empty table gives an empty one.  Columns may have any names: where docs has
    a column n_replaced, the new one has an underscore before it."""
    spark = docs.sparkSession
    small_batches(spark)
    found = written(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(emit, "kind string, entity string").distinct(), "entities")
    again = retried(found, key)
    columns = list(docs.columns)
    place, count = columns.index(text_col), fresh(columns, "n_replaced")
    schema = StructType([*docs.schema.fields, StructField(count, LongType())])
    if again.count() <= most_broadcast:
        tries = spark.sparkContext.broadcast({(r.kind, r.entity): r.tries for r in again.collect()})
        source, extra = docs, None
    else:
        # by a text's hash and length: its own retried entities come along with it
        h, n, own = fresh(columns, "h"), fresh(columns, "n"), fresh(columns, "tries")
        known = F.xxhash64(F.col(text_col).cast("string")), F.length(F.col(text_col).cast("string"))
        texts = docs.select(known[0].alias("h"), known[1].alias("n"), F.col(text_col).cast("string").alias("t")).filter("n > 0")
        hits = texts.mapInArrow(mentions, "h long, n int, kind string, entity string").distinct().join(again, ["kind", "entity"])
        listed = hits.groupBy(F.col("h").alias(h), F.col("n").alias(n)).agg(F.collect_set(F.struct("kind", "entity", "tries")).alias(own))
        source = docs.withColumn(h, known[0]).withColumn(n, known[1]).join(listed, [h, n], "left").select(*[F.col(f"`{c}`") for c in columns], own)
        tries, extra = None, len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("pii")
        for batch in batches:
            texts = batch.column(place).to_pylist()
            if extra is None:
                done = [replaced(key, t, tries.value) if t else (t, 0) for t in texts]
            else:
                own = batch.column(extra).to_pylist()
                done = [replaced(key, t, {(x["kind"], x["entity"]): x["tries"] for x in o or []}) if t else (t, 0) for t, o in zip(texts, own, strict=True)]
            cols = [batch.column(i) for i in range(batch.num_columns)][: len(columns)]
            cols[place] = pa.array([t for t, _ in done], pa.string())
            yield pa.record_batch([*cols, pa.array([n for _, n in done], pa.int64())], names=[*columns, count])

    return source.mapInArrow(run, schema)


def mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(h, n, kind, t[a:b]) for h, n, t in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True) for a, b, kind in entities(t)]
        yield pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.string(), pa.string()))], names=["h", "n", "kind", "entity"])


def op4_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    """With the key of these tables; data that matter need a key of their own."""
    return pseudonymised(id_text(documents(spark, sf_dir)), TABLES_KEY).select("doc_id", "text", "n_replaced")
