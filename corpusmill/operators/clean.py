"""Line-wise text cleaning: noise lines, white space, wrapped lines, stray punctuation, English words in Spanish text."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T

# fixed values
NOISE = [
    r"(?iu)\A(?:saltar a|saltar al|skip to)(?:[^\p{L}\p{N}_].*)?\z",
    r"(?iu)\A(?:in english|en español|english|español)\z",
    r"(?iu)\A(?:saltar a:|skip to:|contenido|table of contents)\z",
    r"(?iu)\A(?:mostrar|show)(?:[^\p{L}\p{N}_].*)?[↓▲▼].*\z",
    r"\A[-*•]+\z",
    r"\A[—–―‑─]{2,}\z",
]
ENGLISH_STOPWORDS = (
    "a an and are as at be been being but by for from he her his i if in is it its me my not of on or our she so that the their then these they this those to was we were with you your"
).split()


# one pattern, so that a line is stripped and read once
_NOISE = "|".join(f"(?:{x})" for x in NOISE)


def drop_noise(c: Column) -> Column:
    """Without the lines that are nothing but navigation, bullets or rules; blank lines stay as they are."""
    return F.array_join(F.filter(F.transform(T.lines(c), lambda x: F.when(~T.strip(x).rlike(_NOISE), x)), lambda x: x.isNotNull()), "\n")


def normalize_space(c: Column) -> Column:
    c = F.regexp_replace(T.fold_newlines(c), r"[ \t]+", " ")
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    return T.strip(F.array_join(F.transform(T.lines(c), T.rstrip), "\n"))


_LIST = re.compile(r"\s*(?:[-*•]|\d+\.)\s+")
_LOWER, _ANY = re.compile("[a-záéíóúñü]"), re.compile("[a-záéíóúñü]", re.IGNORECASE)


def joinable(line: str, after: str, over_blank: bool) -> bool:
    """Whether `after` goes on a wrapped line."""
    line, after = line.rstrip(), after.lstrip()
    if _LIST.match(line) or _LIST.match(after) or line[-1:] in ".!?":
        return False
    if after[:1] in ",.;:!?)]}" or line[-1:] in "([{":
        return True
    return bool((_LOWER if over_blank else _ANY).match(after))


def join_lines(text: str) -> str:
    """Pairs of lines of which the second goes on the first are joined, also over one blank line.  A joined line isn't looked at again."""
    rows, out, i = text.split("\n"), [], 0
    while i < len(rows):
        line = rows[i]
        if line.strip():
            step = 1 if i + 1 < len(rows) and rows[i + 1].strip() else 2
            if i + step < len(rows) and rows[i + step].strip() and joinable(line, rows[i + step], step == 2):
                out.append(f"{line.rstrip()} {rows[i + step].strip()}")
                i += step + 1
                continue
        out.append(line.rstrip())
        i += 1
    return "\n".join(out)


def join_wrapped(c: Column) -> Column:
    """join_lines in slices of Arrow batches; linear in the text, without a shuffle of lines."""
    return F.arrow_udf(T.sliced(join_lines, pa.string()), "string")(c)


def tidy_punctuation(c: Column) -> Column:
    c = F.regexp_replace(c, rf"(?=[*_`])(?<=\A|{T.SPACE})[*_`]+(?={T.SPACE}|\z)", "")  # the sign first: it is rare
    c = F.regexp_replace(c, " {2,}", " ")
    return T.strip(F.array_join(F.transform(T.lines(c), T.strip), "\n"))


def clean(c: Column) -> Column:
    """Noise, white space, wrapped lines, punctuation, in that order."""
    return tidy_punctuation(join_wrapped(normalize_space(drop_noise(c))))


# fixed values: white space is ASCII here, and the three patterns
_TOKEN = re.compile(r"\w+|[^\w \t-\r]")
_ACCENT = re.compile("[áéíóúñüÁÉÍÓÚÑÜ]")
_TIGHT = [(re.compile(r"[ \t-\r]+([.,;:!?)])"), r"\1"), (re.compile(r"([¿¡(])[ \t-\r]+"), r"\1"), (re.compile(" {2,}"), " ")]


def without_english(line: str, english: frozenset[str]) -> str | None:
    """line without its English words; None if that leaves nothing of it."""
    if not line.strip():
        return line

    def keep(t: str) -> bool:
        if not (t[0] == "_" or t[0].isalnum()):
            return True
        word = t.lower()
        if word in _STOPWORDS:
            return False
        return len(t) <= 2 or word not in english or unicodedata.category(t[0]) == "Lu" or bool(_ACCENT.search(t))

    out = " ".join(t for t in _TOKEN.findall(line) if keep(t))
    if not out.strip():
        return None
    for pattern, to in _TIGHT:
        out = pattern.sub(to, out)
    return out


_STOPWORDS = frozenset(ENGLISH_STOPWORDS)


def english_words(lexicon: DataFrame) -> DataFrame:
    """word: those of lexicon (word, lang en/es, zipf) much more frequent in English; missing ones have 0.

    A zipf of 2.5 is 316 in a billion words, so a language has 3.2 million of them at most, whatever the corpus's size."""
    zipf = lambda lang: F.coalesce(F.max(F.when(F.col("lang") == lang, F.col("zipf"))), F.lit(0.0)).alias(lang)
    wide = lexicon.filter("lang in ('en', 'es')").groupBy("word").agg(zipf("en"), zipf("es"))
    return wide.filter((F.col("es") < 3.5) & (F.col("en") >= 2.5) & (F.col("en") - F.col("es") >= 1.0)).select("word")


def drop_english(docs: DataFrame, lexicon: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text without the words that are English rather than Spanish; off by default in clean().

    lexicon (word, lang en/es, zipf): missing words have 0.  Stopwords go; words of two letters, capitalised and accented
    ones stay; the rest goes if it is much more frequent in English.  Punctuation stays, spacing is tightened, lines that lose
    all their tokens disappear.  The English words are broadcast, and texts stay where they are; null ones give no row."""
    english = docs.sparkSession.sparkContext.broadcast(frozenset(r.word for r in english_words(lexicon).toLocalIterator()))

    def filtered(text: str) -> str:
        lines = (without_english(line, english.value) for line in text.split("\n"))
        return "\n".join(x for x in lines if x is not None)

    text = F.arrow_udf(T.sliced(filtered, pa.string()), "string")(F.col(text_col))
    return docs.filter(F.col(text_col).isNotNull()).select(id_col, text.alias(text_col))
