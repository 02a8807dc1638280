"""Portable text expressions: the same white space and word rules in Spark and in SQL elsewhere."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: Unicode white space as str.isspace() has it
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
NOT_SPACE = SPACE.replace("[", "[^", 1)
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: Rows that a function in Python turns into objects at once.
SLICE = 64
# fixed values: ends of lines as str.splitlines() has them
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
WORD = r"[\p{L}\p{N}_]+"


def fold_newlines(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACES))


def sliced(f, kind: pa.DataType):
    """f of each text of Arrow batches, SLICE rows as objects at once; null stays null."""

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            parts = [pa.array([None if t is None else f(t) for t in batch.slice(a, SLICE).to_pylist()], kind) for a in range(0, len(batch), SLICE)]
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    return run


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def split_lines(c: Column) -> Column:
    """Lines as str.splitlines() has them: no empty one behind the last end of line."""

    def cut(x: Column) -> Column:
        all_ = F.split(x, "\n", -1)
        return F.when((x == "") | x.endswith("\n"), F.slice(all_, 1, F.size(all_) - 1)).otherwise(all_)

    return let(F.regexp_replace(c, LINE_END, "\n"), cut)


def word_count(c: Column) -> Column:
    """Runs of anything but white space, as str.split() has them; -1 for null, as size() has it."""
    return F.coalesce(F.arrow_udf(sliced(lambda t: len(t.split()), pa.int32()), "int")(c), F.lit(-1))


def exact_form(c: Column) -> Column:
    """Newlines folded, white space at both ends gone."""
    return strip(fold_newlines(c))


def near_form(c: Column) -> Column:
    """Lower case, every run of white space one space."""
    return strip(F.regexp_replace(F.lower(fold_newlines(c)), f"{SPACE}+", " "))


def space_form(c: Column) -> Column:
    """Every run of white space one space; case stays."""
    return strip(F.regexp_replace(fold_newlines(c), f"{SPACE}+", " "))


def preview(c: Column, n: int = 12) -> Column:
    """The first n lines, with the newline behind the last of them if the text goes on."""
    all_ = lines(c)
    return F.concat(F.array_join(F.slice(all_, 1, n), "\n"), F.when(F.size(all_) > n, "\n").otherwise(""))


#: All runs of WORD in a text, in order: \w of re is letters, numbers and _ as well.
words = re.compile(r"\w+").findall


def tokens(c: Column) -> Column:
    return F.arrow_udf(sliced(words, pa.list_(pa.string())), "array<string>")(c)


def let(c: Column, f) -> Column:
    """f(c) with c evaluated once: a lambda's variable stays one where the optimiser copies expressions."""
    return F.element_at(F.transform(F.array(c), f), 1)


def _pieces(tokens_: Column, n: int, step: int, last: int) -> Column:
    none = F.array().cast("array<int>")

    def cut(t: Column) -> Column:
        spots = F.when(F.size(t) >= last, F.sequence(F.lit(0), F.size(t) - last, F.lit(step))).otherwise(none)
        return F.transform(spots, lambda i: F.array_join(F.slice(t, i + 1, n), " "))

    return let(tokens_, cut)


def runs(tokens_: Column, n: int) -> Column:
    """All runs of n tokens, joined by a space; none where there are fewer."""
    return _pieces(tokens_, n, 1, n)


def chunks(tokens_: Column, n: int) -> Column:
    """Consecutive groups of n tokens, the last one shorter."""
    return _pieces(tokens_, n, n, 1)


def half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def html_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def strip_frontmatter(c: Column) -> Column:
    """A block that starts with --- on the first line goes, with the line that closes it and one newline; unclosed stays."""
    space = r"[^\S\n]"
    return F.regexp_replace(c, rf"\A---\n(?:(?!{space}*---{space}*(?:\n|\z))[^\n]*\n)*{space}*---{space}*(?:\n|\z)\n?", "")


def safe_filename(c: Column, most: int = 100) -> Column:
    return F.substring(F.regexp_replace(c, r"[^\p{L}\p{N}_.\-]", "_"), 1, most)


def safe_name(text: str, most: int = 100) -> str:
    """safe_filename of a plain string."""
    return re.sub(r"[^\w.\-]", "_", text)[:most]


def safe_label(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9_-]+", "_"), r"\A_+|_+\z", "")


def domain(url: Column) -> Column:
    """Network location without a leading www.; the port stays."""
    return F.regexp_replace(F.regexp_extract(url, r"\A[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1), r"\Awww\.", "")


def base_url(url: Column) -> Column:
    whole = F.regexp_extract(url, r"\A([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    return F.when(whole != "", whole).otherwise(F.concat(F.lit("https://"), url))


def url_slug(url: Column) -> Column:
    """What follows the base, / as _; a query string stays."""
    return F.translate(F.replace(url, F.concat(base_url(url), F.lit("/")), F.lit("")), "/", "_")


def category(url: Column) -> Column:
    """The path without its outer slashes, inner ones as _."""
    path = F.regexp_extract(url, r"\A[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    inner = F.translate(F.regexp_replace(path, r"\A/+|/+\z", ""), "/", "_")
    return F.when(inner != "", inner).otherwise(F.lit("category"))


def canonical_line(event: Column, fields: dict[str, Column]) -> Column:
    """event k="text" k=number; null fields are left out.  Pass strings as string columns and the rest already cast by quoted()."""
    return F.concat_ws(" ", event, *[F.concat(F.lit(f"{k}="), v) for k, v in fields.items()])


def quoted(c: Column) -> Column:
    """In double quotes, as it is: a log line's strings are not escaped."""
    return F.concat(F.lit('"'), c, F.lit('"'))
