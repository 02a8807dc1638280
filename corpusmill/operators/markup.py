"""Markup to text: HTML by expressions, Markdown by a small block and inline reader in Arrow batches."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values; &amp; comes last
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&middot;": "·", "&copy;": "©", "&amp;": "&"}


def html_text(c: Column) -> Column:
    """Text nodes joined by newlines; comments, scripts and styles go, common entities are decoded."""
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    c = F.regexp_replace(c, r"(?is)<script[^>]*>.*?</script>", "")
    c = F.regexp_replace(c, r"(?is)<style[^>]*>.*?</style>", "")
    c = F.regexp_replace(c, r"<[^>]*>", "\n")
    c = F.regexp_replace(c, r"\n+", "\n")
    for k, v in ENTITIES.items():
        c = F.replace(c, F.lit(k), F.lit(v))
    return F.regexp_replace(c, r"\A\n|\n\z", "")


_FENCE = re.compile(r"\s{0,3}(```+|~~~+)")
_RULE = re.compile(r"\s{0,3}(?:(?:\*\s*){3,}|(?:-\s*){3,}|(?:_\s*){3,})$")
_TABLE_RULE = re.compile(r"\s*\|?\s*:?-+:?\s*(?:\|\s*:?-+:?\s*)*\|?\s*$")
_INLINE = re.compile(r"(!?)\[((?:[^\[\]]|\[[^\]]*\])*)\]\((?:[^()]|\([^)]*\))*\)|(`+)(.+?)\3|(\*\*|__|~~)(?=\S)(.+?)(?<=\S)\5|(?<!\w)([*_])(?=\S)(.+?)(?<=\S)\7(?!\w)|<(https?://[^>\s]+)>|<[^>]+>", re.DOTALL)


def inline(text: str) -> list[str]:
    """Text nodes of inline Markdown; each emphasised, linked or coded span is a node of its own."""
    out, at = [], 0
    for m in _INLINE.finditer(text):
        out.append(text[at : m.start()])
        if m[2] is not None:
            out += [] if m[1] else inline(m[2])  # pictures have no text
        elif m[4] is not None:
            out.append(m[4])
        elif m[6] is not None or m[8] is not None:
            out += inline(m[6] if m[6] is not None else m[8])
        elif m[9] is not None:
            out.append(m[9])
        at = m.end()
    out.append(text[at:])
    return [html.unescape(re.sub(r"\\([\\`*_{}\[\]()#+\-.!|>~])", r"\1", x)) for x in out if x]


def markdown_text(source: str) -> str:
    """Text nodes of a Markdown document, one on a line: headings, paragraphs, lists, quotes, code, pipe tables."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if held:
            out.extend(x for x in inline("\n".join(held)) if x.strip())
            held.clear()

    rows = re.sub(r"\r\n?", "\n", source).split("\n")
    i = 0
    while i < len(rows):
        row = rows[i]
        bare = row.strip()
        if fence := _FENCE.match(row):
            flush()
            i += 1
            while i < len(rows) and not rows[i].strip().startswith(fence[1]):
                out.append(rows[i])
                i += 1
        elif not bare:
            flush()
        elif held and re.fullmatch(r"=+|-+", bare):
            flush()
        elif _RULE.match(row):
            flush()
        elif m := re.match(r"\s{0,3}#{1,6}\s+(.*?)\s*#*$", row):
            flush()
            held.append(m[1])
            flush()
        elif "|" in row and i + 1 < len(rows) and "|" in rows[i + 1] and _TABLE_RULE.match(rows[i + 1]):
            flush()
            while i < len(rows) and "|" in rows[i]:
                if not _TABLE_RULE.match(rows[i]):
                    for cell in re.split(r"(?<!\\)\|", rows[i].strip().strip("|")):
                        held.append(cell.strip())
                        flush()
                i += 1
            continue
        elif m := re.match(r"\s*(?:[-*+]|\d{1,9}[.)])\s+(.*)", row):
            flush()
            held.append(re.sub(r"^\[[ xX]\]\s+", "", m[1]))
        elif m := re.match(r"\s{0,3}>\s?(.*)", row):
            held.append(m[1])
        else:
            held.append(bare)
        i += 1
    flush()
    return "\n".join(out)


def _texts(sources: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in sources:
        yield s.map(markdown_text, na_action="ignore")


def markdown(c: Column) -> Column:
    """markdown_text in Arrow batches."""
    return F.pandas_udf(_texts, "string")(c)
