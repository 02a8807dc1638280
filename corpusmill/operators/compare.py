"""Side-by-side comparison of raw and processed texts, as tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.sources.files import by_prefix


def normalize_ids(given: str) -> list[str]:
    """Ids between commas, trimmed, empty ones dropped; raises if there are none or one comes twice, in any case."""
    ids = [x.strip() for x in given.split(",") if x.strip()]
    if not ids:
        raise ValueError("no ids given")
    seen: set[str] = set()
    twice = {x for x in ids if x.casefold() in seen or seen.add(x.casefold())}
    if twice:
        raise ValueError(f"ids given twice: {', '.join(sorted(twice, key=str.casefold))}")
    return ids


def non_empty(texts: DataFrame) -> DataFrame:
    """texts (filename, text); raises where a text is null or nothing but white space."""
    blank = F.coalesce(T.strip(F.col("text")), F.lit("")) == ""
    return texts.withColumn("text", F.when(blank, F.raise_error(F.concat(F.lit("File is empty: "), "filename"))).otherwise(F.col("text")))


def stem(filename: Column) -> Column:
    return F.regexp_replace(filename, r"\.[^.]*\z", "")


def is_number(doc_id: str) -> bool:
    return re.fullmatch(r"\d+", doc_id) is not None


def pairs_by_stem(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """stem, raw, processed of all files (filename, text) that both sides have; empty ones raise."""
    side = lambda df, name: non_empty(df).select(stem(F.col("filename")).alias("stem"), F.col("text").alias(name))
    return side(raw, "raw").join(side(processed, "processed"), "stem")


def requested_pairs(raw: DataFrame, processed: DataFrame, ids: str) -> DataFrame:
    """requested_id, stem, raw, processed for a list of ids or stems: each must be one file on either side, of the same stem."""
    out = None
    for doc_id in normalize_ids(ids):
        exact = not is_number(doc_id)
        a, b = by_prefix(raw, doc_id, ".md", exact), by_prefix(processed, doc_id, ".txt", exact)
        one = pairs_by_stem(a, b).select(F.lit(doc_id).alias("requested_id"), "stem", "raw", "processed")
        if one.select("stem").isEmpty():
            raise ValueError(f"the files of {doc_id!r} don't have the same stem")
        out = one if out is None else out.union(one)
    return out


def reduction(raw: Column, processed: Column) -> Column:
    """Share of characters that are gone, in per cent to one digit; 0 for an empty raw text."""
    a, b = F.length(raw).cast("long"), F.length(processed).cast("long")
    return F.when(a == 0, 0.0).otherwise(F.round((a - b) / a * 100, 1))


def pair_stats(pairs: DataFrame) -> DataFrame:
    """stem, raw_chars, processed_chars, raw_lines, processed_lines, reduction."""
    n = lambda c: F.length(c).cast("long")
    m = lambda c: F.size(T.split_lines(F.col(c))).cast("long")
    return pairs.select("stem", n("raw").alias("raw_chars"), n("processed").alias("processed_chars"), m("raw").alias("raw_lines"), m("processed").alias("processed_lines"), reduction(F.col("raw"), F.col("processed")).alias("reduction"))


def numbered(lines: Column, start: Column, size: int) -> Column:
    """number, line of size places from start on; both null behind the last line."""
    return F.transform(F.sequence(start, start + size - 1), lambda i: F.struct(F.when(i < F.size(lines), (i + 1).cast("int")).alias("number"), F.get(lines, i).alias("line")))


def side_by_side(pairs: DataFrame, size: int = 32) -> DataFrame:
    """stem, block, place, raw_number, raw_line, processed_number, processed_line.

    Blocks of size lines, as many as the longer side has, one at least; the shorter side is filled up with nulls to its
    longer one's length, and a block without any line has one place for the page to show."""
    lines = pairs.select("stem", T.split_lines(F.col("raw")).alias("a"), T.split_lines(F.col("processed")).alias("b"))
    most = F.greatest(F.size("a"), F.size("b"), F.lit(1))
    blocks = lines.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((most - 1) / size).cast("int"))))
    first = F.col("block") * size
    here = F.least(F.lit(size), most - first)
    both = F.arrays_zip(F.slice(numbered(F.col("a"), first, size), F.lit(1), here).alias("a"), F.slice(numbered(F.col("b"), first, size), F.lit(1), here).alias("b"))
    flat = blocks.select("stem", "block", F.posexplode(both).alias("place", "x"))
    return flat.select("stem", "block", "place", F.col("x.a.number").alias("raw_number"), F.col("x.a.line").alias("raw_line"), F.col("x.b.number").alias("processed_number"), F.col("x.b.line").alias("processed_line"))


def rendered(sides: DataFrame) -> DataFrame:
    """stem, block, html: the rows of each block as a table with escaped text, numbered lines and a space where none is."""
    cell = lambda c: F.coalesce(F.when(F.col(c) != "", T.html_escape(F.col(c))), F.lit("&nbsp;"))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("&nbsp;"))
    row = F.concat(F.lit("<tr><td>"), number("raw_number"), F.lit("</td><td>"), cell("raw_line"), F.lit("</td><td>"), number("processed_number"), F.lit("</td><td>"), cell("processed_line"), F.lit("</td></tr>"))
    ordered = sides.groupBy("stem", "block").agg(F.sort_array(F.collect_list(F.struct("place", row.alias("row")))).alias("rows"))
    return ordered.select("stem", "block", F.concat(F.lit("<table>"), F.array_join(F.transform("rows", lambda r: r["row"]), ""), F.lit("</table>")).alias("html"))


def frontmatter_changes(files: DataFrame, limit: int = 0) -> DataFrame:
    """filename, changed, before, after (previews), text of Markdown files in name order, all or the first `limit`."""
    files = files.orderBy("filename").limit(limit) if limit > 0 else files
    new = T.strip_frontmatter(F.col("text"))
    return files.select("filename", (new != F.col("text")).alias("changed"), T.preview(F.col("text")).alias("before"), T.preview(new).alias("after"), new.alias("text"))
