"""Queries of the comparison tables: raw pages beside their texts."""

from pyspark.sql import functions as F

from corpusmill.operators import compare as C
from corpusmill.operators import markup as M
from corpusmill.plans.clean import html_sql
from corpusmill.plans.registry import query, table

PAIRS = f"p AS (SELECT printf('%04d', page_id) AS stem, html AS raw, {html_sql('html')} AS processed FROM pages)"


def lines_sql(x: str) -> str:
    """Lines without an empty one behind the last end of line."""
    return f"CASE WHEN {x} = '' OR {x} LIKE '%' || chr(10) THEN string_split({x}, chr(10))[:-2] ELSE string_split({x}, chr(10)) END"


LINES = f"{PAIRS}, l AS (SELECT stem, raw, processed, {lines_sql('raw')} AS a, {lines_sql('processed')} AS b FROM p)"


def files_of(spark, sf_dir):
    """pages as files of either side."""
    p = table(spark, sf_dir, "pages")
    stem = F.format_string("%04d", "page_id")
    raw = p.select(F.concat(stem, F.lit(".md")).alias("filename"), F.col("html").alias("text"))
    return raw, p.select(F.concat(stem, F.lit(".txt")).alias("filename"), M.html_text(F.col("html")).alias("text"))


@query(f"WITH {PAIRS} SELECT stem, md5(raw) AS raw_md5, md5(processed) AS processed_md5 FROM p")
def comparison_pairs(spark, sf_dir):
    md5 = lambda c: F.md5(F.col(c).cast("binary")).alias(f"{c}_md5")
    return C.pairs_by_stem(*files_of(spark, sf_dir)).select("stem", md5("raw"), md5("processed"))


@query(f"""WITH {LINES} SELECT stem, length(raw) AS raw_chars, length(processed) AS processed_chars, len(a) AS raw_lines, len(b) AS processed_lines,
CASE WHEN length(raw) = 0 THEN 0.0 ELSE round((length(raw) - length(processed)) / length(raw) * 100, 1) END AS reduction FROM l""")
def comparison_stats(spark, sf_dir):
    return C.pair_stats(C.pairs_by_stem(*files_of(spark, sf_dir)))


@query(f"""WITH {LINES}, i AS (SELECT *, unnest(range(0, greatest(len(a), len(b), 1))) AS i FROM l)
SELECT stem, (i // 32)::INT AS block, (i % 32)::INT AS place, CASE WHEN i < len(a) THEN i + 1 END::INT AS raw_number, a[i + 1] AS raw_line, CASE WHEN i < len(b) THEN i + 1 END::INT AS processed_number, b[i + 1] AS processed_line FROM i""")
def comparison_chunks(spark, sf_dir):
    return C.side_by_side(C.pairs_by_stem(*files_of(spark, sf_dir)))
