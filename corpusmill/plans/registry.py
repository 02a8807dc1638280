"""Registry of queries: name -> (query, SQL for DuckDB or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# the white space class of functions.text in RE2's writing
SP = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NSP = SP.replace("[", "[^", 1)


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            SQL[key] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return read_table(spark, path) if name in ("documents", "pages") else spark.read.parquet(path)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with their position."""
    return table(spark, sf_dir, "documents").withColumn("doc_pos", F.col("doc_id"))


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SP}+|{SP}+$', '', 'g')"


def fold(x: str) -> str:
    return rf"regexp_replace({x}, '\r\n?', chr(10), 'g')"


EXACT = strip(fold("text"))
NEAR = strip(f"regexp_replace(lower({fold('text')}), '{SP}+', ' ', 'g')")
TOKENS = rf"regexp_extract_all({NEAR}, '[\p{{L}}\p{{N}}_]+')"
WORDS = f"len(regexp_extract_all(text, '{NSP}+'))"
EXACT_CTE = f"""
h AS (SELECT doc_id, sha256({EXACT}) AS hash FROM documents),
exact AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY hash) AS canonical_doc_id, hash FROM h),
survivors AS (SELECT d.* FROM documents d JOIN exact e USING (doc_id) WHERE e.doc_id = e.canonical_doc_id)"""
COMPONENTS = """
sym AS (SELECT l AS u, r AS v FROM pairs UNION SELECT r, l FROM pairs),
reach AS (SELECT u, v FROM sym UNION SELECT reach.u, sym.v FROM reach JOIN sym ON reach.v = sym.u),
roots AS (SELECT u AS doc_id, least(u, min(v)) AS canonical FROM reach GROUP BY u)"""
