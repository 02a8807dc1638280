"""The whole way from scraped articles to a deduplicated corpus: clean, filter, profile, three duplicate stages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import crawl, dedup, markup
from corpusmill.operators.clean import clean
from corpusmill.scratch import cut
from corpusmill.operators.semantic import EmbeddingProvider, TokenHashes, semantic_from_text


def cleaned_text(markdown):
    """Markdown as text, through the cleaning steps."""
    return clean(markup.markdown(T.fold_newlines(markdown)))


def processed(articles: DataFrame, *, min_chars: int = 100, text_of=cleaned_text) -> DataFrame:
    """Articles (doc_id, doc_pos, url_slug, content and, if there, domain, title, url) with status, text and the columns of
    processed metadata.  status: missing (no content), short (fewer than min_chars characters between white space) or
    processed; only processed rows have a text."""
    has = set(articles.columns)
    given = lambda c, default: F.coalesce(c, F.lit(default)) if c in has else F.lit(default)
    out = articles.withColumn("text", text_of(F.col("content")))
    status = F.when(F.col("content").isNull(), "missing").when(F.length(T.strip(F.col("text"))) < min_chars, "short").otherwise("processed")
    domain, slug = given("domain", "unknown"), T.safe_filename(F.col("url_slug"))
    name = lambda suffix: crawl.file_name(F.col("doc_id"), domain, slug, suffix)
    return out.withColumn("status", status).select(
        "doc_id", "doc_pos", "status", domain.alias("domain"), name("txt").alias("filename"), name("md").alias("source_md"), given("title", "").alias("title"), given("url", "").alias("url"),
        F.when(F.col("status") == "processed", T.word_count(F.col("text"))).alias("word_count"), F.when(F.col("status") == "processed", F.length("text")).alias("char_count"), F.when(F.col("status") == "processed", F.col("text")).alias("text"),
    )


@dataclass
class Processed:
    """What process() gives: counts of articles by status, metadata with texts, and report and summary of each stage."""

    counts: DataFrame
    metadata: DataFrame
    exact: DataFrame
    exact_summary: DataFrame
    near: DataFrame
    near_summary: DataFrame
    semantic: DataFrame
    semantic_summary: DataFrame

    def survivors(self) -> DataFrame:
        """Metadata and texts that no stage calls a duplicate."""
        kept = self.semantic.filter(~F.col("is_duplicate")).select("doc_id")
        return self.metadata.join(kept, "doc_id", "left_semi")


def process(articles: DataFrame, provider: EmbeddingProvider | None = None, *, min_chars: int = 100, near_threshold: float = 0.85, min_near_tokens: int = 30, semantic_threshold: float = 0.92, min_semantic_tokens: int = 50, text_of=cleaned_text, neighbours=dedup.nearest) -> Processed:
    """Articles through cleaning and all duplicate stages; each stage sees what the one before it leaves.

    Every stage is written out before the next reads it, so none is computed twice."""
    rows = cut(processed(articles, min_chars=min_chars, text_of=text_of))
    counts = rows.groupBy("status").agg(F.count("*").alias("articles"))
    docs = rows.filter("status = 'processed'").drop("status")
    exact = cut(dedup.exact_report(docs))
    unique = docs.join(exact.filter(~F.col("is_duplicate")).select("doc_id"), "doc_id", "left_semi")
    near, near_summary = dedup.near_stage(unique, threshold=near_threshold, min_tokens=min_near_tokens)
    left = unique.join(near.filter(~F.col("is_duplicate")).select("doc_id"), "doc_id", "left_semi")
    semantic, semantic_summary = semantic_from_text(left, provider or TokenHashes(), threshold=semantic_threshold, min_tokens=min_semantic_tokens, neighbours=neighbours)
    return Processed(counts, docs, exact, dedup.exact_summary(exact), near, near_summary, semantic, semantic_summary)
