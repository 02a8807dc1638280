"""Schemas of what the corpus keeps in files and tables; readers are given them, none is inferred."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType, TimestampType


def of(**fields) -> StructType:
    """A schema by name and type; a trailing _ is no part of a name; a tuple (type, False) may not be null."""
    return StructType([StructField(n.rstrip("_"), *(t if isinstance(t, tuple) else (t,))) for n, t in fields.items()])


S, I, L, D, B, T = StringType(), IntegerType(), LongType(), DoubleType(), BooleanType(), TimestampType()

REGISTRY = of(url=S, domain=S, name=S, processed=B, max_depth=I)
ARTICLES = of(doc_id=S, title=S, description=S, url=S, url_slug=S, domain=S, scraped_at=TimestampNTZType(), word_count=I, char_count=I, category=S)
PROCESSED = of(doc_id=S, domain=S, filename=S, source_md=S, title=S, url=S, word_count=I, char_count=I)

EXACT_REPORT = of(doc_id=S, canonical_doc_id=S, is_duplicate=B, match_type=S, hash=S)
NEAR_REPORT = of(doc_id=S, canonical_doc_id=S, is_duplicate=B, match_type=S, candidate_doc_id=S, jaccard_similarity=D, threshold=D)
SEMANTIC_REPORT = of(doc_id=S, canonical_doc_id=S, is_duplicate=B, match_type=S, candidate_doc_id=S, semantic_similarity=D, threshold=D)

#: Job states and group states of the queue.
JOB_STATES = ("queued", "active", "completed", "failed")
GROUP_STATES = ("active", "completed", "cancelled")
_JOB = {"id": (S, False), "status": (S, False), "data": S, "created_at": (T, False), "priority": (I, False), "lock": S, "locked_at": T, "stalls": I, "finished_at": T, "listen_channel_id": S, "returnvalue": S, "failedreason": S, "owner_id": S, "group_id": S}
QUEUE_JOB = of(**_JOB)
QUEUE_FINISHED = of(**_JOB)
QUEUE_BACKLOG = of(**{k: _JOB[k] for k in ("id", "data", "created_at", "priority", "listen_channel_id", "owner_id", "group_id")}, times_out_at=T)
QUEUE_GROUP = of(id=(S, False), status=(S, False), created_at=(T, False), owner_id=(S, False), ttl=(L, False), expires_at=T)

METRICS = {
    "meta_enriched.csv": of(doc_id=S, word_count=I, char_count=I, chars_per_word=D),
    "top50_words.csv": of(word=S, count=L, pct=D),
    "top20_bigrams.csv": of(ngram=S, count=L, pct=D),
    "top20_trigrams.csv": of(ngram=S, count=L, pct=D),
    "tfidf_top30_terms.csv": of(term=S, mean_tfidf=D),
    "tfidf_heatmap_sample.csv": of(doc_id=S, term=S, tfidf=D),
    "quality_shortest_10.csv": of(doc_id=S, word_count=I, rank=I),
    "quality_longest_10.csv": of(doc_id=S, word_count=I, rank=I),
}
