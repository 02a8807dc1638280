"""Semantic duplicates from texts: tokens, chunks, embeddings by a provider, mean vectors, mutual neighbours, report."""

from __future__ import annotations

import functools
import hashlib
import json
import urllib.request
from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import dedup as D
from corpusmill.scratch import cut


class EmbeddingProvider(Protocol):
    """Anything with a name that turns texts into vectors of one length.  It is sent to the executors."""

    name: str

    def embed(self, texts: Sequence[str]) -> list[list[float]]: ...


@functools.lru_cache(1 << 16)
def token_class(token: str) -> int:
    return hashlib.md5(token.encode(), usedforsecurity=False).digest()[0]


class TokenHashes:
    """Offline provider: how many tokens fall into each of 256 classes, by the first two digits of their MD5."""

    name = "token-hashes-256"

    def embed(self, texts: Sequence[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = [0.0] * 256
            for token in text.split(" "):
                v[token_class(token)] += 1.0
            out.append(v)
        return out


class Lookup:
    """Provider for tests: vectors by exact text."""

    name = "lookup"

    def __init__(self, vectors: dict[str, list[float]]) -> None:
        self.vectors = vectors

    def embed(self, texts: Sequence[str]) -> list[list[float]]:
        return [self.vectors[t] for t in texts]


class HttpEmbeddings:
    """A model behind an address that takes {model, input} and answers {embeddings}; one request for a batch of texts."""

    def __init__(self, name: str, address: str, timeout: float = 120) -> None:
        self.name, self.address, self.timeout = name, address.rstrip("/"), timeout

    def embed(self, texts: Sequence[str]) -> list[list[float]]:
        body = json.dumps({"model": self.name, "input": list(texts)}).encode()
        request = urllib.request.Request(f"{self.address}/api/embed", body, {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:  # noqa: S310
            vectors = json.load(answer).get("embeddings")
        if not isinstance(vectors, list) or len(vectors) != len(texts):
            raise ValueError("the embedding service did not answer with a vector for each text")
        return vectors


def vector_table(docs: DataFrame, provider: EmbeddingProvider, *, min_tokens: int = 50, chunk_tokens: int = 200, batch: int = 256) -> DataFrame:
    """doc_id, doc_pos, n_tokens, vector: the mean of the vectors of a document's chunks of chunk_tokens tokens (lower-cased
    words), null below min_tokens.  Written once; a text is read once, and its chunks are embedded and averaged where it is,
    `batch` of them in one call.  Raises where vectors are empty or differ in length."""
    names = ["doc_id", "doc_pos", "n_tokens", "vector"]
    kinds = dict(docs.dtypes)

    def mean(vectors: list[list[float]]) -> list[float]:
        if not vectors[0]:
            raise ValueError("no vectors to average")
        if len({len(v) for v in vectors}) > 1:
            raise ValueError("vectors of different lengths")
        return (np.sum(np.array(vectors, float), axis=0) / len(vectors)).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, T.SLICE):
                part = b.slice(a, T.SLICE)
                tokens = [None if t is None else T.words(t) for t in part.column(2).to_pylist()]
                counts = [-1 if t is None else len(t) for t in tokens]
                chunks = [[" ".join(t[k : k + chunk_tokens]) for k in range(0, n, chunk_tokens)] if n >= max(1, min_tokens) else [] for t, n in zip(tokens, counts, strict=True)]
                flat = [c for mine in chunks for c in mine]
                vectors = iter([v for k in range(0, len(flat), batch) for v in provider.embed(flat[k : k + batch])])
                means = [mean([next(vectors) for _ in mine]) if mine else None for mine in chunks]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(counts, pa.int32()), pa.array(means, pa.list_(pa.float64()))], names=names)

    rows = docs.select("doc_id", "doc_pos", F.lower("text").alias("text"))
    return cut(rows.mapInArrow(run, f"doc_id {kinds['doc_id']}, doc_pos {kinds['doc_pos']}, n_tokens int, vector array<double>"))


def document_vectors(docs: DataFrame, provider: EmbeddingProvider, *, min_tokens: int = 50, chunk_tokens: int = 200) -> tuple[DataFrame, DataFrame]:
    """(doc_id, doc_pos, n_tokens of all docs), (doc_id, vector of those of min_tokens or more)."""
    both = vector_table(docs, provider, min_tokens=min_tokens, chunk_tokens=chunk_tokens)
    return both.drop("vector"), both.filter("vector is not null").select("doc_id", "vector")


def semantic_from_text(
    survivors: DataFrame, provider: EmbeddingProvider, *, top_k: int = 10, threshold: float = 0.92, min_tokens: int = 50, chunk_tokens: int = 200, length_ratio: float = 0.7, neighbours=D.nearest
) -> tuple[DataFrame, DataFrame]:
    """Report and summary of the third stage over what the first two leave (doc_id, doc_pos, text).

    neighbours: nearest, which is exact and quadratic, or nearest_bucketed for many documents.  candidate_pairs_evaluated counts mutual neighbours before lengths and similarities are looked at."""
    both = vector_table(survivors, provider, min_tokens=min_tokens, chunk_tokens=chunk_tokens)
    counts, full = both.drop("vector"), both.filter("vector is not null")
    candidates = cut(D.mutual(neighbours(full, top_k)))
    pairs = D.semantic_pairs(full, candidates=candidates, threshold=threshold, length_ratio=length_ratio)
    report = cut(D.pair_report(counts, F.col("n_tokens") < min_tokens, pairs, "semantic_embedding_cosine", "semantic_similarity", threshold))
    return report, semantic_summary(report, candidates, model=provider.name, top_k=top_k, threshold=threshold)


def semantic_summary(report: DataFrame, candidates: DataFrame, *, model: str, top_k: int, threshold: float) -> DataFrame:
    totals = D.stage_totals(report).crossJoin(F.broadcast(candidates.agg(F.count("*").alias("candidate_pairs_evaluated"))))
    return totals.withColumns({"model_name": F.lit(model), "top_k": F.lit(top_k), "threshold": F.lit(float(threshold))})
