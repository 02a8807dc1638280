"""The registered queries outside llm/ and their SQL."""

from __future__ import annotations

from corpusmill.plans import clean, compare, crawl, dedup, files, jobs, metrics, registry, semantic  # noqa: F401  (they register)


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
