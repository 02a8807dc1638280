"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib

#: query -> module of this subpackage
_WHERE = {
    "op1_toxicity": "toxicity",
    "op10_html_main": "html_main",
    "op2_near_vectors": "near_vectors",
    "op3_decontamination": "decontaminate",
    "op4_pii_surrogates": "pii",
    "op5_ngram_jaccard": "jaccard",
    "op6_lm_score": "lm_score",
    "op7_token_files": "token_files",
    "op8_packing": "packing",
    "op9_substring_dedup": "substring",
}


def queries() -> dict:
    return {name: getattr(importlib.import_module(f"corpusmill.llm.{module}"), name) for name, module in _WHERE.items()}


def oracle_sql() -> dict[str, str]:
    from corpusmill.llm.near_vectors import OP2_SQL

    return {"op2_near_vectors": OP2_SQL}
