"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from . import bpe, decontaminate, exact_dedup, follow_up, html_extract, lang_id, lm_score, ngram_join, packing, quality, token_counts, toxicity, vector_codes

_MODULES = (ngram_join, html_extract, packing, exact_dedup, quality, token_counts, decontaminate, toxicity, lang_id, lm_score, follow_up, vector_codes, bpe)


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in vars(m).items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in getattr(m, "SQL", {}).items()}
