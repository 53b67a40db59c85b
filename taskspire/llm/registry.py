"""The queries of this subpackage and their SQL, gathered from its modules."""

from __future__ import annotations

from taskspire.llm import decontamination, html_extraction, language_id, lm_scoring, mixing, near_dedup, secrets, sharding, simhash, substring_dedup

MODULES = (decontamination, sharding, mixing, simhash, html_extraction, substring_dedup, lm_scoring, secrets, near_dedup, language_id)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
