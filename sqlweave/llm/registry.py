"""Registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("suffix_dedup", "mixing", "passage_dedup", "token_files", "sketch_dedup", "decontaminate", "topk", "quality",
           "warc", "url_filter", "fill_middle", "source_audit", "language_crf")


def _gathered(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out.update(getattr(import_module(f"{__package__}.{name}"), attribute, {}))
    return out


def queries() -> dict:
    return _gathered("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _gathered("ORACLE_SQL")
