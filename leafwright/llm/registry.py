"""The queries of this subpackage and their SQL, found by module."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: One module for each operator; each has QUERIES and, where SQL can express it, ORACLE_SQL.
MODULES = ("byte_bpe", "token_files", "line_dedup", "secret_scan", "decontaminate", "quality", "toxicity", "embedding_dedup", "minhash_dedup", "substring_dedup")


def _merged(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found |= getattr(import_module(f"{__package__}.{name}"), attribute, {})
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLE_SQL")
