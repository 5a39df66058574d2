"""Registered queries: ``name → (spark, sf_dir) → DataFrame`` and their oracle SQL.

Every query reads the benchmark tables in ``sf_dir`` (or data Spark derives and
writes from them) in full.  Queries live in the ``q_*`` modules by area.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load() -> None:
    from . import q_changes, q_history, q_ingest, q_quality, q_storage, q_stream, q_table  # noqa: F401


_load()
