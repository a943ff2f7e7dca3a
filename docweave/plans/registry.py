"""Registry of checked queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each Spark builder takes (spark, sf_dir) and returns a lazy DataFrame over the
whole driver tables; the SQL computes the same rows independently in DuckDB
(column names aligned; arrays rendered as joined strings so nested types do
not decide the comparison).  A ``None`` oracle marks a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def query(name: str, sql: str | None):
    def wrap(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return wrap


def load_all() -> dict[str, tuple[Builder, str | None]]:
    # importing the modules registers their queries
    from docweave.plans import (q_entities, q_io, q_jobs, q_keywords, q_models, q_relational, q_sequence,  # noqa: F401
                                q_text)
    return REGISTRY
