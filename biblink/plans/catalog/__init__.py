"""Registered queries: one per operator id, each with its DuckDB oracle when SQL can express it.

Each query takes ``(spark, sf_dir)``, reads the driver tables of that
directory through the fixture views and returns a DataFrame whose column
names equal the oracle's.  Arrays and maps are rendered as sorted strings so
both engines hash the same text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def load_all() -> None:
    from biblink.plans.catalog import (  # noqa: F401
        bib,
        corpus,
        io,
        pacing,
        ranking,
        records,
        resolve,
        text,
    )
    from biblink.plans.catalog import calls, streams  # noqa: F401  (reuse oracles registered above)
