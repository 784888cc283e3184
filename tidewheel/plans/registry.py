"""Queries by name, each with the SQL that checks it where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Build], Build]:
    """Register a function under its own name."""

    def register(build: Build) -> Build:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def double(x: float) -> str:
    """A SQL double literal with all digits."""
    return f"'{float(x)!r}'::DOUBLE"


def uniform_sql(tag: str, *ids: str) -> str:
    """SQL text for the keyed uniform of the package."""
    return f"(('0x'||substr({digest_sql(tag, *ids)},1,8))::BIGINT/4294967296::DOUBLE)"


def bits_sql(tag: str, *ids: str) -> str:
    """SQL text for the first 32 bits of the keyed hash."""
    return f"('0x'||substr({digest_sql(tag, *ids)},1,8))::BIGINT"


def rank_sql(tag: str, *ids: str) -> str:
    return f"('0x'||substr({digest_sql(tag, *ids)},1,15))::BIGINT"


def normal_sql(tag: str, *ids: str) -> str:
    radius = f"greatest({uniform_sql(tag + '/r', *ids)}, 1e-12)"
    angle = uniform_sql(tag + "/a", *ids)
    return f"(sqrt(-2.0::DOUBLE*ln({radius}))*cos(2.0::DOUBLE*pi()*{angle}))"


def digest_sql(tag: str, *ids: str) -> str:
    parts = "".join(f"||':'||({i})::VARCHAR" for i in ids)
    return f"md5('{tag}'{parts})"
