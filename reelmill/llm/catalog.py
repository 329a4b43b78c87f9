"""Queries of this package with their check SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelmill.llm import (
    bpe,
    chat,
    collocations,
    exact_dedup,
    maxent,
    minhash,
    packing,
    periodic_runs,
    quality_rules,
    secrets,
    simhash,
    toxicity,
    url_filter,
)

_ALL = {}
for _module in (
    exact_dedup,
    secrets,
    toxicity,
    url_filter,
    minhash,
    bpe,
    packing,
    chat,
    simhash,
    maxent,
    periodic_runs,
    collocations,
    quality_rules,
):
    _ALL |= _module.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}
