"""Queries of the training-data operators and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hourlens.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        if check is not None:
            CHECKS[name] = check
        return fn
    return add
