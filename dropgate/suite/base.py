"""The query registry."""

from __future__ import annotations

import datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.rules import Options

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

OPTIONS = Options(as_of=datetime.date(2024, 1, 1))


def query(name: str, oracle: str | None = None):
    """Register a query under ``name`` with its checking SQL."""

    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add
