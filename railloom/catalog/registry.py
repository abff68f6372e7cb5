"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from .fixtures import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Lazy frames of a data folder as it is now."""
    return Tables(tune(spark), sf_dir)


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under a name, with check SQL over the same views."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tables(tune(spark), sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = with_views(sql)
        return fn

    return wrap


def rnd(expr: str, digits: int) -> str:
    """SQL text of round-half-away with the same slack as `round_half_away`."""
    unit = f"1{'0' * digits}.0"
    return f"(sign({expr}) * floor(abs({expr}) * {unit} + 0.5 + 1e-9) / {unit} + 0.0)"
