"""Named queries over the star-schema tables, each with its SQL statement where SQL can say it."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from faremill.session import use_utc

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class NamedQuery:
    name: str
    run: Runner
    covers: tuple[str, ...]
    sql: str | None


_QUERIES: dict[str, NamedQuery] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register the decorated function under its own name.

    ``covers`` lists the inventory ids the query exercises; ``sql`` is the equivalent
    statement on the same tables.
    """

    def register(fn: Runner) -> Runner:
        name = fn.__name__
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(use_utc(spark), sf_dir)

        _QUERIES[name] = NamedQuery(name, run, tuple(covers.split()), sql)
        return run

    return register


def registered() -> dict[str, NamedQuery]:
    # importing the plan modules fills the table
    from faremill.plans import load_all

    load_all()
    return dict(_QUERIES)
