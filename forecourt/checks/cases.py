"""Registration of checked queries: a name, a frame, and the oracle's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forecourt.checks import models  # noqa: F401  (adds the model views)
from forecourt.checks.compare import plain
from forecourt.checks.duck import with_views
from forecourt.checks.frames import LensModels

Build = Callable[[LensModels], DataFrame]


class Cases:
    """Queries and oracles of one module."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, build: Build, sql: str | None = None, *views: str) -> None:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(LensModels(spark, sf_dir)))

        query.__name__ = name
        self.queries[name] = query
        if sql is not None:
            self.oracles[name] = with_views(sql, *views)

    def case(self, name: str, sql: str | None = None, *views: str) -> Callable[[Build], Build]:
        """Decorator form of ``add``."""

        def register(build: Build) -> Build:
            self.add(name, build, sql, *views)
            return build

        return register
