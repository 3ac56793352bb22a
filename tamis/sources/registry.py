"""Named sources, each a factory of an object with ``search``."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Source(ABC):
    """Something that can be searched for records."""

    def __init__(self, spark: SparkSession, **options: object):
        self.spark, self.options = spark, options

    @abstractmethod
    def search(self, query: str, max_results: int = 100, **kw: object) -> DataFrame:
        """Records of the standard schema, at most ``max_results``."""


_SOURCES: dict[str, Callable[..., Source]] = {}


def register_source(name: str, factory: Callable[..., Source]) -> None:
    """Adds or replaces a source."""
    _SOURCES[name] = factory


def get_source(name: str, spark: SparkSession, **options: object) -> Source:
    if name not in _SOURCES:
        raise ValueError(f"unknown source {name!r}; known: {', '.join(sorted(_SOURCES))}")
    return _SOURCES[name](spark, **options)


def discover(spark: SparkSession, source: str, query: str, max_results: int = 100, **options: object) -> DataFrame:
    """Records that a source finds."""
    return get_source(source, spark, **options).search(query, max_results)


def repository_query(language: str = "go", min_stars: int = 100, without: tuple[str, ...] = ("awesome", "tutorial", "example")) -> str:
    """A search expression for repositories of a language, without noise."""
    return " ".join([f"language:{language}", f"stars:>={min_stars}", *(f"NOT {w}" for w in without)])
