"""Readers for feed files: (spark, path) -> (good rows, rejected rows with a reason).

A reader parses what was fetched; fetching is not its job. Register more with :func:`register`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Reader = Callable[[SparkSession, str], tuple[DataFrame, DataFrame]]
_READERS: dict[str, Reader] = {}


class SourceError(Exception):
    """The file as a whole can't be trusted (a wrong declared count, a missing header, an empty baseline)."""


def register(name: str) -> Callable[[Reader], Reader]:
    def keep(reader: Reader) -> Reader:
        if name in _READERS:
            raise ValueError(f"source {name} is registered already")
        _READERS[name] = reader
        return reader

    return keep


def reader(name: str) -> Reader:
    from tidewatch.sources import breach, catalogues, networks, sensors  # noqa: F401  they register themselves

    return _READERS[name]


def names() -> list[str]:
    from tidewatch.sources import breach, catalogues, networks, sensors  # noqa: F401

    return sorted(_READERS)
