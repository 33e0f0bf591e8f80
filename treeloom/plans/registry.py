"""User extractors by handler."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

# Takes the records of its handler and returns them with `analysis` and `data` added.
Extractor = Callable[[DataFrame], DataFrame]

_extractors: dict[str, Extractor] = {}


def register_extractor(handler: str, extractor: Extractor) -> None:
    """Analyse the files of `handler` by `extractor` instead of the built-in expressions. It works
    on frames, so it may join, aggregate, or use Arrow functions inside."""
    _extractors[handler] = extractor


def unregister_extractor(handler: str) -> None:
    _extractors.pop(handler, None)


def extractors() -> dict[str, Extractor]:
    return dict(_extractors)
