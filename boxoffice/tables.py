"""A set of tables, each built on first use."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame


class Tables:
    """``tables.tickets`` and so on; a query builds only the plans of the tables it names."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._builders:
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)
