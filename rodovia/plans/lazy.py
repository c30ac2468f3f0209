"""A mapping of tables that are only planned when somebody asks for them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping[str, DataFrame]):
    """``builders`` receive the mapping itself, so tables may be defined by other tables; ``traits`` is what readers may know of them."""

    def __init__(self, builders: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]], **traits):
        self._builders, self._built, self.traits = dict(builders), {}, traits

    def kept(self, save: Callable[[str, DataFrame], DataFrame]) -> LazyTables:
        """The same tables, each passed through ``save`` (name, plan) when somebody first asks for it.

        With a ``save`` that writes and reads back, every table is computed once, however many plans branch from it.
        """
        def saving(name: str, build: Callable[[Mapping[str, DataFrame]], DataFrame]):
            return lambda tables: save(name, build(tables))

        return LazyTables({name: saving(name, build) for name, build in self._builders.items()}, **self.traits)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name](self)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
