"""A mapping of frames that are planned on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyFrames(Mapping[str, DataFrame]):
    """Name -> frame; each is built once, when first asked for.

    Planning a frame lists files and reads footers, so a report on two tables
    should not plan the other twelve.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def without(self, *names: str) -> LazyFrames:
        """The same frames less some names."""
        kept = [name for name in self if name not in names]
        return LazyFrames({name: lambda name=name: self[name] for name in kept})
