"""Translation engines by name.  Data stays in Spark: an engine is a way to append a stored text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsdesk.functions import text as tx


class EngineRegistry:
    """Name -> column builder `(text, translated) -> text`, with a check on what is registered."""

    def __init__(self):
        self._engines: dict[str, Callable[[Column, Column], Column]] = {}

    def register(self, name: str, build: Callable[[Column, Column], Column]) -> None:
        if not callable(build):
            raise TypeError(f"engine {name!r} must be a function on columns")
        if not isinstance(build(F.lit("a"), F.lit("b")), Column):
            raise TypeError(f"engine {name!r} must return a column")
        self._engines[name] = build

    def create(self, name: str) -> Callable[[Column, Column], Column]:
        return self._engines[name]

    def is_active(self, name: str) -> bool:
        return name in self._engines and name != "none"

    def apply(self, engine: Column, text: Column, translated: Column) -> Column:
        """Pick the engine per row; unknown engines leave the text as it is."""
        out = text
        for name, build in self._engines.items():
            out = F.when(engine == name, build(text, translated)).otherwise(out)
        return out


def default_registry() -> EngineRegistry:
    registry = EngineRegistry()
    for name in tx.ENGINE_MARKS:
        registry.register(name, _appender(name))
    registry.register("none", lambda text, translated: text)
    return registry


def _appender(name: str) -> Callable[[Column, Column], Column]:
    def build(text: Column, translated: Column) -> Column:
        return F.concat(text, tx.translated_suffix(F.lit(name), translated))

    return build
