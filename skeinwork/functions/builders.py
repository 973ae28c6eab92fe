"""A registry of Column builders by name, so that an application adds functions of its own beside those of the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column

from skeinwork.errors import Unsupported


class Builders:
    """Named functions from Columns to a Column; what they return stays an expression of the plan."""

    def __init__(self) -> None:
        self._known: dict[str, Callable[..., Column]] = {}

    def register(self, name: str, build: Callable[..., Column], replace: bool = False) -> None:
        """Adds a builder; a name that is taken is an error unless it is to be replaced."""
        if name in self._known and not replace:
            raise Unsupported(f"{name} is registered already")
        self._known[name] = build

    def __call__(self, name: str, *columns: Column) -> Column:
        """The column that a builder makes of others; an unknown name is an error, as there is no evaluation on the client."""
        if name not in self._known:
            raise Unsupported(f"{name} is not registered")
        return self._known[name](*columns)
