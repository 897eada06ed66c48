"""Models by table name, with declared inputs, so a consumer can never run before what it reads."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from millrace.params import Params
from millrace.sources.tables import target_schema

Inputs = Mapping[str, DataFrame]
Build = Callable[[Inputs, Params], DataFrame]

DEFAULT_SCHEMA = "public"


@dataclass(frozen=True)
class Model:
    table: str
    inputs: tuple[str, ...]
    build: Build
    schema: str | None = None
    unique_key: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{target_schema(self.schema, DEFAULT_SCHEMA)}.{self.table}"


MODELS: dict[str, Model] = {}


def model(
    schema: str | None, table: str, inputs: Iterable[str], unique_key: Iterable[str] = ()
) -> Callable[[Build], Build]:
    """Registers a ``build(inputs, params)`` function under its output table."""

    def register(build: Build) -> Build:
        entry = Model(table, tuple(inputs), build, schema, tuple(unique_key))
        MODELS[entry.name] = entry
        return build

    return register


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Selects and renames: target name to source column or expression."""
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    )


def run_order(targets: Iterable[str]) -> list[str]:
    """``targets`` and every model they need, inputs first."""
    ordered: dict[str, None] = {}

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in path:
            raise ValueError(f"models read each other: {' > '.join((*path, name))}")
        if name not in ordered and name in MODELS:
            for needed in MODELS[name].inputs:
                visit(needed, (*path, name))
            ordered[name] = None

    for target in targets:
        visit(target, ())
    return list(ordered)


@dataclass
class Workspace:
    """Resolves table names to DataFrames: given tables first, then models built from them, lazily."""

    given: Callable[[str], DataFrame]
    params: Params
    _built: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in MODELS:
                entry = MODELS[name]
                inputs = {i: self.table(i) for i in entry.inputs}
                self._built[name] = entry.build(inputs, self.params)
            else:
                self._built[name] = self.given(name)
        return self._built[name]
