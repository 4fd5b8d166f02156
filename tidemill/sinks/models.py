"""Models that read each other: built in the order of what they read."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemill.sinks.tables import publish_layers

_READ = re.compile(r"\b(?:from|join)\s+((?:`[^`]+`|\w+)(?:\.(?:`[^`]+`|\w+))*)", re.IGNORECASE)
_NOT_CODE = re.compile(r"--[^\n]*|/\*.*?\*/|'(?:[^']|'')*'", re.DOTALL)


@dataclass(frozen=True)
class Model:
    """A named query: SQL text, or a function of the session with the names that it ``reads``.

    ``kind`` is ``view`` or ``table``.  Of SQL the names behind FROM and JOIN are read.
    """

    name: str
    query: str | Callable[[SparkSession], DataFrame]
    kind: str = "view"
    reads: Sequence[str] = ()

    @property
    def inputs(self) -> set[str]:
        found = set(self.reads)
        if isinstance(self.query, str):
            found |= {x.replace("`", "") for x in _READ.findall(_NOT_CODE.sub(" ", self.query))}
        return found

    def build(self, spark: SparkSession) -> DataFrame:
        return spark.sql(self.query) if isinstance(self.query, str) else self.query(spark)


def in_order(models: Iterable[Model]) -> list[Model]:
    """Each model behind those it reads; else as given.  A cycle or a name given twice is an error.

    Names that are no model are sources.
    """
    models = list(models)
    by_name = {m.name: m for m in models}
    if len(by_name) < len(models):
        twice = sorted({m.name for m in models if sum(x.name == m.name for x in models) > 1})
        raise ValueError(f"models given twice: {', '.join(twice)}")
    out: list[Model] = []
    waiting = dict(by_name)
    while waiting:
        ready = [m for m in waiting.values() if not (m.inputs & waiting.keys()) - {m.name} and m.name not in m.inputs]
        if not ready:
            raise ValueError(f"models in a cycle: {' -> '.join(_cycle(waiting))}")
        out += ready
        waiting = {k: m for k, m in waiting.items() if m not in ready}
    return out


def _cycle(waiting: dict[str, Model]) -> list[str]:
    path = [next(iter(waiting))]
    while path[-1] not in path[:-1]:
        path.append(min(waiting[path[-1]].inputs & waiting.keys()))
    return path[path.index(path[-1]) :]


def affected(models: Iterable[Model], changed: Iterable[str]) -> set[str]:
    """The changed models and all that depend on a changed model or source."""
    touched = set(changed)
    for model in in_order(models):
        if model.inputs & touched:
            touched.add(model.name)
    return touched


def publish_models(
    spark: SparkSession, models: Iterable[Model], folder: str | None = None, changed: Iterable[str] | None = None
) -> list[str]:
    """Builds the models in the order of what they read; returns the names of those built.

    With ``changed`` (models or sources) only tables are built again that depend on a change;
    views, which are plans only, are set up always, so that a new session knows them.
    """
    models = in_order(models)
    wanted = {m.name for m in models} if changed is None else affected(models, changed)
    chosen = [m for m in models if m.kind == "view" or m.name in wanted]
    publish_layers(spark, [(m.name, m.build, m.kind) for m in chosen], folder)
    return [m.name for m in chosen if m.name in wanted]
