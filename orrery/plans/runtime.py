"""Named workflows: stages compiled once and run many times, each run with an id that Spark's jobs carry."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark.sql import SparkSession

from ..errors import EngineError, InvalidDependencies, InvalidRequest, StoreUnavailable


@dataclass(frozen=True)
class Descriptor:
    name: str
    version: str

    def __post_init__(self) -> None:
        if not self.name.strip() or not self.version.strip():
            raise InvalidDependencies("a workflow needs a name and a version")

    def __str__(self) -> str:
        return f"{self.name}@{self.version}"


class Observer(Protocol):
    def __call__(self, run_id: str, stage: str, event: str, seconds: float, error: str) -> None: ...


def require(**dependencies: Any) -> None:
    if missing := sorted(k for k, v in dependencies.items() if v is None):
        raise InvalidDependencies(f"missing: {', '.join(missing)}")


class Runner:
    """Stages take and return the run's state; an error of the engine passes with the stage's name, others are wrapped."""

    def __init__(self, spark: SparkSession, descriptor: Descriptor, stages: Sequence[tuple[str, Callable[[Any], Any]]], observers: Sequence[Observer] = (), most_steps: int = 100):
        if not stages or len(stages) > most_steps:
            raise InvalidDependencies("a workflow needs stages, and no more than its steps")
        self.spark, self.descriptor, self.stages, self.observers = spark, descriptor, tuple(stages), tuple(observers)

    def run(self, run_id: str, state: Any) -> Any:
        if not run_id.strip():
            raise InvalidRequest("a run needs an id")
        self.spark.sparkContext.setJobGroup(run_id, str(self.descriptor))
        for name, stage in self.stages:
            began = time.monotonic()
            tell = lambda event, error="", name=name, began=began: [o(run_id, name, event, time.monotonic() - began, error) for o in self.observers]
            tell("started")
            try:
                state = stage(state)
            except EngineError as error:
                tell("failed", type(error).__name__)
                error.add_note(f"{self.descriptor} {run_id}: {name}")
                raise
            except Exception as error:
                tell("failed", type(error).__name__)
                raise StoreUnavailable(f"{self.descriptor} {run_id}: {name} failed") from error
            tell("succeeded")
        return state
