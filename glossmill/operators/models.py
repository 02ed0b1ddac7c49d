"""Batch inference: a trained model as a function over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

REGISTRY: dict[str, Callable[..., Any]] = {}


def register(name: str) -> Callable:
    """Decorator: make a factory known by name; a name can be taken once."""

    def add(factory: Callable) -> Callable:
        if name in REGISTRY:
            raise ValueError(f"{name} is taken")
        REGISTRY[name] = factory
        return factory

    return add


def create(name: str, **params) -> Any:
    if name not in REGISTRY:
        raise KeyError(f"{name} is not registered; known: {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name](**params)


def apply_model(df: DataFrame, factory: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """The model's output over all rows. ``factory`` runs once per task, so weights are loaded once; each batch is passed whole."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for batch in batches:
            yield model(batch)

    return df.mapInArrow(run, schema)
