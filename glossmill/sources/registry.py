"""Sources known by name: a loader gives a table and what is known about it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Loader = Callable[..., tuple[DataFrame, dict]]
LOADERS: dict[str, Loader] = {}


def register(name: str) -> Callable[[Loader], Loader]:
    """Decorator: make a loader ``(spark, **params) -> (table, info)`` known by name; a name can be taken once."""

    def add(loader: Loader) -> Loader:
        if name in LOADERS:
            raise ValueError(f"{name} is taken")
        LOADERS[name] = loader
        return loader

    return add


def load(spark: SparkSession, name: str, **params) -> tuple[DataFrame, dict]:
    """The table and info of a registered loader, or of the ``get_ds`` of the module ``name`` that is imported for it."""
    if name in LOADERS:
        return LOADERS[name](spark, **params)
    try:
        module = import_module(name)
    except ModuleNotFoundError as e:
        raise KeyError(f"{name} is no source; known: {', '.join(sorted(LOADERS))}") from e
    return module.get_ds(spark, **params)


@register("parquet")
def parquet(spark: SparkSession, path: str, split: str | None = None) -> tuple[DataFrame, dict]:
    """A table of a folder or file, of one split if it is named."""
    df = spark.read.parquet(path)
    return (df if split is None else df.where(df["split"] == split)), {"columns": df.columns, "split": split}


@register("delimited")
def delimited(spark: SparkSession, path: str | list[str], schema: str, sep: str = "|") -> tuple[DataFrame, dict]:
    from glossmill.sources.delimited import read_delimited

    df = read_delimited(spark, path, schema, sep)
    return df, {"columns": df.columns, "split": None}
