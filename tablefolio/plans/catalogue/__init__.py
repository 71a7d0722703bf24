"""Registered queries: each operator over the given tables, with the same result in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from tablefolio.sources.records import spread


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


class Catalogue(dict):
    """name -> Query; `add` registers a function under its own name."""

    def add(self, sql: str | None = None):
        def register(fn):
            self[fn.__name__] = Query(fn, sql)
            return fn

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def heavy(spark: SparkSession, sf_dir: str, name: str, *keys: str | Column) -> DataFrame:
    """A table for work that is heavy per row: on all cores even when the file is a single split, in small partitions."""
    return spread(table(spark, sf_dir, name), *keys)


def load() -> Catalogue:
    from tablefolio.plans.catalogue import companies, pages, reports, scalars, sources, streams, tables, temporal, usage

    out = Catalogue()
    for module in (scalars, usage, companies, tables, pages, sources, temporal, streams, reports):
        overlap = set(out) & set(module.QUERIES)
        if overlap:
            raise ValueError(f"query names used twice: {overlap}")
        out.update(module.QUERIES)
    return out
