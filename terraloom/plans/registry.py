"""All registered queries of the engine, each with its SQL twin where SQL can express it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
_AREAS = ("catalog_queries", "scalar_queries", "algebra_queries", "radiometry_queries", "resample_queries", "focal_queries", "spatial_queries", "publish_queries", "product_queries", "hdf_queries", "emitter_queries", "granule_queries", "source_queries")


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name."""

    def put(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return put


def _load() -> None:
    for area in _AREAS:
        importlib.import_module(f"terraloom.plans.{area}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    _load()
    return _QUERIES["corrected_composite"](spark, sf_dir)
