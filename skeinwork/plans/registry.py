"""Queries over the driver's tables with the SQL that must give the same rows, and the inventory rows they cover."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skeinwork.sources.catalog import Catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
COVERS: dict[str, list[str]] = {}


def query(ids: str, oracle: str | None = None) -> Callable:
    """Registers a function of a catalog under its name."""

    def add(f: Callable[[Catalog], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.timeType.enabled", "true")
            return f(Catalog(spark, sf_dir))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__], COVERS[f.__name__] = run, ids.split()
        if oracle:
            ORACLE[f.__name__] = oracle
        return run

    return add
