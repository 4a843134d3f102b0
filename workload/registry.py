"""Registration of queries and their SQL."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from gridgate.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Reads ``<folder>/<name>.parquet`` by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of ``(spark, tables)`` under its own name."""

    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            cloudpickle.register_pickle_by_value(sys.modules["workload"])
            return build(prepare(spark), Tables(spark, folder))

        run.__name__ = build.__name__
        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register
