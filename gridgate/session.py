"""Session settings and the scratch folder of a run."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from gridgate.errors import ConfigurationError

# What the engine relies on; everything else stays with the cluster's defaults.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.javaCharsets": "true",
    # HotSpot leaves methods over 8000 bytes of bytecode uncompiled; beyond that
    # Spark splits the rule expressions into small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings; Python tasks get this package's functions by value, so
    executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules["gridgate"])
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a single-machine session without that setting gets a folder beside its
    tables; a cluster without it is a configuration error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ConfigurationError("set spark.checkpoint.dir to a folder all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written once to the scratch folder and read back.

    Cuts lineage, survives lost executors, fixes non-deterministic columns, and
    gives later joins the exact size of the table, so that Spark broadcasts it
    only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores when their source has fewer splits than cores.

    Costly rules on a small file would otherwise run in one task. A source with
    enough splits, that is any large one, comes back unchanged and unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
