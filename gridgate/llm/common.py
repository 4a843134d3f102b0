"""What the operators share on the Spark side: staged tables, folders, and whole-text columns."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000


def ready(spark: SparkSession) -> SparkSession:
    """Tasks get this package's functions by value, so executors need no copy of it. Of the settings only the rows of an Arrow batch
    are lowered: whole texts make long rows, and a batch is held on both sides of the pipe to Python."""
    cloudpickle.register_pickle_by_value(sys.modules["gridgate"])
    if not 0 < int(spark.conf.get(BATCH, "10000")) <= BATCH_ROWS:  # zero and less mean no limit
        spark.conf.set(BATCH, str(BATCH_ROWS))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one in the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/staged"
    return root.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """The same rows from a table written once to the shared folder; cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the whole text, under fixed names; null texts are empty."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
