"""Batched inserts from a stream of rows.

All rules are stateless Column expressions, so a streaming frame takes them
unchanged; there is no state and no shuffle to size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridgate.operators.contract import Contract
from gridgate.operators.project import clean_cells, drop_blank_rows
from gridgate.operators.validate import apply_contract


def read_arriving(spark: SparkSession, folder: str, columns: list[str], delimiter: str = ",") -> DataFrame:
    """Files with a header line, read as they land in a folder."""
    layout = ", ".join(f"`{c}` string" for c in columns)
    return (spark.readStream.schema(layout).option("header", True).option("sep", delimiter).option("escape", '"')
            .csv(folder).withColumn("_file", F.col("_metadata.file_path")))


def checked_stream(rows: DataFrame, contract: Contract, strip: bool = False) -> DataFrame:
    """Accepted values plus ``_faults``, as in a batch run."""
    columns = [c for c in rows.columns if not c.startswith("_")]
    return apply_contract(clean_cells(drop_blank_rows(rows, columns), columns, strip), contract, columns)


def append_stream(checked: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append every micro-batch to a Parquet folder, exactly once over restarts with the same ``checkpoint``."""
    writer = checked.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
