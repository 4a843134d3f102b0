"""Numbers inside groups of any size, without one task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridgate.session import staged


def rank_within(df: DataFrame, keys: list[str], order: str, name: str, width: int = 100_000) -> DataFrame:
    """1-based position of each row in its group by a unique non-negative integer.

    A group is cut into runs of ``width`` order values. Rows are ranked inside
    a run; the counts of earlier runs are added from a frame with one row per run.
    """
    run = F.floor(F.col(order) / width).alias("_run")
    rows = df.select("*", run)
    counts = rows.groupBy(*keys, "_run").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_run").orderBy(order))
    return (rows.withColumn("_inside", inside).join(offsets, [*keys, "_run"])
            .withColumn(name, (F.col("_before") + F.col("_inside")).cast("long"))
            .drop("_run", "_inside", "_before"))


def number_by(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows with the 1-based place of their value among the distinct values in sorted order.

    The rows are range-partitioned by value, rows of one value over as many partitions as they need, and staged, which fixes the
    partitions. A window ranks inside a partition; what is added is the number of distinct values in the partitions before, less one
    for each of them that ends in the value the next one begins with. No value meets its rows by a join.
    """
    spread = df.withColumn("_spread", F.monotonically_increasing_id())
    placed = staged(spread.repartitionByRange(column, "_spread").withColumn("_part", F.spark_partition_id()).drop("_spread"), "ranges")
    ranked = placed.withColumn(name, F.dense_rank().over(Window.partitionBy("_part").orderBy(column)))
    order = Window.orderBy("_part")
    bounds = placed.groupBy("_part").agg(F.min(F.struct(column)).alias("_least"), F.max(F.struct(column)).alias("_most"))
    counts = placed.groupBy("_part", column).agg(F.lit(1)).groupBy("_part").agg(F.count("*").alias("_n")).join(bounds, "_part")
    goes_on = F.coalesce(F.lag("_most").over(order).eqNullSafe(F.col("_least")).cast("int"), F.lit(0))
    counts = counts.select("_part", "_n", goes_on.alias("_shared"))
    before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.sum("_shared").over(order)
    offsets = counts.select("_part", before.alias("_before"))
    return (ranked.join(F.broadcast(offsets), "_part")
            .withColumn(name, (F.col("_before") + F.col(name)).cast("long")).drop("_part", "_before"))
