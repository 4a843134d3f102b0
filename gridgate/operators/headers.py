"""Header rows: normalise, check, align. One row per header cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridgate.functions.names import cleaned_name
from gridgate.functions.text import stripped


def header_cells(rows: DataFrame, lineage: list[str], cells: str = "cells") -> DataFrame:
    """Long form of header rows held as arrays: ``lineage, pos, raw``."""
    return rows.select(*lineage, F.posexplode(cells).alias("pos", "raw"))


def normalise(rows: DataFrame, lineage: list[str], cells: str = "cells") -> DataFrame:
    """Lower-case stripped names up to the last filled cell of each header row; no shuffle, a header is one row."""
    last = F.array_max(F.transform(cells, lambda c, i: F.when(c.isNotNull(), i)))
    kept = F.when(last.isNotNull(), F.slice(cells, F.lit(1), last + 1))
    return rows.select(*lineage, F.posexplode(kept).alias("pos", "raw")).select(
        *lineage, "pos", stripped(F.lower("raw")).alias("name"))


def check(names: DataFrame, lineage: list[str]) -> DataFrame:
    """Faults per file and name: ``empty``, ``invalid_characters``, ``only_digits``, ``duplicate``.

    Counting per (file, name) combines on the map side, so one very wide or very
    repetitive header does not end up in a single window.
    """
    counts = names.groupBy(*lineage, "name").agg(F.count("*").alias("cells"), F.min("pos").alias("first_pos"))
    fault = (F.when(F.coalesce(F.col("name"), F.lit("")) == "", "empty")
             .when(~F.col("name").rlike("^[a-z0-9_]+$"), "invalid_characters")
             .when(F.col("name").rlike("^[0-9]+$"), "only_digits")
             .when(F.col("cells") > 1, "duplicate"))
    return counts.select(*lineage, "name", "cells", "first_pos", fault.alias("fault")).filter("fault is not null")


def alignment(found: DataFrame, expected: DataFrame, lineage: list[str]) -> DataFrame:
    """Positions at which two header lists differ; no rows for an aligned file."""
    keys = [*lineage, "pos"]
    both = found.select(*keys, F.col("name").alias("found_name"), F.lit(None).cast("string").alias("expected_name")).unionByName(
        expected.select(*keys, F.lit(None).cast("string").alias("found_name"), F.col("name").alias("expected_name")))
    return both.groupBy(*keys).agg(F.max("found_name").alias("found_name"), F.max("expected_name").alias("expected_name")).filter(
        ~F.col("found_name").eqNullSafe(F.col("expected_name")))


def clean_names(headers: DataFrame, lineage: list[str], raw: str = "raw", pos: str = "pos") -> DataFrame:
    """Technical names from display names; a repeated name gets ``_1``, ``_2``, …"""
    cleaned = headers.withColumn("_clean", cleaned_name(F.col(raw)))
    # A header fits one row, so a name's repetitions fit one task.
    ranked = cleaned.withColumn("_nth", F.row_number().over(Window.partitionBy(*lineage, "_clean").orderBy(pos)))
    name = F.when(F.col("_nth") == 1, F.col("_clean")).otherwise(
        F.concat(F.col("_clean"), F.lit("_"), (F.col("_nth") - 1).cast("string")))
    return ranked.select(*lineage, pos, raw, name.alias("col_name"))
