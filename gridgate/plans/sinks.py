"""File sinks: CSV, INSERT dumps, reports, one folder per dump table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridgate.config import JVM_CHARSETS
from gridgate.functions.literals import tuple_text


def in_order(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows range-partitioned and sorted, so that output files follow input order."""
    return df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)


def write_csv(df: DataFrame, path: str, delimiter: str = ",", encoding: str = "utf-8",
              mode: str = "errorifexists") -> None:
    """Header and rows, quotes only where needed, NULL as an empty field.

    Files appear when the job commits, so a failed job leaves no partial output.
    """
    shown = [F.col(f"`{f.name}`").cast("string").alias(f.name)
             if f.dataType.typeName() in ("timestamp", "timestamp_ntz") else F.col(f"`{f.name}`") for f in df.schema]
    charset = JVM_CHARSETS[encoding.lower()]
    if charset != "UTF-8":
        df.sparkSession.conf.set("spark.sql.legacy.javaCharsets", "true")
    (df.select(*shown).write.mode(mode).option("header", True).option("sep", delimiter).option("quote", '"')
     .option("escape", '"').option("emptyValue", "").option("encoding", charset)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def insert_statements(df: DataFrame, columns: list[str], target: str, dialect: str, position: Column,
                      batch_size: int = 500, keys: list[str] | None = None, quote_all: bool = False,
                      kinds: dict[str, Column] | None = None) -> DataFrame:
    """One ``INSERT`` per batch of ``batch_size`` consecutive rows.

    ``kinds`` gives the kind of the cells of text columns that hold numbers too.

    ``position`` is the 0-based place of a row in its file (or in the whole
    frame), without gaps. A batch is the unit of the shuffle, so no file and no
    table gathers in one task.
    """
    keys = keys or []
    types = {f.name: f.dataType for f in df.schema}
    row = tuple_text([(F.col(f"`{c}`"), types[c], (kinds or {}).get(c)) for c in columns], dialect, quote_all)
    batched = df.select(*keys, F.floor(position / batch_size).alias("batch"),
                        F.struct(position.alias("p"), row.alias("t")).alias("_row"))
    head = f"INSERT INTO {target} ({', '.join(columns)})\n\tVALUES "
    return batched.groupBy(*keys, "batch").agg(F.sort_array(F.collect_list("_row")).alias("_rows")).select(
        *keys, "batch", F.concat(F.lit(head), F.array_join(F.col("_rows.t"), ",\n\t\t"), F.lit(";")).alias("statement"))


def split_statements(df: DataFrame, columns: list[str], target: str, dialect: str, batch_size: int, place: list[str],
                     quote_all: bool = False, kinds: dict[str, Column] | None = None) -> DataFrame:
    """Statements in the order of ``place`` (file, split, running id), batches formed inside a split.

    One range exchange by split brings rows into order; numbering a split's rows, forming its batches and sorting them keep to it.
    """
    file, split, tick = place
    ordered = df.repartitionByRange(file, split)
    position = F.row_number().over(Window.partitionBy(file, split).orderBy(tick)) - 1
    numbered = ordered.withColumn("_position", position)
    statements = insert_statements(numbered, columns, target, dialect, F.col("_position"), batch_size, [file, split], quote_all, kinds)
    return statements.sortWithinPartitions(file, split, "batch")


def write_dump(statements: DataFrame, path: str, order: list[str] | None = None, encoding: str = "utf-8",
               mode: str = "errorifexists") -> None:
    """Statements in batch order, a line end after each; without ``order`` they are in order already."""
    lines = in_order(statements, order) if order else statements
    charset = JVM_CHARSETS[encoding.lower()]
    if charset == "UTF-8":
        lines.select("statement").write.mode(mode).text(path)
        return
    lines.sparkSession.conf.set("spark.sql.legacy.javaCharsets", "true")
    (lines.select("statement").write.mode(mode).option("encoding", charset).option("quote", "\0")
     .option("sep", "\x01").option("escape", "\0").option("escapeQuotes", False)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_reports(reports: DataFrame, path: str, mode: str = "append") -> None:
    """A text file per input file that has errors, in a folder named after it."""
    base = F.regexp_replace(F.element_at(F.split("_file", "/"), -1), "%20", "_")
    # Files of one name in several folders: the path's checksum tells them apart. One row per file, so the window is small.
    shared = F.count("*").over(Window.partitionBy("source")) > 1
    named = reports.filter(~F.col("is_valid")).select(base.alias("source"), "_file", "report")
    named = named.withColumn("source", F.when(shared, F.concat("source", F.lit("-"), F.hex(F.crc32("_file")))).otherwise(F.col("source"))).drop("_file")
    named.write.mode(mode).partitionBy("source").text(path)


def write_by_table(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows of a dump in one folder per table.

    Tuples of different tables have different columns, so they stay arrays here;
    :func:`gridgate.sources.insert_dump.scan_insert_dump` gives one table its columns.
    """
    texts = F.transform("items", lambda i: i["text"])
    rows.select("_file", "_table", "_names", texts.alias("cells")).write.mode(mode).partitionBy("_table").parquet(path)
